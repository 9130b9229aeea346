"""Training-set preparation for the order and retail models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.operators.clean import Rules, clean, clean_retail
from emporia.operators.enrich import featurize_retail

# Fills applied to delivered orders before training.
ORDER_ML_FILLS = {
    "delivery_delay_days": 0,
    "days_to_approve": 0,
    "actual_delivery_days": 0,
    "product_weight_g": 500.0,
    "product_volume_cm3": 1000.0,
    "items_count": 1,
    "avg_item_price": 0.0,
    "max_payment_installments": 1,
    "customer_state": "SP",
    "seller_state": "SP",
    "product_category_name_english": "other",
    "primary_payment_type": "credit_card",
}

# Delivered orders whose delivery days, value and review are known, gaps filled.
ORDER_ML_RULES = Rules(valid={"delivered": "order_status = 'delivered'"},
                       required=("actual_delivery_days", "total_order_value", "review_score"), fills=ORDER_ML_FILLS)

# Fills applied to all orders for the delivered-status model.
ORDER_STATUS_ML_FILLS = {
    "total_payment_value": 0.0,
    "max_payment_installments": 1,
    "items_count": 1,
    "items_total_freight": 0.0,
    "items_total_price": 0.0,
    "avg_item_price": 0.0,
    "customer_state": "SP",
    "primary_payment_type": "credit_card",
    "is_delivered": 0,
}

# Country filled into retail lines before training.
RETAIL_DEFAULT_COUNTRY = "United Kingdom"


def prep_orders_ml(master_featured: DataFrame) -> DataFrame:
    """Delivered orders with delivery days, value and review present, gaps filled."""
    return clean(master_featured, ORDER_ML_RULES)


def prep_orders_status_ml(master_featured: DataFrame) -> DataFrame:
    """All orders with the payment and item gaps filled (delivered-status model)."""
    return master_featured.fillna(ORDER_STATUS_ML_FILLS)


ROW_KEY = "_key"


def model_frame(df: DataFrame, numeric: list[str], categorical: list[str], label: str, key: list[str] | None = None) -> DataFrame:
    """The model's columns with incomplete rows dropped; money as double.

    ``key`` adds the row's key as text, by which rows are split and sampled.
    """
    cols = [F.col(c).cast("double").alias(c) for c in numeric] + [F.col(c) for c in categorical] + [F.col(label)]
    keyed = [F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in key]).alias(ROW_KEY)] if key else []
    return df.select(*cols, *keyed).dropna(subset=[*numeric, *categorical, label])


def prep_retail_ml(retail_raw_or_clean: DataFrame, threshold=None) -> DataFrame:
    """Retail lines for the high-value model: cleaned without whole-row dedup, default country."""
    cleaned = clean_retail(retail_raw_or_clean, dedup=False, fill_country=RETAIL_DEFAULT_COUNTRY)
    return featurize_retail(cleaned, threshold)
