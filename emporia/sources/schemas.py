"""Declared schemas of the raw input tables.

Reading CSV with a declared schema avoids the second pass over the text that
schema inference costs and keeps column types independent of the data.
Timestamps and the review score arrive as text and are parsed by the cleaners
with tolerant parsers, so a malformed value becomes null instead of failing
the job.
"""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _schema(*fields):
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, D, I, L = StringType(), DoubleType(), IntegerType(), LongType()

ORDERS = _schema(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", S), ("order_approved_at", S),
    ("order_delivered_carrier_date", S), ("order_delivered_customer_date", S),
    ("order_estimated_delivery_date", S),
)
CUSTOMERS = _schema(
    ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S),
)
ORDER_ITEMS = _schema(
    ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
    ("shipping_limit_date", S), ("price", D), ("freight_value", D),
)
PAYMENTS = _schema(
    ("order_id", S), ("payment_sequential", I), ("payment_type", S),
    ("payment_installments", I), ("payment_value", D),
)
REVIEWS = _schema(
    ("review_id", S), ("order_id", S), ("review_score", S), ("review_comment_title", S),
    ("review_comment_message", S), ("review_creation_date", S), ("review_answer_timestamp", S),
)
PRODUCTS = _schema(
    ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
    ("product_description_lenght", I), ("product_photos_qty", I), ("product_weight_g", D),
    ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D),
)
SELLERS = _schema(
    ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S),
)
GEOLOCATION = _schema(
    ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
    ("geolocation_city", S), ("geolocation_state", S),
)
CATEGORY_TRANSLATION = _schema(
    ("product_category_name", S), ("product_category_name_english", S),
)
RETAIL = _schema(
    ("Invoice", S), ("StockCode", S), ("Description", S), ("Quantity", I),
    ("InvoiceDate", S), ("Price", D), ("Customer ID", D), ("Country", S),
)

# Table name -> (default file name, schema) of the raw inputs.
CATALOGUE = {
    "orders": ("olist_orders_dataset.csv", ORDERS),
    "customers": ("olist_customers_dataset.csv", CUSTOMERS),
    "order_items": ("olist_order_items_dataset.csv", ORDER_ITEMS),
    "payments": ("olist_order_payments_dataset.csv", PAYMENTS),
    "reviews": ("olist_order_reviews_dataset.csv", REVIEWS),
    "products": ("olist_products_dataset.csv", PRODUCTS),
    "sellers": ("olist_sellers_dataset.csv", SELLERS),
    "geolocation": ("olist_geolocation_dataset.csv", GEOLOCATION),
    "category_translation": ("product_category_name_translation.csv", CATEGORY_TRANSLATION),
    "retail": ("online_retail_II.csv", RETAIL),
}

# Columns of free text: their quoted fields may hold line ends.
FREE_TEXT = {"review_comment_title", "review_comment_message", "Description"}


def has_free_text(schema: StructType | None) -> bool:
    """Whether fields may hold line ends; without a declared schema they may."""
    return schema is None or any(f.name in FREE_TEXT for f in schema.fields)


# Tables that are read with line ends inside quoted fields, a task per file; all others are read in splits.
MULTI_LINE = {name for name, (_, schema) in CATALOGUE.items() if has_free_text(schema)}
