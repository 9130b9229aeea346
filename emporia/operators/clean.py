"""Cleaning of the raw tables, as declared rules.

One rule set per table says which columns are parsed, which rows are complete
and in range, which columns are the key, and how text and gaps are normalised.
``clean`` applies a rule set; ``rejected`` counts the rows that each of its
rules takes out, in one pass. Predicates are SQL text; a null predicate
rejects the row. Raw text and typed input are both accepted: columns that are
already timestamps or decimals pass through the parsers unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.columns import as_timestamp, money
from emporia.operators.counted import PassCounts, nulls_of
from emporia.operators.dedup import dedup_by_key, distinct_rows, latest_per_key

# Allowed order statuses.
ORDER_STATUSES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "approved", "created"]

# Timestamp columns of the orders.
ORDER_TS_COLS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]

# Fill words for categories.
NO_CATEGORY = "unknown"
NO_TRANSLATION = "other"
RETAIL_UNKNOWN_CUSTOMER = -1
RETAIL_UNKNOWN_DESCRIPTION = "UNKNOWN"

WHOLE_ROW = ("*",)


@dataclass(frozen=True)
class Rules:
    """How one raw table is cleaned, in the order of the fields."""

    timestamps: tuple[str, ...] = ()
    decimals: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    valid: dict[str, str] = field(default_factory=dict)          # rule name -> predicate
    key: tuple[str, ...] = ()                                    # one row per key; WHOLE_ROW: distinct rows
    prefer: tuple[str, ...] = ()                                 # of a key's rows the smallest by these columns
    partition: tuple[str, ...] = ()                              # shuffle by these columns, for what follows
    valid_after: dict[str, str] = field(default_factory=dict)    # judged on the row kept for its key
    lower: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    fills: dict = field(default_factory=dict)

    def tests(self) -> dict[str, str]:
        """Rule name -> predicate of everything judged before the key."""
        missing = {f"{c} present": f"`{c}` IS NOT NULL" for c in self.required}
        return missing | self.valid


RULES = {
    "orders": Rules(
        timestamps=tuple(ORDER_TS_COLS),
        required=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
        key=("order_id",), prefer=("order_purchase_timestamp", "customer_id", "order_status"),
        valid_after={"known status": "order_status IN ({})".format(", ".join(f"'{s}'" for s in ORDER_STATUSES))}),
    "customers": Rules(
        required=("customer_id", "customer_unique_id", "customer_state"),
        key=("customer_id",), prefer=("customer_unique_id", "customer_state", "customer_city"),
        lower=("customer_city",), upper=("customer_state",)),
    "order_items": Rules(
        timestamps=("shipping_limit_date",), decimals=("price", "freight_value"),
        required=("order_id", "product_id", "seller_id", "price"),
        valid={"price above 0": "price > 0", "freight not below 0": "freight_value >= 0"},
        key=("order_id", "order_item_id"), prefer=("price", "product_id", "seller_id", "shipping_limit_date", "freight_value"),
        partition=("order_id",)),
    "payments": Rules(
        decimals=("payment_value",), required=("order_id", "payment_type", "payment_value"),
        valid={"value not below 0": "payment_value >= 0", "at least one installment": "payment_installments >= 1"}),
    "reviews": Rules(
        timestamps=("review_creation_date", "review_answer_timestamp"), integers=("review_score",),
        required=("review_id", "order_id"), valid={"score from 1 to 5": "review_score BETWEEN 1 AND 5"},
        key=("review_id",), prefer=("order_id", "review_creation_date", "review_score")),
    "category_translation": Rules(
        required=("product_category_name", "product_category_name_english"),
        # One translation per category, or a repeated one would multiply products and then orders.
        key=("product_category_name",), prefer=("product_category_name_english",)),
    "products": Rules(
        required=("product_id",), key=("product_id",), prefer=("product_category_name",),
        fills={"product_category_name": NO_CATEGORY, "product_weight_g": 0.0, "product_length_cm": 0.0,
               "product_height_cm": 0.0, "product_width_cm": 0.0}),
    "sellers": Rules(
        required=("seller_id", "seller_state"), key=("seller_id",), prefer=("seller_state", "seller_city"),
        lower=("seller_city",), upper=("seller_state",)),
    "retail": Rules(
        timestamps=("InvoiceDate",), required=("Invoice", "StockCode", "Quantity", "Price", "InvoiceDate"),
        valid={"quantity above 0": "Quantity > 0", "price above 0": "Price > 0", "not cancelled": "NOT startswith(Invoice, 'C')"},
        key=WHOLE_ROW, fills={"Customer ID": RETAIL_UNKNOWN_CUSTOMER, "Description": RETAIL_UNKNOWN_DESCRIPTION}),
}


def parse(raw: DataFrame, rules: Rules) -> DataFrame:
    """Text columns as timestamps, decimals and integers; what cannot be parsed becomes null."""
    types = {f.name: f.dataType for f in raw.schema.fields}
    columns = {c: as_timestamp(c, types[c]) for c in rules.timestamps if c in types}
    columns |= {c: money(c) for c in rules.decimals if c in types}
    columns |= {c: F.col(c).try_cast("int") for c in rules.integers if c in types}
    return raw.withColumns(columns) if columns else raw


def _holds(predicate: str) -> F.Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _one_per_key(df: DataFrame, rules: Rules, count: str | None = None, parts: int | None = None) -> DataFrame:
    if rules.key == WHOLE_ROW:
        return distinct_rows(df, count)
    if not rules.key:
        return df
    if rules.partition:      # a subset of the key: the aggregation and later ones by it need no further shuffle
        df = df.repartition(parts, *rules.partition) if parts else df.repartition(*rules.partition)
    return dedup_by_key(df, list(rules.key), list(rules.prefer), count)


def _normalised(df: DataFrame, rules: Rules) -> DataFrame:
    for predicate in rules.valid_after.values():
        df = df.filter(F.expr(predicate))
    text = {c: F.lower(F.trim(c)) for c in rules.lower} | {c: F.upper(F.trim(c)) for c in rules.upper}
    df = df.withColumns(text) if text else df
    return df.fillna(rules.fills) if rules.fills else df


def clean(raw: DataFrame, rules: Rules) -> DataFrame:
    """The rows of ``raw`` that pass the rules, normalised."""
    df = parse(raw, rules)
    for predicate in rules.tests().values():
        df = df.filter(F.expr(predicate))
    return _normalised(_one_per_key(df, rules), rules)


def clean_counted(raw: DataFrame, rules: Rules, counts: PassCounts, parts: int | None = None) -> DataFrame:
    """As ``clean``, with the counts of the reports taken on the way.

    ``parts`` is the number of partitions in which rules with ``partition``
    shuffle, for a writer that needs so many by the same columns.

    ``counts`` gets raw_rows and the nulls of each raw column, the rows that
    each rule rejects (under the first rule they fail), and passed, merged and
    kept: the rows before the key's de-duplication, those that it has merged
    and those that are left.
    """
    rows = counts.watch(raw, {"raw_rows": F.count(F.lit(1))} | nulls_of(raw, "raw_nulls"))
    judged = _judged(parse(rows, rules), rules)
    failed = {("rejected", r): F.count_if(F.col("_first") == r) for r in rules.tests()}
    judged = counts.watch(judged, {"passed": F.count_if(F.col("_first").isNull())} | failed)
    df = judged.filter(F.col("_first").isNull()).drop("_first")
    if rules.key:
        later = {("rejected", r): F.count_if(~_holds(p)) for r, p in rules.valid_after.items()}
        df = _one_per_key(df, rules, "_n", parts)
        df = counts.watch(df, {"merged": F.sum("_n"), "kept": F.count(F.lit(1))} | later).drop("_n")
    return _normalised(df, rules)


def _judged(df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` with the first rule that each row fails as ``_first``, null if it passes."""
    first = F.lit(None).cast("string")
    for rule, predicate in reversed(rules.tests().items()):
        first = F.when(~_holds(predicate), F.lit(rule)).otherwise(first)
    return df.withColumn("_first", first)


KEY_RULE = "one row per key"


def rejected_counts(rules: Rules, counts: dict, name: str) -> list[tuple[str, str, int]]:
    """The rows of ``rejected`` from the counts of a cleaning pass."""
    out = [(name, r, counts["rejected", r]) for r in rules.tests()]
    if rules.key:
        out.append((name, KEY_RULE, (counts["merged"] or 0) - counts["kept"]))
    return out + [(name, r, counts["rejected", r]) for r in rules.valid_after]


def rejected(raw: DataFrame, rules: Rules, name: str) -> DataFrame:
    """(table_name, rule, rejected): rows taken out by each rule, counted under the first rule they fail."""
    tests = rules.tests()
    judged = _judged(parse(raw, rules), rules)
    counts = judged.agg(*[F.count_if(F.col("_first") == r).alias(f"c{i}") for i, r in enumerate(tests)])
    rows = [(r, f"c{i}") for i, r in enumerate(tests)]
    out = counts.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(c).alias("rejected")) for r, c in rows]))
                        .alias("x")).select("x.*")
    if rules.key:
        passed = judged.filter(F.col("_first").isNull()).drop("_first")
        keys = passed.columns if rules.key == WHOLE_ROW else list(rules.key)
        groups = passed.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("_n"))
        out = out.unionByName(groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("rejected"))
                              .select(F.lit(KEY_RULE).alias("rule"), "rejected"))
    for rule, predicate in rules.valid_after.items():
        kept = _one_per_key(judged.filter(F.col("_first").isNull()).drop("_first"), rules)
        out = out.unionByName(kept.agg(F.count_if(~_holds(predicate)).alias("rejected")).select(F.lit(rule).alias("rule"), "rejected"))
    return out.select(F.lit(name).alias("table_name"), "rule", "rejected")


def clean_orders(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["orders"])


def clean_customers(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["customers"])


def clean_order_items(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["order_items"])


def clean_payments(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["payments"])


def clean_reviews(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["reviews"])


def latest_reviews(reviews_clean: DataFrame) -> DataFrame:
    """Latest review per order; equal dates go to the greatest review id."""
    return latest_per_key(reviews_clean, "order_id", "review_creation_date", "review_id")


def clean_category_translation(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["category_translation"])


def clean_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English name of their category."""
    return translated(clean(raw, RULES["products"]), clean_category_translation(translation))


def translated(products: DataFrame, names: DataFrame) -> DataFrame:
    """Clean products with the clean translation of their category."""
    return (products.join(names, on="product_category_name", how="left")
            .fillna({"product_category_name_english": NO_TRANSLATION}))


def clean_sellers(raw: DataFrame) -> DataFrame:
    return clean(raw, RULES["sellers"])


def clean_retail(raw: DataFrame, dedup: bool = True, fill_country: str | None = None) -> DataFrame:
    """Retail lines: complete, positive, not cancelled, distinct, valued.

    ``dedup=False`` and ``fill_country`` give the variant used before model
    training (no whole-row de-duplication, a default country). Applying the
    function to an already clean table returns it unchanged, so callers need
    no branch on the input's origin.
    """
    rules = RULES["retail"]
    if not dedup:
        rules = replace(rules, key=())
    if fill_country is not None:
        rules = replace(rules, fills=rules.fills | {"Country": fill_country})
    return valued(clean(raw, rules))


def valued(lines: DataFrame) -> DataFrame:
    """Clean retail lines with their value."""
    return lines.withColumns({
        "TotalLineValue": F.round(F.col("Quantity") * F.col("Price").cast("decimal(18,4)"), 2),
        "Country": F.trim("Country"),
    })
