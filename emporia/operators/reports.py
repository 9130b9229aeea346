"""The business questions and summary tables, each a DataFrame function.

Inputs are the featured order table (``mf``), the RFM table (``rfm``) and the
featured retail lines (``rf``). Every plan is filter -> groupBy -> agg ->
orderBy [-> limit]: the aggregation is combined map-side, and ``orderBy`` +
``limit`` plans a ``TakeOrderedAndProject`` instead of a global sort. Shares of
a total use a window over the grouped rows only (a few dozen rows), never over
raw rows. Sorts that feed a limit end with the group key so the kept rows do
not depend on ties. Money sums are exact decimals, rounded half up and
returned as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.columns import avg_of, day_name, pct_of, round_money, year_month_label

TOV = "total_order_value"
# The original questions filter on 2017 and 2018; the test data spans
# 1995-2001, so the years are a parameter.
DEFAULT_YEARS = (1997, 1998)
# Category words left out of the category reports, status
# counted as delivered, cap on installments in the installments report.
EXCLUDED_CATEGORIES = ("unknown", "other")
DELIVERED_STATUS = "delivered"
MAX_INSTALLMENTS = 12


def _delivered() -> F.Column:
    return F.col("order_status") == DELIVERED_STATUS


def _n() -> F.Column:
    return F.count(F.lit(1))


def _orders() -> F.Column:
    """Distinct orders. The featured table holds one row per order (the build
    guarantees it and the tests assert it), so this is a plain count: no
    distinct rewrite (row expansion plus an extra shuffle) is planned."""
    return F.count("order_id")


def _share(count_col: str, digits: int = 2) -> F.Column:
    total = F.sum(count_col).over(Window.partitionBy())
    return pct_of(F.col(count_col), total, digits)


# -- revenue ---------------------------------------------------------------

def q01_revenue_kpis(mf: DataFrame) -> DataFrame:
    return mf.filter(_delivered()).agg(
        _orders().alias("total_orders"),
        F.count_distinct("customer_unique_id").alias("unique_customers"),
        round_money(F.sum(TOV)).alias("total_revenue"),
        avg_of(TOV, 2).alias("avg_order_value"),
        round_money(F.max(TOV)).alias("max_order_value"),
        round_money(F.min(TOV)).alias("min_order_value"))


def q02_monthly_revenue(mf: DataFrame, years=DEFAULT_YEARS) -> DataFrame:
    return (mf.filter(_delivered() & F.col("order_year").isin(list(years)))
            .groupBy("order_year", "order_month").agg(
                _orders().alias("orders_count"),
                round_money(F.sum(TOV)).alias("monthly_revenue"))
            .withColumn("year_month", year_month_label("order_year", "order_month"))
            .select("order_year", "order_month", "year_month", "orders_count", "monthly_revenue")
            .orderBy("order_year", "order_month"))


def q03_revenue_by_state(mf: DataFrame, limit: int = 10) -> DataFrame:
    return (mf.filter(_delivered()).groupBy("customer_state").agg(
        _orders().alias("orders"),
        F.count_distinct("customer_unique_id").alias("customers"),
        round_money(F.sum(TOV)).alias("revenue"),
        avg_of(TOV, 2).alias("avg_order_value"))
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_first("customer_state")).limit(limit))


def q04_orders_by_weekday(mf: DataFrame) -> DataFrame:
    return (mf.groupBy("order_day_of_week").agg(
        _n().alias("orders_count"), avg_of(TOV, 2).alias("avg_order_value"))
        .select(day_name("order_day_of_week").alias("day_name"), "order_day_of_week",
                "orders_count", "avg_order_value")
        .orderBy("order_day_of_week"))


# -- customers ---------------------------------------------------------------

def q05_segments(rfm: DataFrame) -> DataFrame:
    return (rfm.groupBy("customer_segment").agg(
        _n().alias("customer_count"),
        avg_of("monetary", 2).alias("avg_monetary"),
        avg_of("frequency", 2).alias("avg_frequency"),
        avg_of("recency_days", 1).alias("avg_recency_days"))
        .select("customer_segment", "customer_count", _share("customer_count").alias("percentage"),
                "avg_monetary", "avg_frequency", "avg_recency_days")
        .orderBy(F.desc("customer_count"), "customer_segment"))


def q06_repeat_customers(rfm: DataFrame) -> DataFrame:
    kind = F.when(F.col("frequency") > 1, "Repeat Customer").otherwise("One-Time Customer")
    return (rfm.groupBy(kind.alias("customer_type")).agg(
        _n().alias("customer_count"), avg_of("monetary", 2).alias("avg_spend"))
        .orderBy(F.desc("customer_count"), "customer_type"))


# -- delivery ------------------------------------------------------------------

def q07_late_share(mf: DataFrame) -> DataFrame:
    d = mf.filter(_delivered() & F.col("delivery_delay_days").isNotNull())
    status = F.when(F.col("is_late_delivery") == 1, "Late").otherwise("On Time")
    return (d.groupBy("is_late_delivery").agg(_n().alias("order_count"))
            .select(status.alias("delivery_status"), "order_count", _share("order_count").alias("percentage")))


def q08_slowest_states(mf: DataFrame, limit: int = 10) -> DataFrame:
    d = mf.filter(_delivered() & (F.col("actual_delivery_days") > 0))
    return (d.groupBy("customer_state").agg(
        avg_of("actual_delivery_days", 1).alias("avg_delivery_days"),
        avg_of("delivery_delay_days", 1).alias("avg_delay_days"),
        _n().alias("delivered_orders"),
        F.sum("is_late_delivery").cast("bigint").alias("late_orders"))
        .orderBy(F.desc_nulls_last("avg_delivery_days"), F.asc_nulls_first("customer_state")).limit(limit))


def q09_delivery_by_year(mf: DataFrame) -> DataFrame:
    d = mf.filter(_delivered() & (F.col("actual_delivery_days") > 0))
    return (d.groupBy("order_year").agg(
        _n().alias("total_delivered"),
        F.sum("is_late_delivery").cast("bigint").alias("late_deliveries"),
        pct_of(F.sum("is_late_delivery"), _n(), 2).alias("late_pct"),
        avg_of("actual_delivery_days", 1).alias("avg_delivery_days"))
        .orderBy("order_year"))


# -- products ----------------------------------------------------------------

def q10_top_categories(mf: DataFrame, limit: int = 10) -> DataFrame:
    d = mf.filter(_delivered() & (F.col("product_category_name_english") != "unknown"))
    return (d.groupBy(F.col("product_category_name_english").alias("category")).agg(
        _orders().alias("orders"),
        round_money(F.sum(TOV)).alias("total_revenue"),
        avg_of(TOV, 2).alias("avg_order_value"),
        avg_of("review_score", 2).alias("avg_review_score"))
        .orderBy(F.desc_nulls_last("total_revenue"), "category").limit(limit))


def q11_scores_by_category(mf: DataFrame, limit: int = 10) -> DataFrame:
    d = mf.filter(~F.col("product_category_name_english").isin(*EXCLUDED_CATEGORIES))
    s = F.col("review_score")
    return (d.groupBy(F.col("product_category_name_english").alias("category")).agg(
        _n().alias("reviews_count"),
        avg_of("review_score", 2).alias("avg_score"),
        F.count_if(s == 5).alias("score_5"),
        F.count_if(s == 4).alias("score_4"),
        F.count_if(s == 3).alias("score_3"),
        F.count_if(s <= 2).alias("score_1_2"))
        .orderBy(F.desc("reviews_count"), "category").limit(limit))


# -- payments ----------------------------------------------------------------

def q12_payment_types(mf: DataFrame) -> DataFrame:
    return (mf.groupBy("primary_payment_type").agg(
        _n().alias("orders_count"),
        avg_of("total_payment_value", 2).alias("avg_payment"),
        round_money(F.sum("total_payment_value")).alias("total_payment"))
        .select("primary_payment_type", "orders_count", _share("orders_count").alias("percentage"),
                "avg_payment", "total_payment")
        .orderBy(F.desc("orders_count"), F.asc_nulls_first("primary_payment_type")))


def q13_installments(mf: DataFrame, max_installments: int = MAX_INSTALLMENTS) -> DataFrame:
    return (mf.filter(F.col("max_payment_installments") <= max_installments)
            .groupBy(F.col("max_payment_installments").alias("installments")).agg(
                _n().alias("orders_count"),
                avg_of("total_payment_value", 2).alias("avg_payment"),
                round_money(F.sum("total_payment_value")).alias("total_payment"))
            .orderBy("installments"))


# -- reviews -----------------------------------------------------------------

def q14_score_distribution(mf: DataFrame) -> DataFrame:
    return (mf.filter(F.col("review_score").isNotNull())
            .groupBy("review_score").agg(_n().alias("count"))
            .select("review_score", "count", _share("count").alias("percentage"))
            .orderBy(F.desc("review_score")))


def q15_score_vs_lateness(mf: DataFrame) -> DataFrame:
    return (mf.filter(F.col("review_score").isNotNull() & _delivered())
            .groupBy("is_late_delivery").agg(
                avg_of("review_score", 3).alias("avg_review_score"),
                _n().alias("orders_count")))


# -- retail ------------------------------------------------------------------

def q16_top_countries(rf: DataFrame, limit: int = 10) -> DataFrame:
    return (rf.groupBy("Country").agg(
        F.count_distinct("Invoice").alias("invoices"),
        _n().alias("line_items"),
        round_money(F.sum("TotalLineValue")).alias("total_revenue"),
        avg_of("TotalLineValue", 2).alias("avg_line_value"))
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_first("Country")).limit(limit))


def q17_retail_monthly(rf: DataFrame) -> DataFrame:
    return (rf.groupBy("InvoiceYear", "InvoiceMonth").agg(
        F.count_distinct("Invoice").alias("invoices"),
        round_money(F.sum("TotalLineValue")).alias("monthly_revenue"))
        .select(F.col("InvoiceYear").alias("year"), F.col("InvoiceMonth").alias("month"),
                year_month_label("InvoiceYear", "InvoiceMonth").alias("year_month"),
                "invoices", "monthly_revenue")
        .orderBy("year", "month"))


def q18_best_sellers(rf: DataFrame, limit: int = 10) -> DataFrame:
    return (rf.groupBy("StockCode", "Description").agg(
        F.sum("Quantity").cast("bigint").alias("units_sold"),
        round_money(F.sum("TotalLineValue")).alias("total_revenue"),
        avg_of("Price", 2).alias("avg_price"))
        .orderBy(F.desc("units_sold"), "StockCode", "Description").limit(limit))


def q19_sales_by_hour(rf: DataFrame) -> DataFrame:
    return (rf.groupBy(F.col("InvoiceHour").alias("hour_of_day")).agg(
        F.count_distinct("Invoice").alias("invoices"),
        round_money(F.sum("TotalLineValue")).alias("revenue"))
        .orderBy("hour_of_day"))


def q20_high_low_value(rf: DataFrame) -> DataFrame:
    label = F.when(F.col("is_high_value") == 1, "High Value").otherwise("Low Value")
    return (rf.groupBy("is_high_value").agg(
        _n().alias("transaction_count"),
        round_money(F.sum("TotalLineValue")).alias("total_revenue"),
        avg_of("TotalLineValue", 2).alias("avg_value"))
        .select(label.alias("purchase_type"), "transaction_count", "total_revenue", "avg_value"))


# -- summaries for export ----------------------------------------------------

def r1_monthly(mf: DataFrame) -> DataFrame:
    return (mf.filter(_delivered()).groupBy("order_year", "order_month").agg(
        _orders().alias("orders_count"),
        round_money(F.sum(TOV)).alias("monthly_revenue"),
        avg_of(TOV, 2).alias("avg_order_value"))
        .select("order_year", "order_month", year_month_label("order_year", "order_month").alias("year_month"),
                "orders_count", "monthly_revenue", "avg_order_value")
        .orderBy("order_year", "order_month"))


def r2_category(mf: DataFrame) -> DataFrame:
    d = mf.filter(_delivered() & ~F.col("product_category_name_english").isin(*EXCLUDED_CATEGORIES))
    return (d.groupBy(F.col("product_category_name_english").alias("category")).agg(
        _orders().alias("orders"),
        round_money(F.sum(TOV)).alias("revenue"),
        avg_of("review_score", 2).alias("avg_review_score"),
        avg_of("actual_delivery_days", 1).alias("avg_delivery_days"))
        .orderBy(F.desc_nulls_last("revenue"), "category"))


def r3_state(mf: DataFrame) -> DataFrame:
    return (mf.filter(_delivered()).groupBy("customer_state").agg(
        F.count_distinct("customer_unique_id").alias("customers"),
        _orders().alias("orders"),
        round_money(F.sum(TOV)).alias("revenue"),
        avg_of("actual_delivery_days", 1).alias("avg_delivery_days"),
        pct_of(F.sum("is_late_delivery"), _n(), 2).alias("late_pct")))


def r4_payments(mf: DataFrame) -> DataFrame:
    return (mf.groupBy("primary_payment_type").agg(
        _n().alias("orders"),
        round_money(F.sum("total_payment_value")).alias("total_payment"),
        avg_of("total_payment_value", 2).alias("avg_payment"))
        .orderBy(F.desc("orders"), F.asc_nulls_first("primary_payment_type")))


# -- the four summaries in one pass ---------------------------------------------

def summary_cells(mf: DataFrame) -> DataFrame:
    """All four summaries from one scan: a row per month, category, state and payment type, told apart by ``summary``.

    Each order goes into its four groups (grouping sets written out, so that
    only the state rows carry the customer whose distinct count they need).
    The result holds a row per group, whatever the number of orders.
    """
    d = _delivered()
    none, no_year = F.lit(None).cast("string"), F.lit(None).cast("int")

    def group(name: str, where: Column, label=none, year=no_year, month=no_year, customer=none) -> Column:
        return F.when(where, F.struct(F.lit(name).alias("summary"), label.alias("label"), year.alias("year"), month.alias("month"),
                                      customer.alias("customer")))

    category = F.col("product_category_name_english")
    groups = F.array_compact(F.array(
        group("month", d, year=F.col("order_year"), month=F.col("order_month")),
        group("category", d & ~category.isin(*EXCLUDED_CATEGORIES), category),
        group("state", d, F.col("customer_state"), customer=F.col("customer_unique_id")),
        group("payment", F.lit(True), F.col("primary_payment_type"))))
    measures = [TOV, "review_score", "actual_delivery_days", "is_late_delivery", "total_payment_value", "order_id"]
    rows = mf.select(F.explode(groups).alias("g"), *measures).select("g.*", *measures)
    return rows.groupBy("summary", "label", "year", "month").agg(
        _n().alias("rows"), _orders().alias("orders"), round_money(F.sum(TOV)).alias("revenue"), avg_of(TOV, 2).alias("avg_order_value"),
        avg_of("review_score", 2).alias("avg_review_score"), avg_of("actual_delivery_days", 1).alias("avg_delivery_days"),
        F.sum("is_late_delivery").alias("late"), round_money(F.sum("total_payment_value")).alias("total_payment"),
        avg_of("total_payment_value", 2).alias("avg_payment"), F.count_distinct("customer").alias("customers"))


def r1_of_cells(cells: DataFrame) -> DataFrame:
    return (cells.filter("summary = 'month'").select(
        F.col("year").alias("order_year"), F.col("month").alias("order_month"), year_month_label("year", "month").alias("year_month"),
        F.col("orders").alias("orders_count"), F.col("revenue").alias("monthly_revenue"), "avg_order_value")
        .orderBy("order_year", "order_month"))


def r2_of_cells(cells: DataFrame) -> DataFrame:
    return (cells.filter("summary = 'category'").select(F.col("label").alias("category"), "orders", "revenue", "avg_review_score",
                                                        "avg_delivery_days")
            .orderBy(F.desc_nulls_last("revenue"), "category"))


def r3_of_cells(cells: DataFrame) -> DataFrame:
    return cells.filter("summary = 'state'").select(F.col("label").alias("customer_state"), "customers", "orders", "revenue",
                                                    "avg_delivery_days", pct_of(F.col("late"), F.col("rows"), 2).alias("late_pct"))


def r4_of_cells(cells: DataFrame) -> DataFrame:
    return (cells.filter("summary = 'payment'").select(F.col("label").alias("primary_payment_type"), F.col("rows").alias("orders"),
                                                       "total_payment", "avg_payment")
            .orderBy(F.desc("orders"), F.asc_nulls_first("primary_payment_type")))


QUESTIONS = {
    "q01_revenue_kpis": ("mf", q01_revenue_kpis),
    "q02_monthly_revenue": ("mf", q02_monthly_revenue),
    "q03_revenue_by_state": ("mf", q03_revenue_by_state),
    "q04_orders_by_weekday": ("mf", q04_orders_by_weekday),
    "q05_segments": ("rfm", q05_segments),
    "q06_repeat_customers": ("rfm_base", q06_repeat_customers),
    "q07_late_share": ("mf", q07_late_share),
    "q08_slowest_states": ("mf", q08_slowest_states),
    "q09_delivery_by_year": ("mf", q09_delivery_by_year),
    "q10_top_categories": ("mf", q10_top_categories),
    "q11_scores_by_category": ("mf", q11_scores_by_category),
    "q12_payment_types": ("mf", q12_payment_types),
    "q13_installments": ("mf", q13_installments),
    "q14_score_distribution": ("mf", q14_score_distribution),
    "q15_score_vs_lateness": ("mf", q15_score_vs_lateness),
    "q16_top_countries": ("lines", q16_top_countries),
    "q17_retail_monthly": ("lines", q17_retail_monthly),
    "q18_best_sellers": ("lines", q18_best_sellers),
    "q19_sales_by_hour": ("lines", q19_sales_by_hour),
    "q20_high_low_value": ("rf", q20_high_low_value),
    "r1_monthly": ("mf", r1_monthly),
    "r2_category": ("mf", r2_category),
    "r3_state": ("mf", r3_state),
    "r4_payments": ("mf", r4_payments),
}

# The summaries again, from the groups that one scan has saved (``summary_cells``).
FROM_CELLS = {"r1_monthly": r1_of_cells, "r2_category": r2_of_cells, "r3_state": r3_of_cells, "r4_payments": r4_of_cells}
