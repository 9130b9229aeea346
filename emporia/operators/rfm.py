"""Recency / frequency / monetary tables, quartile scores and segments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from emporia.operators.ranking import ROWS_IN_TASK, exact_quantiles, global_ntiles

# Segment thresholds on the summed score (3..12) and their names.
SEGMENTS = [(10, "Champions"), (7, "Loyal Customers"), (5, "At Risk")]
LAST_SEGMENT = "Lost Customers"

# Direction of each quartile score. "as_coded" reproduces the original code
# (score 1 = most recent / most frequent / biggest spender); "best_high" is
# the documented meaning (score 4 = best), used by default.
ORIENTATIONS = {
    "as_coded": {"R_score": True, "F_score": False, "M_score": False},
    "best_high": {"R_score": False, "F_score": True, "M_score": True},
}
MEASURE = {"R_score": "recency_days", "F_score": "frequency", "M_score": "monetary"}


def max_timestamp(df: DataFrame, column: str):
    """Largest timestamp of a column (one scalar to the driver)."""
    return df.agg(F.max(column)).first()[0]


def rfm(df: DataFrame, key: str, ts: str, order_id: str, value: str, distinct: bool = False,
        ref_date=None, offset_days: int = 0) -> DataFrame:
    """Per-customer recency (days since the reference date), frequency, monetary.

    The reference date is the latest ``ts`` of the input plus ``offset_days``.
    ``distinct=True`` counts distinct ``order_id`` values (invoice lines).
    Missing monetary values become 0.
    """
    if ref_date is None:
        ref_date = max_timestamp(df, ts)
    if isinstance(ref_date, datetime):
        ref_date = ref_date.date()
    ref = F.date_add(F.lit(ref_date), offset_days)
    freq = F.count_distinct(order_id) if distinct else F.count(order_id)
    return (df.groupBy(key).agg(
        F.datediff(ref, F.max(ts)).alias("recency_days"),
        freq.alias("frequency"),
        F.sum(value).alias("monetary"))
        .fillna({"monetary": 0}))


def rfm_orders(master_featured: DataFrame, offset_days: int = 0) -> DataFrame:
    """Marketplace RFM over delivered orders; reference date over all orders."""
    ref_date = max_timestamp(master_featured, "order_purchase_timestamp")
    delivered = master_featured.filter(F.col("order_status") == "delivered")
    return rfm(delivered, "customer_unique_id", "order_purchase_timestamp", "order_id", "total_order_value",
               ref_date=ref_date, offset_days=offset_days)


def rfm_retail(retail_featured: DataFrame, for_clustering: bool = False) -> DataFrame:
    """Retail RFM of known customers; frequency counts distinct invoices.

    ``for_clustering`` rounds monetary to 2 places and keeps positive values.
    """
    ref_date = max_timestamp(retail_featured, "InvoiceDate")
    known = retail_featured.filter(F.col("Customer ID") != -1)
    out = rfm(known, "Customer ID", "InvoiceDate", "Invoice", "TotalLineValue", distinct=True, ref_date=ref_date)
    if for_clustering:
        out = out.withColumn("monetary", F.round("monetary", 2)).filter(F.col("monetary") > 0)
    return out


def segment(score: F.Column) -> F.Column:
    expr = None
    for threshold, name in SEGMENTS:
        expr = F.when(score >= threshold, name) if expr is None else expr.when(score >= threshold, name)
    return expr.otherwise(LAST_SEGMENT)


def rfm_scores(rfm_df: DataFrame, key: str, orientation: str = "best_high", scalable: bool = True,
               rows_in_task: int = ROWS_IN_TASK) -> DataFrame:
    """Quartile scores R, F, M (ties broken by ``key``), their sum and segment.

    ``scalable=True`` scores rows against the exact boundary keys of the
    quartiles (no window); ``False`` uses ``F.ntile`` over an un-partitioned
    window, which is the same result but gathers all rows into one task.
    """
    orders = {score: [(MEASURE[score], asc), (key, True)] for score, asc in ORIENTATIONS[orientation].items()}
    if scalable:
        out = global_ntiles(rfm_df, orders, 4, rows_in_task)
    else:
        out = rfm_df
        for score, asc in ORIENTATIONS[orientation].items():
            m = F.col(MEASURE[score])
            w = Window.orderBy(m.asc() if asc else m.desc(), F.col(f"`{key}`").asc())
            out = out.withColumn(score, F.ntile(4).over(w))
    total = F.col("R_score") + F.col("F_score") + F.col("M_score")
    return out.withColumn("RFM_score", total).withColumn("customer_segment", segment(F.col("RFM_score")))


def cap_at_quantile(df: DataFrame, columns: list[str], q: float = 0.99, exact: bool = True,
                    relative_error: float = 0.001, rows_in_task: int = ROWS_IN_TASK):
    """Cap each column at its q-quantile; returns (capped df, {column: cap}).

    ``exact`` selects the value at position ceil(q*n), of all columns in one search;
    otherwise ``approxQuantile`` with the given rank error (one sketch pass
    for all columns). The caps are scalars placed in the plan as literals.
    """
    if exact:
        caps = exact_quantiles(df, columns, q, rows_in_task)
    else:
        values = df.approxQuantile(columns, [q], relative_error)
        caps = {c: v[0] if v else None for c, v in zip(columns, values)}
    capped = df.withColumns({c: F.least(F.col(f"`{c}`"), F.lit(v)) for c, v in caps.items() if v is not None})
    return capped, caps
