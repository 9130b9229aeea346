"""Upkeep of customer scores: a mergeable state into which batches of new orders are folded.

A batch is reduced to one row per customer and order (or invoice): the latest
date, the sum of the values and the number of lines. Such rows can be merged in
any order and grouping, since dates are merged by their maximum and decimals by
their sum, and an order whose lines come in several batches is still one order.
A batch is saved as a delta of its own under its name, so folding it again
replaces it and changes nothing; a lost executor costs the batch's own job
only. Recency, frequency and monetary value follow from the merged rows. A
compaction merges deltas into one, by the same aggregation.

The state's folder holds ``deltas/batch=<name>`` and ``dates/batch=<name>``
(the latest date of all the batch's rows, whatever their customer or status).

Defined results: rows without a customer are scored as one customer, as in a
full build; the dates of rows that are not scored count for the reference
date; rows without an order add to date and value only; a null date or value adds nothing (a customer without any date has a
null recency, without any value 0); an empty batch leaves the state as it is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMPACTED = "compacted"


@dataclass(frozen=True)
class Scored:
    """The columns of a batch, and the rows that are scored."""

    key: str
    order: str
    ts: str
    value: str
    where: str = "true"


class RfmState:
    """The state in a folder of shared storage; partitions are hidden from listing until a batch is whole."""

    def __init__(self, spark: SparkSession, folder: str, scored: Scored):
        self.spark, self.folder, self.scored = spark, folder.rstrip("/"), scored

    def fold(self, batch: DataFrame, name: str) -> None:
        """Add the batch ``name``; a batch of that name that is there already is replaced."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", name) or name.startswith(COMPACTED):
            raise ValueError(f"not a batch name: {name}")
        c = self.scored
        rows = batch.filter(F.expr(c.where)).select(
            F.col(f"`{c.key}`").alias("customer"), F.col(f"`{c.order}`").alias("purchase"), F.col(f"`{c.ts}`").alias("last"),
            F.col(f"`{c.value}`").cast("decimal(38,4)").alias("value"))
        _merged(rows.withColumn("lines", F.lit(1).cast("long"))).write.mode("overwrite").parquet(self._path("deltas", name))
        batch.agg(F.max(f"`{c.ts}`").alias("last")).write.mode("overwrite").parquet(self._path("dates", name))

    def _path(self, part: str, name: str) -> str:
        return f"{self.folder}/{part}/batch={name}"

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{part}")

    def batches(self) -> list[str]:
        """The names of the folded batches that are not compacted yet, and of compactions."""
        return sorted(r.batch for r in self._read("dates").select(F.col("batch").cast("string").alias("batch")).distinct().collect())

    def purchases(self) -> DataFrame:
        """customer, purchase, last, value, lines: one row for each customer and order."""
        return _merged(self._read("deltas").drop("batch"))

    def reference_date(self):
        """The latest date of all batches (one scalar to the driver)."""
        latest = self._read("dates").agg(F.max("last")).first()[0]
        return None if latest is None else latest.date()

    def rfm(self, offset_days: int = 0) -> DataFrame:
        """The key column, recency_days, frequency and monetary of every customer."""
        ref: Column = F.date_add(F.lit(self.reference_date()), offset_days)
        # Both steps aggregate map-side; the second starts from one row per order.
        return (self.purchases().groupBy("customer").agg(
            F.datediff(ref, F.max("last")).alias("recency_days"), F.count("purchase").alias("frequency"),
            F.sum("value").alias("monetary"))
            .fillna({"monetary": 0}).withColumnRenamed("customer", self.scored.key))

    def compact(self) -> RfmState:
        """The same state in a folder next to this one, with all deltas merged into one; this one stays as it is."""
        state = RfmState(self.spark, f"{self.folder}-{COMPACTED}-{len(self.batches())}", self.scored)
        self.purchases().write.mode("overwrite").parquet(state._path("deltas", COMPACTED))
        self._read("dates").agg(F.max("last").alias("last")).write.mode("overwrite").parquet(state._path("dates", COMPACTED))
        return state


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("customer", "purchase").agg(F.max("last").alias("last"), F.sum("value").alias("value"),
                                                    F.sum("lines").alias("lines"))
