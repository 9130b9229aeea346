"""The named tables of the workload, built lazily from raw inputs.

``CommerceTables`` holds the raw DataFrames and exposes every derived table
as a property built on first use. Tables reused by several jobs (the featured
order table, the RFM base, the retail lines before the median) are written to
the session's reliable checkpoint folder, which cuts their lineage: a lost
executor then re-reads files instead of re-running the joins.
"""

from __future__ import annotations

import math
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import clean as C
from emporia.operators import enrich as E
from emporia.operators import reports
from emporia.operators import rfm as R
from emporia.operators.counted import PassCounts, nulls_of
from emporia.operators.ranking import ROWS_IN_TASK, exact_quantile
from emporia.plans.session import ensure_checkpoint_dir
from emporia.sources import testdata
from emporia.sources.files import load_all, load_all_sound, load_parquet
from emporia.sources.schemas import CATALOGUE
from emporia.sources.sinks import balanced, delete_folder, refresh_partitions, save_bucketed

ORDERS_PER_BUCKET = 100_000     # a bucket's lines are sorted within a task's memory
MIN_BUCKETS = 8


def _folder(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}/{name}"


def materialized(df: DataFrame, name: str, partition_by: list[str] | None = None,
                 sort_within: list[str] | None = None, dealt: bool = False, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Reading back from Parquet (rather than an RDD checkpoint) keeps column
    pruning, filter pushdown and partition pruning for every later query.
    ``sort_within`` orders rows inside each file so row-group statistics can
    skip groups for equality filters (e.g. on the order status). ``dealt``
    rows are already together by ``partition_by``.
    """
    spark = df.sparkSession
    path = path or _folder(spark, name)
    # Partition columns lead the sort, so the writer's own ordering requirement
    # is already met and the status order inside each file is kept.
    order = [*(partition_by or []), *(sort_within or [])] if sort_within else []
    out = df if dealt else balanced(df, partition_by)
    out = out.sortWithinPartitions(*order) if order else out
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return load_parquet(spark, path)


class CommerceTables:
    """The tables of one workload.

    ``materialize`` saves the clean tables and what several jobs share. The
    tables with an ``order_id`` are saved in ``buckets`` by it, sorted, so that
    totals per order and the joins by order need no exchange afterwards; the
    other tables are plain Parquet. The pass that saves a clean table takes the
    counts of its reports (``counts``).
    """

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], rows_in_task: int = ROWS_IN_TASK,
                 materialize: bool = True, buckets: int | None = None):
        self.spark = spark
        self.raw = raw
        self.rows_in_task = rows_in_task
        self.materialize = materialize
        self.bucketed: list[str] = []
        self.quarantine: dict[str, DataFrame] = {}      # malformed input records, by table
        self._buckets = buckets
        self._counts: dict[str, dict] = {}
        self._paths: dict[str, str] = {}                # folders of saved tables, by name

    def _keep(self, df: DataFrame, name: str, **kw) -> DataFrame:
        if not self.materialize:
            return df
        self._paths[name] = _folder(self.spark, name)
        return materialized(df, name, path=self._paths[name], **kw)

    @cached_property
    def buckets(self) -> int:
        return self._buckets or max(MIN_BUCKETS, math.ceil(self.raw["orders"].count() / ORDERS_PER_BUCKET))

    def _keep_by_order(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        path = self._paths[name] = _folder(self.spark, name)
        self.bucketed.append(save_bucketed(df, f"emporia_{name}_{uuid.uuid4().hex[:8]}", path, "order_id", self.buckets))
        return self.spark.table(self.bucketed[-1])

    def drop_bucketed(self) -> None:
        """Take the bucketed tables out of the catalog; the files stay in the checkpoint folder."""
        while self.bucketed:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.bucketed.pop()}")

    def release(self, *names: str) -> None:
        """Delete the files of saved tables that nothing to come reads; asked for again, a table is built again.

        For tables objects that one job owns: frames over the deleted files can no longer be read. The shuffles that
        built them go too, as soon as the driver's collector finds them unused.
        """
        for name in names:
            if name not in self._paths:
                continue
            for table in [b for b in self.bucketed if b.startswith(f"emporia_{name}_")]:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
                self.bucketed.remove(table)
            delete_folder(self.spark, self._paths.pop(name))
            self.__dict__.pop(CLEAN.get(name.removesuffix("_clean"), name), None)
        for derived in DERIVED:         # frames over saved tables
            self.__dict__.pop(derived, None)
        self.spark.sparkContext._jvm.System.gc()

    # -- clean tables --------------------------------------------------------
    def _cleaned(self, name: str, finish=None, by_order: bool = False) -> DataFrame:
        """A clean table, saved; its counts are taken by the job that writes it."""
        raw, rules, finish = self.raw[name], C.RULES[name], finish or (lambda df: df)
        if not self.materialize:
            return finish(C.clean(raw, rules))
        counts = PassCounts()
        # Rules that shuffle by the order do it into the buckets, so that the writer adds no exchange of its own.
        df = finish(C.clean_counted(raw, rules, counts, self.buckets if by_order and rules.partition else None))
        df = counts.watch(df, {"clean_rows": F.count(F.lit(1))} | nulls_of(df, "nulls"))
        saved = self._keep_by_order(df, f"{name}_clean") if by_order else self._keep(df, f"{name}_clean")
        rows = saved.count()

        def holds(c: dict) -> bool:
            rejected = sum(c["rejected", r] for r in rules.tests())
            merged = not rules.key or (c["merged"] or 0) == c["passed"]
            return c["clean_rows"] == rows and c["raw_rows"] == c["passed"] + rejected and merged

        self._counts[name] = counts.read(holds)
        return saved

    def counts(self, name: str) -> dict:
        """The counts of a table's cleaning: raw_rows, (raw_nulls, column), (rejected, rule), passed, merged, kept, clean_rows
        and (nulls, column)."""
        getattr(self, CLEAN[name])
        if name not in self._counts:
            counts = PassCounts()
            C.clean_counted(self.raw[name], C.RULES[name], counts)
            clean = getattr(self, CLEAN[name])
            counts.watch(clean, {"clean_rows": F.count(F.lit(1))} | nulls_of(clean, "nulls"))
            self._counts[name] = counts.recount()
        return self._counts[name]

    def rejected_rows(self) -> DataFrame:
        """(table_name, rule, rejected) of every table: malformed records by reason, then what each cleaning rule takes out."""
        rows = [r for n, rules in C.RULES.items() for r in C.rejected_counts(rules, self.counts(n), n)]
        counted = self.spark.createDataFrame(rows, "table_name string, rule string, rejected long")
        for name, aside in self.quarantine.items():
            counted = counted.unionByName(aside.groupBy(F.col("reason").alias("rule")).agg(F.count(F.lit(1)).alias("rejected"))
                                          .withColumn("table_name", F.lit(name)))
        return counted

    @cached_property
    def orders_clean(self) -> DataFrame:
        return self._cleaned("orders", by_order=True)

    @cached_property
    def customers_clean(self) -> DataFrame:
        return self._cleaned("customers")

    @cached_property
    def items_clean(self) -> DataFrame:
        return self._cleaned("order_items", by_order=True)

    @cached_property
    def payments_clean(self) -> DataFrame:
        return self._cleaned("payments", by_order=True)

    @cached_property
    def reviews_clean(self) -> DataFrame:
        return self._cleaned("reviews", by_order=True)

    @cached_property
    def reviews_latest(self) -> DataFrame:
        return C.latest_reviews(self.reviews_clean)

    @cached_property
    def category_clean(self) -> DataFrame:
        return self._cleaned("category_translation")

    @cached_property
    def products_clean(self) -> DataFrame:
        return self._cleaned("products", lambda df: C.translated(df, self.category_clean))

    @cached_property
    def sellers_clean(self) -> DataFrame:
        return self._cleaned("sellers")

    @cached_property
    def retail_clean(self) -> DataFrame:
        return self._cleaned("retail", C.valued)

    def clean_tables(self) -> dict[str, DataFrame]:
        return {"orders": self.orders_clean, "customers": self.customers_clean, "order_items": self.items_clean,
                "payments": self.payments_clean, "reviews": self.reviews_clean, "products": self.products_clean,
                "sellers": self.sellers_clean, "retail": self.retail_clean}

    # -- order grain -----------------------------------------------------------
    @cached_property
    def items_agg(self) -> DataFrame:
        return E.items_per_order(self.items_clean)

    @cached_property
    def payments_agg(self) -> DataFrame:
        return E.payments_per_order(self.payments_clean)

    @cached_property
    def items_side(self) -> DataFrame:
        """Order-line totals with what the main product and seller add."""
        return self._keep_by_order(E.items_with_lookups(self.items_agg, self.products_clean, self.sellers_clean), "items_side")

    @cached_property
    def master(self) -> DataFrame:
        if self.materialize:
            return E.master_by_keys(self.orders_clean, self.customers_clean, self.items_side, self.payments_agg,
                                    self.reviews_latest)
        return E.build_master(self.orders_clean, self.customers_clean, self.items_agg, self.payments_agg,
                              self.reviews_latest, self.products_clean, self.sellers_clean)

    @cached_property
    def master_featured(self) -> DataFrame:
        if not self.materialize:
            return E.featurize_orders(self.master)
        # The rows are brought together by year before the features widen them.
        dealt = balanced(self.master.withColumn("order_year", F.year("order_purchase_timestamp")), ["order_year"])
        return self._keep(E.featurize_orders(dealt), "master_featured", partition_by=["order_year"],
                          sort_within=["order_status"], dealt=True)

    @cached_property
    def summary_cells(self) -> DataFrame:
        """The groups of the four summaries, from one scan."""
        return self._keep(reports.summary_cells(self.master_featured), "summary_cells")

    def featured_of_years(self, years: list[int]) -> DataFrame:
        """The featured orders of some years, from the saved clean tables; only those orders are joined."""
        wanted = self.orders_clean.filter(F.year("order_purchase_timestamp").isin(list(years)))
        return E.featurize_orders(E.master_by_keys(wanted, self.customers_clean, self.items_side, self.payments_agg, self.reviews_latest))

    def refresh_years(self, path: str, years: list[int]) -> str:
        """Replace some years of featured orders saved at ``path`` (partitioned by year); other years' files stay as they are."""
        return refresh_partitions(self.featured_of_years(years), path, "order_year", years)

    # -- customers -----------------------------------------------------------
    @cached_property
    def rfm_base(self) -> DataFrame:
        return self._keep(R.rfm_orders(self.master_featured), "rfm_base")

    def rfm_scored(self, orientation: str = "best_high") -> DataFrame:
        return R.rfm_scores(self.rfm_base, "customer_unique_id", orientation, rows_in_task=self.rows_in_task)

    @cached_property
    def rfm_olist(self) -> DataFrame:
        return self.rfm_scored("best_high")

    @cached_property
    def rfm_olist_as_coded(self) -> DataFrame:
        return self.rfm_scored("as_coded")

    # -- retail ----------------------------------------------------------------
    @cached_property
    def retail_lines(self) -> DataFrame:
        return self._keep(E.retail_calendar(self.retail_clean), "retail_lines")

    @cached_property
    def high_value_threshold(self):
        """Exact median of the line values, searched once."""
        return exact_quantile(self.retail_lines, "TotalLineValue", 0.5, self.rows_in_task)

    @cached_property
    def retail_featured(self) -> DataFrame:
        return E.add_high_value(self.retail_lines, self.high_value_threshold)

    @cached_property
    def rfm_retail(self) -> DataFrame:
        return R.rfm_retail(self.retail_lines)

    @cached_property
    def rfm_retail_ml(self) -> DataFrame:
        return self._keep(R.rfm_retail(self.retail_lines, for_clustering=True), "rfm_retail_ml")


# Raw table -> the property with its clean form.
CLEAN = {"orders": "orders_clean", "customers": "customers_clean", "order_items": "items_clean", "payments": "payments_clean",
         "reviews": "reviews_clean", "category_translation": "category_clean", "products": "products_clean",
         "sellers": "sellers_clean", "retail": "retail_clean"}
# Properties that are not saved.
DERIVED = ("reviews_latest", "items_agg", "payments_agg", "master", "rfm_olist", "rfm_olist_as_coded", "retail_featured", "rfm_retail")
# Saved tables from which the featured orders are built.
ORDER_PARTS = ("items_side", *[f"{n}_clean" for n in CLEAN if n != "retail"])

_MEMO: dict = {}


def from_testdata(spark: SparkSession, sf_dir: str, **kw) -> CommerceTables:
    """Tables derived from the driver's test tables (memoised per session and folder)."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(sorted(kw.items())))
    if key not in _MEMO:
        _MEMO[key] = CommerceTables(spark, testdata.raw_tables(spark, sf_dir), **kw)
    return _MEMO[key]


def from_csv(spark: SparkSession, base: str, paths: dict | None = None, quarantine: str | None = None, **kw) -> CommerceTables:
    """Tables from the original CSV files under ``base``.

    ``quarantine`` names a folder: the rows are then read once and saved there,
    sound ones and malformed records apart; the latter are the tables'
    ``quarantine`` and are counted with the rejected rows. The geolocation file
    is catalogued (``load_all`` reads it on request) but feeds no table, so it
    is not opened here.
    """
    names = [n for n in CATALOGUE if n != "geolocation"]
    if quarantine is None:
        return CommerceTables(spark, load_all(spark, base, names=names, paths=paths), **kw)
    sound, aside = load_all_sound(spark, base, quarantine, names=names, paths=paths)
    tables = CommerceTables(spark, sound, **kw)
    tables.quarantine = aside
    return tables


# -- models ----------------------------------------------------------------------

def ml_source(t: CommerceTables, key: str) -> DataFrame:
    from emporia.models import prep
    if key in ("lr", "rf"):
        return prep.prep_orders_ml(t.master_featured)
    if key == "dt":
        return prep.prep_orders_status_ml(t.master_featured)
    if key in ("gbt", "gbt_sampled"):
        return prep.prep_retail_ml(t.retail_lines, t.high_value_threshold)
    raise KeyError(key)


def fitted(t: CommerceTables, key: str):
    """Train (once per tables object) and return the fitted classifier ``key``.

    Fits run one after another: running the four from parallel driver threads
    was measured slower on one machine (55 s against 30 s at sf0.01), as the
    small tree jobs contend rather than overlap.
    """
    from emporia.models import classifiers
    fits = t.__dict__.setdefault("_fits", {})
    if key not in fits:
        fits[key] = classifiers.train((classifiers.SPECS | classifiers.SPECS_SAMPLED)[key], ml_source(t, key), keep=t._keep)
    return fits[key]


def clusters(t: CommerceTables):
    """Run the K-means sweep and final model once per tables object."""
    from emporia.models import cluster
    if "_clusters" not in t.__dict__:
        t.__dict__["_clusters"] = cluster.run(t.spark, t.rfm_retail_ml, rows_in_task=t.rows_in_task, keep=t._keep)
    return t.__dict__["_clusters"]
