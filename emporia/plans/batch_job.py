"""End-to-end job: raw tables -> clean -> featured tables -> saved tables and exports.

Usage (CSV inputs as in the original layout)::

    spark-submit -m emporia.plans.batch_job --csv hdfs:///data/raw/ --out hdfs:///data/out/

or from Python with any source of raw DataFrames::

    t = from_csv(spark, base)            # or from_testdata(spark, sf_dir)
    register_views(t)                    # SQL over master_featured, rfm_olist, ...
    manifest = run(t, out)
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import reports
from emporia.plans.tables import CommerceTables, from_csv, from_testdata
from emporia.sources.files import load_parquet, register_views as register_frames, table
from emporia.sources.sinks import export_all, save_table

# Names of the saved tables.
SAVED = ("master_featured", "rfm_olist", "online_retail_featured", "rfm_retail")
# Partition columns of the saved tables (year filters prune whole folders).
PARTITIONS = {"master_featured": ["order_year"], "online_retail_featured": ["InvoiceYear"]}


def named_tables(t: CommerceTables, orientation: str = "best_high") -> dict[str, DataFrame]:
    """The four featured tables; ``orientation="as_coded"`` gives the original RFM scores."""
    rfm = t.rfm_olist if orientation == "best_high" else t.rfm_scored(orientation)
    return {"master_featured": t.master_featured, "rfm_olist": rfm,
            "online_retail_featured": t.retail_featured, "rfm_retail": t.rfm_retail}


def register_views(t: CommerceTables, orientation: str = "best_high") -> list[str]:
    """Temp views of the raw (``*_raw``), clean (``*_clean``) and featured tables for SQL users."""
    return [*register_frames(t.raw, "_raw"), *register_frames(t.clean_tables(), "_clean"),
            *register_frames(named_tables(t, orientation))]


def summaries(cells: DataFrame) -> dict[str, DataFrame]:
    """The four grouped summaries of the featured orders, from ``reports.summary_cells``."""
    return {"monthly_revenue": reports.r1_of_cells(cells), "category_revenue": reports.r2_of_cells(cells),
            "state": reports.r3_of_cells(cells), "payments": reports.r4_of_cells(cells)}


def run(t: CommerceTables, out: str, as_tables: bool = False, orientation: str = "best_high") -> DataFrame:
    """Save the featured tables (catalog or Parquet under ``out``) and the exports."""
    out = out.rstrip("/")
    saved = {}
    for name, df in named_tables(t, orientation).items():
        where = save_table(df, name, None if as_tables else f"{out}/tables/{name}", partition_by=PARTITIONS.get(name))
        saved[name] = table(t.spark, where) if as_tables else load_parquet(t.spark, where)
    # The exports read what was saved instead of computing it again.
    cells = load_parquet(t.spark, save_table(reports.summary_cells(saved["master_featured"]), "summary_cells", f"{out}/tables/summary_cells"))
    return export_all(saved, summaries(cells), f"{out}/exports")


def refresh(t: CommerceTables, out: str, years: list[int]) -> DataFrame:
    """Bring some years of the saved featured orders up to date; returns the orders and value of each year."""
    path = t.refresh_years(f"{out.rstrip('/')}/tables/master_featured", years)
    return orders_by_year(load_parquet(t.spark, path))


def orders_by_year(mf: DataFrame) -> DataFrame:
    return mf.groupBy("order_year").agg(F.count("order_id").alias("orders"), F.sum("total_order_value").alias("revenue"))


def main(argv=None):
    ap = argparse.ArgumentParser(description=__doc__)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="folder with the raw CSV files")
    src.add_argument("--testdata", help="folder with the TPC-H-like test tables")
    ap.add_argument("--out", required=True, help="output folder (shared storage)")
    ap.add_argument("--as-tables", action="store_true", help="save to the catalog instead of Parquet paths")
    ap.add_argument("--refresh-years", type=int, nargs="+", help="only replace these years of the saved featured orders")
    ap.add_argument("--orientation", choices=["best_high", "as_coded"], default="best_high",
                    help="RFM score direction (as_coded: score 1 = best, as originally computed)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("emporia-batch").getOrCreate()
    t = from_csv(spark, a.csv) if a.csv else from_testdata(spark, a.testdata)
    done = refresh(t, a.out, a.refresh_years) if a.refresh_years else run(t, a.out, a.as_tables, a.orientation)
    done.show(truncate=False)


if __name__ == "__main__":
    main()
