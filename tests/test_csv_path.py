"""The CSV route (declared schemas, text timestamps) gives the same answers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from emporia.operators import reports as Q
from emporia.plans.tables import CommerceTables, from_csv
from emporia.sources import testdata
from emporia.sources.schemas import CATALOGUE
from tests.conftest import SF_SMALL, rows


def _to_csv(df, schema, path):
    cols = []
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, StringType) and "timestamp" in have[f.name].typeName():
            cols.append(F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    df.select(cols).write.mode("overwrite").option("header", True).csv(path)


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("csv")
    raw = testdata.raw_tables(spark, SF_SMALL)
    for name, df in raw.items():
        file_name, schema = CATALOGUE[name]
        _to_csv(df, schema, str(base / file_name))
    # the raw tables rounded to whole seconds, as the CSV text holds them
    secs = {}
    for name, df in raw.items():
        secs[name] = df.select([F.date_trunc("second", F.col(f"`{c}`")).cast("timestamp_ntz").alias(c)
                                if "timestamp" in t.typeName() else F.col(f"`{c}`") for c, t in
                                [(f.name, f.dataType) for f in df.schema.fields]])
    return (from_csv(spark, str(base), materialize=False),
            CommerceTables(spark, secs, materialize=False))


def test_csv_schemas_are_declared(both):
    csv_t, _ = both
    assert csv_t.raw["orders"].schema["order_purchase_timestamp"].dataType == StringType()
    assert csv_t.orders_clean.schema["order_purchase_timestamp"].dataType.typeName() == "timestamp_ntz"


@pytest.mark.parametrize("name", ["q01_revenue_kpis", "q03_revenue_by_state", "q08_slowest_states",
                                  "q11_scores_by_category", "q13_installments", "q15_score_vs_lateness",
                                  "q16_top_countries", "q18_best_sellers", "q20_high_low_value", "r3_state"])
def test_reports_match(both, name):
    csv_t, typed = both
    src, fn = Q.QUESTIONS[name]
    pick = {"mf": lambda t: t.master_featured, "rfm": lambda t: t.rfm_olist, "rf": lambda t: t.retail_featured,
            "lines": lambda t: t.retail_lines, "rfm_base": lambda t: t.rfm_base}[src]
    assert rows(fn(pick(csv_t))) == rows(fn(pick(typed)))
