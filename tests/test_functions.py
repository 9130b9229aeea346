from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from emporia.functions.columns import (
    avg_of, day_name, days_between, flag, hours_between, pct_of, round_half_up, round_money, year_month_label,
)


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005, Decimal("2.345")), (0.285, Decimal("-2.345"))], "x double, m decimal(18,4)")
    got = [(r.a, r.b) for r in df.select(round_half_up("x", 2).alias("a"), round_money("m").alias("b")).collect()]
    assert got == [(1.01, 2.35), (0.29, -2.35)]


def test_average_and_share(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "v int")
    r = df.agg(avg_of("v", 2).alias("a"), pct_of(F.count("v"), F.count(F.lit(1)), 2).alias("p")).first()
    assert (r.a, r.p) == (2.33, 75.0)
    assert df.agg(pct_of(F.lit(1), F.lit(0)).alias("p")).first().p is None


def test_calendar_helpers(spark):
    df = spark.createDataFrame([(datetime(2018, 1, 7, 23, 0), datetime(2018, 1, 8, 1, 30), 2018, 3)],
                               "a timestamp_ntz, b timestamp_ntz, y int, m int")
    r = df.select(days_between("b", "a").alias("d"), hours_between("b", "a").alias("h"),
                  day_name(F.dayofweek("a")).alias("n"), year_month_label("y", "m").alias("ym"),
                  flag(F.lit(None).cast("boolean")).alias("f")).first()
    assert (r.d, r.h, r.n, r.ym, r.f) == (1, 2.5, "Sunday", "2018-03", 0)
