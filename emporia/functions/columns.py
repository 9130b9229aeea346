"""Column helpers: money, rounding, calendar parts, flags and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Money is carried as a decimal so that sums do not depend on row order.
MONEY = "decimal(18,4)"

# Day names by Spark's dayofweek number (1 = Sunday).
DAY_NAMES = {
    1: "Sunday",
    2: "Monday",
    3: "Tuesday",
    4: "Wednesday",
    5: "Thursday",
    6: "Friday",
    7: "Saturday",
}

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast a money amount to the decimal type used for sums (null if it does not fit)."""
    return _c(c).try_cast(MONEY)


def round_half_up(c, digits: int) -> Column:
    """Round half away from zero on the decimal value and return a double.

    Rounding a double directly differs between engines on values such as
    1.005; going through a 6-place decimal makes the rule explicit.
    """
    return F.round(_c(c).cast("decimal(38,6)"), digits).cast("double")


def round_money(c, digits: int = 2) -> Column:
    """Round a decimal amount (e.g. a money sum) and return a double."""
    return F.round(_c(c), digits).cast("double")


def avg_of(c, digits: int | None = None) -> Column:
    """Average as double(sum) / count of non-null values, optionally rounded."""
    col = _c(c)
    value = F.sum(col).cast("double") / F.count(col)
    return value if digits is None else round_half_up(value, digits)


def pct_of(part, whole, digits: int = 2) -> Column:
    """100 * part / whole as a rounded double; null when whole is 0."""
    return round_half_up(_c(part).cast("double") * 100.0 / F.nullif(_c(whole).cast("double"), F.lit(0.0)), digits)


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (a null condition gives 0)."""
    return F.when(cond, 1).otherwise(0)


def days_between(end, start) -> Column:
    """Whole calendar days from start to end (Spark ``datediff``)."""
    return F.datediff(_c(end), _c(start))


def hours_between(end, start) -> Column:
    """Hours between two timestamps, from whole epoch seconds."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 3600


def as_timestamp(c, dtype=None, fmt: str = TS_FORMAT) -> Column:
    """Parse text to a wall-clock timestamp (no time zone); bad text gives null.

    The text must match ``fmt`` (checked with ``try_to_timestamp``); the value
    itself comes from a cast to ``timestamp_ntz``, which keeps the written
    wall-clock time whatever the session time zone (a zone-aware parse would
    move times inside a daylight-saving gap). Columns that are already
    timestamps pass through unchanged, so cleaners accept both the CSV text
    and typed Parquet inputs.
    """
    col = _c(c)
    if dtype is not None and not isinstance(dtype, StringType):
        return col
    return F.when(F.try_to_timestamp(col, F.lit(fmt)).isNotNull(), col.try_cast("timestamp_ntz"))


def day_name(c) -> Column:
    """Day name for a Spark ``dayofweek`` number."""
    col = _c(c)
    expr = None
    for num, name in DAY_NAMES.items():
        expr = F.when(col == num, name) if expr is None else expr.when(col == num, name)
    return expr


def year_month_label(year, month) -> Column:
    """'YYYY-MM' label from integer year and month."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))
