"""Column expressions shared by the operators.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage code generation.
"""

from emporia.functions.columns import (  # noqa: F401
    DAY_NAMES, as_timestamp, avg_of, day_name, days_between, flag, hours_between,
    money, pct_of, round_half_up, round_money, year_month_label,
)
