"""Small helpers shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _int_div(x: Column, y: Column) -> Column:
    """Exact floor(x / y) for non-negative integral decimals: (x - x mod y) / y."""
    return ((x - x % y) / y).cast("decimal(38,0)")


def round_ratio(num: Column, den: Column, scale: int) -> Column:
    """ROUND(num / den, scale), half away from zero, for *integer* num and den.

    Done in integer arithmetic, so the answer is exact (a binary double would
    put 4.35 just below the tie, and a decimal division rounds once at its own
    scale before the final rounding).  NULL when den is 0 or NULL.
    """
    f = 10 ** scale
    a = F.abs(num).cast("decimal(38,0)")
    d = F.abs(F.nullif(den, F.lit(0)).cast("decimal(38,0)"))
    q = _int_div(a * F.lit(2 * f) + d, F.lit(2) * d)
    sign = F.signum(num) * F.signum(den)
    return (sign * q / F.lit(f)).cast("double")


def money_div(num: Column, den: Column, scale: int, units: int = 100) -> Column:
    """ROUND(num / den, scale) for values with at most two decimals (money,
    counts): both sides are scaled to whole cents first, then divided exactly."""
    return round_ratio((num * units).cast("decimal(38,0)"), (den * units).cast("decimal(38,0)"), scale)


def to_report(df: DataFrame) -> DataFrame:
    """Presentation types for a finished report: decimals as double, integers as long.

    Computation stays in exact decimals; only the final, already rounded
    values are converted, so both sides of the oracle compare agree.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)
