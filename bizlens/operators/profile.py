"""Column profiling (D19-D23): NULL counts, value counts, duplicates,
numeric profile and the numeric-column test.  Each is one aggregation pass.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, from a single aggregation."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    return wide.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "nulls")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) with NULL as its own value, for several columns
    at once (unpivot, then one grouped count)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in columns])).alias("_cv")).select("_cv.*")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def duplicate_count(df: DataFrame) -> Column:
    """Rows minus distinct rows (NULLs compare equal, as pandas does), as a scalar.

    Grouped on all columns with a partial aggregation; only (row, count) pairs
    with count > 1 matter.
    """
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.select(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).scalar()


# Plain decimal numbers, with an exponent if any.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _digits(s: Column) -> Column:
    return F.translate(F.trim(s), "$,", "")


def is_number_text(s: Column) -> Column:
    """Numeric text: a plain number after removing ``$`` and ``,``."""
    return F.coalesce(_digits(s).rlike(NUMBER), F.lit(False))


def to_number(s: Column) -> Column:
    """Numeric value of a text cell (``$`` and ``,`` removed), NULL if not a number."""
    return F.when(is_number_text(s), _digits(s).try_cast("double"))


def numeric_profile(long: DataFrame, keys: Sequence[str], value: str = "value", *more: Column) -> DataFrame:
    """Min / max / avg of the numeric cells per key; text cells ignored.
    ``more`` aggregates are computed in the same pass."""
    v = to_number(F.col(value))
    return long.groupBy(*keys).agg(F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("avg"),
                                   F.count(v).alias("numeric_cells"), *more)
