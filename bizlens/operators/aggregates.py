"""Reusable aggregation operators.

All are single grouped aggregations or operate on already-aggregated frames;
none gathers a group into one task beyond what the grouping itself does
(partial aggregation first).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_by(df: DataFrame, group_cols: Sequence[str], label: str, metric: str, out: str | None = None,
           largest: bool = True) -> DataFrame:
    """Arg-max (or arg-min) of ``metric`` per group, ties broken by ``label``
    ascending (the first seen in calendar / name order).

    Meant for aggregated frames (one row per group × label); implemented as a
    row_number limit, which Spark runs as a partial per-group limit before the
    shuffle.
    """
    order = F.col(metric).desc_nulls_last() if largest else F.col(metric).asc_nulls_last()
    if group_cols:
        w = Window.partitionBy(*group_cols).orderBy(order, F.col(label).asc())
        return (df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
                  .select(*group_cols, F.col(label).alias(out or label)))
    return df.orderBy(order, F.col(label).asc()).limit(1).select(F.col(label).alias(out or label))


def with_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str], total_of: str | None = None,
                label_col: str | None = None, label: str = "TOTAL") -> DataFrame:
    """The detail rows plus one TOTAL row per value of the keys before
    ``total_of`` (or one grand total), from a single GROUPING SETS aggregation.

    ``df`` is at detail grain; ``measures`` are summed.  The label stands in
    ``label_col`` (a string column; ``total_of`` if not given), the other keys
    from ``total_of`` on are NULL in the total rows.
    """
    keys = list(keys)
    total_of = total_of or keys[-1]
    label_col = label_col or total_of
    outer = keys[:keys.index(total_of)]
    inner = keys[keys.index(total_of):]
    g = (df.groupingSets([keys, outer], *keys)
           .agg(*[F.sum(m).alias(m) for m in measures], F.grouping(total_of).alias("_total")))
    cols = [*outer, *[F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(k).cast("string")).alias(k) if k == label_col
                      else F.when(F.col("_total") == 0, F.col(k)).alias(k) for k in inner]]
    return g.select(*cols, *measures)


def pivot_wide(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence, measures: Sequence[str],
               name: str = "{value}_{measure}") -> DataFrame:
    """One row per key, one column per (pivot value, measure); the pivot
    values are given explicitly, so no extra job discovers them."""
    wide = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(*[F.first(m).alias(m) for m in measures])
    # Spark names the columns "<value>" for one measure, "<value>_<measure>" for several.
    src = (lambda v, m: f"`{v}`") if len(measures) == 1 else (lambda v, m: f"`{v}_{m}`")
    return wide.select(*keys, *[F.col(src(v, m)).alias(name.format(value=v, measure=m))
                                for v in values for m in measures])


def corr_guarded(x: str, y: str, digits: int = 3) -> Column:
    """Pearson r as an aggregate: NULL when n <= 1, 0 when a series is constant."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    spread = F.stddev_pop(xd) * F.stddev_pop(yd)
    r = F.try_divide(F.covar_pop(xd, yd), spread)
    return (F.when(F.count(F.lit(1)) <= 1, F.lit(None).cast("double")).when(spread == 0, F.lit(0.0))
             .otherwise(F.round(r, digits)))


def corr_by(df: DataFrame, keys: Sequence[str], x: str, y: str, digits: int = 3, *more: Column) -> DataFrame:
    """N and guarded r per group; ``more`` aggregates are computed in the same pass."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), corr_guarded(x, y, digits).alias("corr"), *more)


def top_k_flags(df: DataFrame, key: str, metric: str, k: int, top: str = "is_top", bottom: str = "is_bottom") -> DataFrame:
    """Flags for the k best and the k worst rows by ``metric`` (ties: smallest key is
    best, largest key is worst).  One bounded scan per end: k keys as an array each."""
    # the other columns as last sort keys change nothing, but keep the plan below the same as
    # that of ``df``, so that its shuffles are done once
    others = [F.col(f"`{c}`") for c in df.columns if c not in (key, metric)]
    best = df.orderBy(F.col(metric).desc_nulls_last(), F.col(key).asc(), *others).limit(k)
    worst = df.orderBy(F.col(metric).asc_nulls_last(), F.col(key).desc(), *others).limit(k)
    keys = lambda rows: F.coalesce(rows.select(F.collect_list(key)).scalar(), F.array())
    return df.select("*", F.array_contains(keys(best), F.col(key)).alias(top), F.array_contains(keys(worst), F.col(key)).alias(bottom))


def customer_stats(lines: DataFrame, key: str = "customer_id", date: str = "date", amount: str = "revenue",
                   count_col: str | None = None) -> DataFrame:
    """Per key: lines (or summed ``count_col``), total amount, first and last date."""
    n = F.sum(count_col) if count_col else F.count(F.lit(1))
    return lines.groupBy(key).agg(n.alias("orders"), F.sum(amount).alias("total"),
                                  F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def half_year_growth(df: DataFrame, keys: Sequence[str], month_col: str, amount: str, *more: Column) -> DataFrame:
    """h1_, h2_ sums and (H2 − H1) / H1 per group (4 dp), 0 when H1 is 0; months 1-6
    are H1.  ``more`` aggregates are computed in the same pass."""
    from ..plans.common import money_div
    h1 = F.sum(F.when(F.month(month_col) <= 6, F.col(amount)).otherwise(0))
    h2 = F.sum(F.when(F.month(month_col) > 6, F.col(amount)).otherwise(0))
    g = df.groupBy(*keys).agg(h1.alias("h1"), h2.alias("h2"), *more)
    return g.withColumn("growth", F.when(F.col("h1") == 0, F.lit(0.0))
                        .otherwise(money_div(F.col("h2") - F.col("h1"), F.col("h1"), 4)))


def annualise(monthly: Column, months: int = 12) -> Column:
    """Annual amount from a monthly one (fixed multiplier, not an average)."""
    return monthly * months
