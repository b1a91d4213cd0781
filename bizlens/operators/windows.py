"""Window operators (inventory section E).

Windows over a *calendar* aggregate (months, days) are tiny and use a plain
``Window.orderBy``.  Windows that order *all* customers or products globally
(row number, NTILE, cumulative share, running maximum) must not funnel every
row into one task, so they go through :func:`global_running`, one path for
every size:

1. ``repartitionByRange`` on the full (unique) sort key; tag each row with its
   partition id;
2. reliable ``checkpoint`` into the cluster's checkpoint folder, so partition
   bounds are the same in the two steps that follow, also if executors are lost;
3. an ordinary window per partition id (JVM, types kept) gives local row
   numbers and running values;
4. one row per partition (count, total) is turned into offsets and sent to the
   rows: its size is bounded by the number of partitions, not by the data.

NULLs are ordinary values: a NULL key is ordered last, a running sum or
maximum is NULL until its first non-NULL value.  Ties are the caller's
business: pass a unique tie-break column last.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import default_parallelism, ensure_checkpoint_dir
from ..sources.scratch import materialize

# (column name, ascending)
OrderKey = tuple[str, bool]


def _sort_exprs(keys: Sequence[OrderKey]) -> list[Column]:
    # NULL placement is spelled out so every engine agrees: nulls last.
    return [F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in keys]


def order_report(df: DataFrame, keys: Sequence[OrderKey]) -> DataFrame:
    """a report in its declared order (mixed directions, NULLs last)."""
    return df.orderBy(*_sort_exprs(keys))


def sort_calendar(df: DataFrame, month_name: str, *first: str) -> DataFrame:
    """rows by the columns ``first`` and then by calendar month, never by the
    month's name (January before April); unknown names come last."""
    number = F.month(F.try_to_date(F.concat(F.lit("2000 "), F.col(month_name), F.lit(" 1")), "yyyy MMMM d"))
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in first], number.asc_nulls_last(), F.col(month_name).asc_nulls_last())


def ntile_from_rank(rn: Column, total: Column, k: int) -> Column:
    """E5: NTILE(k) computed from a global 1-based row number and the row count.

    SQL semantics: the first ``N % k`` tiles get one row more than the others.
    """
    q = (total / k).cast("long")
    r = total % k
    big = r * (q + 1)
    return F.when(rn <= big, ((rn - 1) / (q + 1)).cast("long") + 1) \
            .otherwise(r + ((rn - 1 - big) / F.greatest(q, F.lit(1))).cast("long") + 1).cast("long")


def _combine(kind: str, before: Column, here: Column) -> Column:
    """The running value from what lies before the partition and inside it; NULL only if both are."""
    both = before + here if kind == "sum" else F.greatest(before, here)
    return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(both)


def global_running(df: DataFrame, keys: Sequence[OrderKey], runs: Mapping[str, tuple[str, str]] | None = None, *,
                   rn_col: str | None = None, total_col: str | None = None,
                   totals: Mapping[str, str] | None = None, partitions: int | None = None) -> DataFrame:
    """Running values over all rows in the order of ``keys`` (which must identify rows).

    ``runs`` maps a new column to ``("sum" | "max", source)`` with a ROWS frame up
    to the current row; ``rn_col`` is the row number, ``total_col`` the row count,
    and ``totals`` maps new columns to sources that are summed over all rows.
    """
    runs, totals = dict(runs or {}), dict(totals or {})
    ensure_checkpoint_dir(df.sparkSession)
    sort = _sort_exprs(keys)
    fold = {"sum": F.sum, "max": F.max}
    ranged = (df.repartitionByRange(partitions or default_parallelism(df.sparkSession), *sort)
                .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))

    stats = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"),
                                       *[fold[kind](src).alias(f"_r_{dst}") for dst, (kind, src) in runs.items()],
                                       *[F.sum(src).alias(f"_t_{dst}") for dst, src in totals.items()])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = stats.select(  # one row per partition
        "_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long").alias("_off"),
        F.sum("_cnt").over(everything).cast("long").alias("_all"),
        *[fold[kind](f"_r_{dst}").over(before).alias(f"_b_{dst}") for dst, (kind, _) in runs.items()],
        *[F.sum(f"_t_{dst}").over(everything).alias(f"_s_{dst}") for dst in totals])

    here = Window.partitionBy("_pid").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", F.row_number().over(Window.partitionBy("_pid").orderBy(*sort)).cast("long").alias("_rn"),
                          *[fold[kind](src).over(here).alias(f"_l_{dst}") for dst, (kind, src) in runs.items()])
    joined = local.join(F.broadcast(offsets), "_pid")
    out = [F.col(f"`{c}`") for c in df.columns]
    if rn_col:
        out.append((F.col("_off") + F.col("_rn")).alias(rn_col))
    for dst, (kind, src) in runs.items():
        plain = df.select(fold[kind](src)).schema.fields[0].dataType
        out.append(_combine(kind, F.col(f"_b_{dst}"), F.col(f"_l_{dst}")).cast(plain).alias(dst))
    if total_col:
        out.append(F.col("_all").alias(total_col))
    for dst, src in totals.items():
        out.append(F.col(f"_s_{dst}").cast(df.select(F.sum(src)).schema.fields[0].dataType).alias(dst))
    return joined.select(*out)


def global_row_window(df: DataFrame, keys: Sequence[OrderKey], *, rn_col: str = "row_num",
                      cum: tuple[str, str] | None = None, total_col: str | None = None,
                      partitions: int | None = None) -> DataFrame:
    """Global ``ROW_NUMBER() OVER (ORDER BY keys)`` and optional running sum
    ``cum = (source, new column)`` (ROWS frame) and row count."""
    return global_running(df, keys, {cum[1]: ("sum", cum[0])} if cum else None, rn_col=rn_col, total_col=total_col,
                          partitions=partitions)


def global_peer_cumsum(df: DataFrame, peer_col: str, ascending: bool, src: str, dst: str) -> DataFrame:
    """``SUM(src) OVER (ORDER BY peer_col)`` with the default RANGE frame: equal
    values of ``peer_col`` (peers, NULLs among them) share one cumulative value.

    Peers are first collapsed by a partial aggregation (a hot value costs one
    row), the running sum runs over distinct values, and the result is joined
    back on the value (NULL-safe; AQE splits a hot value).
    """
    per_value = df.groupBy(F.col(peer_col).alias("_peer")).agg(F.sum(src).alias("_peer_sum"))
    plain = df.select(F.sum(src)).schema.fields[0].dataType
    run = global_running(per_value, [("_peer", ascending)], {dst: ("sum", "_peer_sum")})
    run = run.select("_peer", F.col(dst).cast(plain).alias(dst))
    return df.join(run, F.col(peer_col).eqNullSafe(F.col("_peer")), "left").drop("_peer")


def global_ntile(df: DataFrame, keys: Sequence[OrderKey], k: int, out_col: str) -> DataFrame:
    """E5: ``NTILE(k) OVER (ORDER BY keys)`` without a single-task window."""
    ranked = global_row_window(df, keys, rn_col="_rn_", total_col="_n_")
    return ranked.withColumn(out_col, ntile_from_rank(F.col("_rn_"), F.col("_n_"), k)).drop("_rn_", "_n_")


def _later(keys: Sequence[OrderKey], bound: Column) -> Column:
    """Whether a row comes after the row of ``bound`` (a struct of the keys) in the order of ``keys``, NULLs last."""
    out = F.lit(False)
    for c, asc in reversed(keys):
        x, y = F.col(f"`{c}`"), bound[c]
        after = y.isNotNull() & (x.isNull() | F.coalesce(x > y if asc else x < y, F.lit(False)))
        out = after | (x.eqNullSafe(y) & out)
    return out


def global_ntiles(df: DataFrame, orderings: dict[str, Sequence[OrderKey]], k: int) -> DataFrame:
    """E5 for several orderings (RFM): ``{out_col: keys}``; the keys of an ordering identify rows.

    The keys alone, a narrow row for each ordering, are dealt by one range partitioning on (ordering, its
    keys), which numbers them all.  Only the last row of each tile goes on, k - 1 an ordering; the rows themselves get
    their tiles by comparing with these, without a shuffle of their own.  ``df`` is written once.
    """
    df = materialize(df, "ntiles")
    fields = [(no, c, asc, f"_{no}_{i}") for no, keys in enumerate(orderings.values()) for i, (c, asc) in enumerate(keys)]
    narrow = [df.select(F.lit(no).alias("_no"), *((F.col(f"`{c}`") if at == no else F.lit(None).cast(df.schema[c].dataType)).alias(name)
                                                  for at, c, _, name in fields)) for no in range(len(orderings))]
    ranked = global_running(reduce(DataFrame.unionByName, narrow), [("_no", True), *((name, asc) for _, _, asc, name in fields)],
                            rn_col="_rn", total_col="_all")
    n = (F.col("_all") / len(orderings)).cast("long")   # each ordering has every row once
    ends = F.array(*(i * (n / k).cast("long") + F.least(F.lit(i), n % k) for i in range(1, k))).cast("array<bigint>")
    last = (ranked.withColumn("_tiles", F.size(F.filter(ends, lambda e: e == F.col("_rn") - F.col("_no") * n)))  # several, where rows are fewer than tiles
                  .where(F.col("_tiles") > 0))
    bounds = last.agg(*(F.collect_list(F.when(F.col("_no") == no, F.struct("_tiles", *(F.col(name).alias(c) for at, c, _, name in fields if at == no)))).alias(f"_{no}")
                        for no in range(len(orderings))))
    found = df.withColumn("_bounds", bounds.select(F.struct(*bounds.columns)).scalar())

    def tile(no, keys):
        passed = F.filter(F.col(f"_bounds._{no}"), lambda end: _later(keys, end))
        return F.aggregate(passed, F.lit(1), lambda n, end: n + end["_tiles"]).cast("long")

    return found.select(*(F.col(f"`{c}`") for c in df.columns), *(tile(no, keys).alias(out) for no, (out, keys) in enumerate(orderings.items())))


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], keys: Sequence[OrderKey], n: int,
                    rank_col: str = "rank_in_group") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY g ORDER BY …) <= n``.

    Planned as a WindowGroupLimit: each task keeps only n rows per group before
    the window, so a hot group costs n rows after the partial pass.
    """
    w = Window.partitionBy(*group_cols).orderBy(*_sort_exprs(keys))
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= n)


def frame_total(df: DataFrame, value: str) -> Column:
    """Sum of ``value`` over the frame as a scalar of the same plan.

    The scalar's aggregate reads every column of the frame, so that its input
    is the very plan of ``df`` and the shuffles are done once (exchange reuse).
    """
    others = [F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns) if c != value]
    return df.select(F.struct(F.sum(value).alias("_total"), *others)).scalar()["_total"]


def share_of_total(df: DataFrame, value: str, out: str, partition_cols: Sequence[str] = (),
                   scale: int = 2, as_fraction: bool = False) -> DataFrame:
    """Value × 100 / total (or a fraction), 0 when the total is 0.

    The total is an aggregate joined back by key, or a scalar in the same plan;
    no window gathers the whole frame in one task and nothing is written.
    """
    factor = 1 if as_fraction else 100
    if partition_cols:
        totals = df.groupBy(*partition_cols).agg(F.sum(value).alias("_tot"))
        j = df.join(totals, list(partition_cols), "left")
    else:
        j = df.withColumn("_tot", frame_total(df, value))
    dtype = df.schema[value].dataType
    exact = isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale <= 2)
    if exact:
        # money and counts: exact half-up rounding in integer arithmetic
        from ..plans.common import money_div
        ratio = money_div(F.col(value) * factor, F.col("_tot"), scale)
    else:
        ratio = F.round(F.try_divide(F.col(value) * factor, F.col("_tot")), scale)
    return j.withColumn(out, F.when(F.col("_tot") == 0, F.lit(0.0)).otherwise(ratio)).drop("_tot")


def running_total(df: DataFrame, order_col: str, value: str, out: str) -> DataFrame:
    """E1/E2 on a calendar aggregate (small by construction)."""
    w = Window.orderBy(F.col(order_col).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def moving_average(df: DataFrame, order_col: str, value: str, out: str, rows: int = 3, digits: int | None = None) -> DataFrame:
    """``AVG OVER (ORDER BY … ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW)``;
    with ``digits`` the average of money or counts is rounded exactly."""
    w = Window.orderBy(F.col(order_col).asc_nulls_last()).rowsBetween(-(rows - 1), Window.currentRow)
    if digits is None:
        return df.withColumn(out, F.avg(value).over(w))
    from ..plans.common import money_div
    return df.withColumn(out, money_div(F.sum(value).over(w), F.count(value).over(w), digits))


def lag_rows(df: DataFrame, order_col: str, value: str, out: str, offset: int) -> DataFrame:
    """``LAG(value, offset) OVER (ORDER BY order_col)`` (rows, not calendar)."""
    w = Window.orderBy(F.col(order_col).asc_nulls_last())
    return df.withColumn(out, F.lag(value, offset).over(w))


def lag_calendar(df: DataFrame, month_col: str, value: str, out: str, months: int = 12) -> DataFrame:
    """E4 strict form: value of exactly ``months`` calendar months earlier (self-join)."""
    prior = df.select(F.add_months(F.col(month_col), months).alias(month_col), F.col(value).alias(out))
    return df.join(prior, month_col, "left")


def global_rank(df: DataFrame, peer_col: str, ascending: bool, out_col: str = "rank", dense: bool = False) -> DataFrame:
    """``RANK()`` / ``DENSE_RANK() OVER (ORDER BY peer_col NULLS LAST)`` without a
    single-task window; rows with a NULL key are ranked too.

    Rows are counted per distinct value (partial aggregation: a hot value is
    one row), a running count over the distinct values gives each value the
    number of rows before it, and the rank is joined back on the value.
    """
    per_value = df.groupBy(F.col(peer_col).alias("_peer")).agg(F.count(F.lit(1)).alias("_peers"))
    run = global_running(per_value, [("_peer", ascending)], {"_upto": ("sum", "_peers")}, rn_col="_dense")
    r = F.col("_dense") if dense else (F.col("_upto") - F.col("_peers") + 1)
    run = run.select("_peer", r.cast("long").alias(out_col))
    return df.join(run, F.col(peer_col).eqNullSafe(F.col("_peer")), "left").drop("_peer")


def renumber(df: DataFrame, keys: Sequence[OrderKey], out_col: str, prefix: str = "ORD-", width: int = 5) -> DataFrame:
    """sequence labels in sort order (``ORD-00001`` …), from a global row number;
    numbers wider than ``width`` are kept whole."""
    ranked = global_row_window(df, keys, rn_col="_seq")
    seq = F.col("_seq").cast("string")
    label = F.concat(F.lit(prefix), F.lpad(seq, F.greatest(F.length(seq), F.lit(width)), F.lit("0")))
    return ranked.withColumn(out_col, label).drop("_seq")
