"""Exact order statistics per group, without a group's values in one task.

``percentile`` keeps a map of all distinct values of a group in the memory of one task.  Here a group's
values are counted (group, value), range-partitioned by (group, value), and numbered by running sums
that go on from partition to partition, so a group may hold any number of
distinct values: it spreads over as many partitions as it needs.  The wanted ranks are then a filter,
and the two neighbours of a fractional rank are interpolated.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def group_percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """(keys, p0, p1, ...): the continuous percentiles ``shares`` of ``value`` for each group, as doubles.

    NULL values don't count; a group without values has NULL percentiles; NULL keys make a group.  Equal
    values are one row with their number.
    """
    keys = list(keys)
    counted = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.withColumn("_n", F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0))
    placed = materialize(counted.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()), "counts")
    # one row a (group, partition): what stands in the group's earlier partitions
    parts = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_here"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    parts = materialize(parts.select(*keys, "_part", F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_before"), F.sum("_here").over(whole).alias("_all")), "offsets")
    same = F.col("a._part") == F.col("b._part")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    joined = placed.alias("a").join(parts.alias("b"), same).select(*(F.col(f"a.{k}").alias(k) for k in keys), "a._part", "_v", "_n", "_before", "_all")
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_part", *keys).orderBy("_v"))
    ranked = joined.select(*keys, "_v", "_all", upto.alias("_upto"), (upto - F.col("_n")).alias("_from"))

    out = []
    for i, share in enumerate(shares):
        place = F.lit(float(share)) * (F.col("_all") - 1)  # ranks count from 0
        low = F.floor(place)
        holds = lambda rank: (F.col("_from") <= rank) & (rank < F.col("_upto"))
        at = lambda rank: F.max(F.when(holds(rank), F.col("_v").cast("double")))
        below, above = at(low), at(F.ceil(place))
        part = F.max(place - low)
        out.append((below + (above - below) * part).alias(f"p{i}"))
    return ranked.groupBy(*keys).agg(*out)
