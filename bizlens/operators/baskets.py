"""Co-purchase counting without a row-level self join.

The reference counts pairs of *item rows* (i, j) of one order with
``product_i < product_j``, grouped by the unordered pair of product *names*.
Per order, with M(n) = item rows whose product is named n and S(n) = the sum
over those products of (rows of that product)², that count is

* M(a) · M(b)             for two different names a < b (different names means
                          different products, and exactly one orientation has
                          the smaller product id first);
* (M(a)² − S(a)) / 2      for the same name on two different products.

So items are first reduced to one row per (order, name).  Both reductions are
partial aggregations (a hot order collapses map-side).  The names of an order
are dealt into blocks of about ``BLOCK_NAMES`` and the join runs per (order,
block, block): a wide order's pairs are spread over many join keys, so over
many tasks, while an order of ordinary width is one block.  The count per name
pair is again partially aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_NAMES = 512


def name_pair_counts(items: DataFrame, names: DataFrame, min_count: int = 2,
                     order_col: str = "order_id", product_col: str = "product_id",
                     name_col: str = "name", block_names: int = BLOCK_NAMES) -> DataFrame:
    """(product_a <= product_b, times_bought_together) over name pairs, >= min_count."""
    per_product = (items.join(names, product_col)
                        .groupBy(F.col(order_col).alias("_o"), F.col(name_col).alias("_nm"), product_col)
                        .agg(F.count(F.lit(1)).alias("_m")))
    per_name = (per_product.groupBy("_o", "_nm")
                           .agg(F.sum("_m").alias("_M"), F.sum(F.col("_m") * F.col("_m")).alias("_S")))
    blocks = per_name.groupBy("_o").agg(F.ceil(F.count(F.lit(1)) / block_names).cast("int").alias("_k"))
    dealt = per_name.join(blocks, "_o").withColumn("_b", F.pmod(F.xxhash64("_nm"), F.col("_k")).cast("int"))
    # the left copy of block i meets the right copies of blocks i, i + 1, ...: each pair of names once
    left = dealt.select("_o", F.col("_b").alias("_i"), F.explode(F.sequence("_b", F.col("_k") - 1)).alias("_j"),
                        F.col("_nm").alias("_x"), F.col("_M").alias("_Mx"), "_S")
    right = dealt.select("_o", F.explode(F.sequence(F.lit(0), "_b")).alias("_i"), F.col("_b").alias("_j"),
                         F.col("_nm").alias("_y"), F.col("_M").alias("_My"))
    pairs = left.join(right, ["_o", "_i", "_j"]).where((F.col("_i") < F.col("_j")) | (F.col("_x") <= F.col("_y")))
    together = F.when(F.col("_x") == F.col("_y"), (F.col("_Mx") * F.col("_Mx") - F.col("_S")) / 2) \
                .otherwise(F.col("_Mx") * F.col("_My")).cast("long")
    counted = pairs.select(F.least("_x", "_y").alias("product_a"), F.greatest("_x", "_y").alias("product_b"),
                           together.alias("_n")).where(F.col("_n") > 0)
    return (counted.groupBy("product_a", "product_b").agg(F.sum("_n").alias("times_bought_together"))
                   .where(F.col("times_bought_together") >= min_count))
