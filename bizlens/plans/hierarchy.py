"""G4 over the data: a category tree (regions -> nations) with the number of
customers and the revenue in each subtree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hierarchy import subtree_totals, tree_paths
from . import views as V
from .customers import customer_totals


def category_tree(t) -> DataFrame:
    """Nodes: regions are roots (id = region key), nations are children (id = 100 + nation key)."""
    r, n = t["region"], t["nation"]
    roots = r.select(F.col("r_regionkey").cast("long").alias("id"), F.lit(None).cast("long").alias("parent_id"),
                     F.col("r_name").alias("name"))
    kids = n.select((F.col("n_nationkey") + 100).cast("long").alias("id"),
                    F.col("n_regionkey").cast("long").alias("parent_id"), F.col("n_name").alias("name"))
    return roots.unionByName(kids)


def tree_rollup(t) -> DataFrame:
    """Each node with level, root, path, and customers / revenue of its subtree."""
    walk = tree_paths(category_tree(t))
    c = V.customers(t).select("customer_id", (F.col("nation_id") + 100).cast("long").alias("id"))
    spend = customer_totals(t).select("customer_id", "lifetime_spend")
    own = (c.join(spend, "customer_id", "left").groupBy("id")
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.coalesce(F.sum("lifetime_spend"), F.lit(0)).alias("revenue")))
    totals = subtree_totals(walk, own, ["customers", "revenue"])
    return walk.join(totals, "id", "left").select(
        "id", "name", "level", "root_name", "path",
        F.coalesce("customers", F.lit(0)).alias("customers"), F.coalesce("revenue", F.lit(0)).alias("revenue"))
