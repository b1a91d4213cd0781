"""Walk a parent/child tree (categories) of any depth by path doubling.

Every node first points to its parent.  A round replaces each pointer by the pointer of its target, so
after k rounds it spans 2^k levels: a chain of n nodes takes about log2(n) rounds.  What a pointer jumps over is
kept with it (the number of levels and the list of ids and names), so level and path grow with the pointers.
Each round is one equi-join of the node table with itself, written to the shared folder.

A node is settled when its pointer ends at a root.  Nodes whose parent is missing end nowhere; nodes on a cycle, or below one, never
settle: when no more nodes settle in a round that spans more levels than there are
nodes, what is left is unreachable.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize


def tree_paths(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id", name_col: str = "name",
               max_depth: int | None = None, paths: bool = True) -> DataFrame:
    """(id, name, level, root_id, root_name, path, path_ids, status) for every node.

    Ids are unique.  Nodes that no root reaches (their parent is missing, or they are on a cycle or below
    one) come back with status ``unreachable`` and no level.  A path has a NULL name as empty text.  A
    tree deeper than ``max_depth`` raises; without it any depth is taken.  A path has as many entries as levels,
    so the paths of a chain grow as its square; ``paths=False`` leaves them out and keeps rows narrow.
    """
    tree = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent_id"), F.col(name_col).alias("name"))
    # up: the node that the pointer reaches, NULL beyond a root; top: the last node before it; hops: nodes from top down to the node
    held = {"ids": F.array("id"), "names": F.array(F.coalesce("name", F.lit("")))} if paths else {}
    walk = materialize(tree.select("id", F.col("parent_id").alias("up"), F.lit(False).alias("lost"), F.col("id").alias("top"), F.lit(1).cast("long").alias("hops"),
                                   *(c.alias(k) for k, c in held.items())), "walk")
    n, spans = walk.count(), 1
    while True:
        open_ = walk.where("up IS NOT NULL AND NOT lost")
        if open_.isEmpty():
            break
        if spans > n:  # a path of so many levels repeats a node
            walk = walk.withColumn("lost", F.col("lost") | F.col("up").isNotNull())
            break
        to = walk.select(*(F.col(c).alias(f"_{c}") for c in walk.columns))
        further = open_.join(to, open_.up == to._id, "left").select(
            "id", F.col("_up").alias("up"), (F.col("_id").isNull() | F.col("_lost")).alias("lost"), F.coalesce("_top", "top").alias("top"),
            (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"), *(F.when(F.col("_id").isNull(), F.col(k)).otherwise(F.concat(f"_{k}", k)).alias(k) for k in held))
        walk = materialize(walk.where("up IS NULL OR lost").unionByName(further), "walk")
        spans *= 2
    if max_depth is not None and not walk.where(~F.col("lost") & (F.col("hops") > max_depth)).isEmpty():
        raise ValueError(f"[RECURSION_LEVEL_LIMIT] the tree is deeper than {max_depth} levels")
    known = lambda c: F.when(~F.col("lost"), c)
    found = tree.join(walk, "id").withColumn("root_id", known(F.col("top")))
    roots = tree.select(F.col("id").alias("root_id"), F.col("name").alias("root_name"))
    found = found.join(roots, "root_id", "left")
    more = [known(F.array_join("names", " > ")).alias("path"), known(F.col("ids")).alias("path_ids")] if paths else []
    return found.select("id", "name", known(F.col("hops")).cast("int").alias("level"), "root_id", "root_name", *more,
                        F.when(F.col("lost"), "unreachable").otherwise("ok").alias("status"))


def subtree_totals(walk: DataFrame, own: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(id, measures): for every node the sum over itself and all nodes below it, for any depth.

    ``own`` has at most a few rows per node (id, measures); each counts for
    every node on its path.
    """
    up = own.join(walk.select("id", "path_ids"), "id").select(F.explode("path_ids").alias("id"), *measures)
    return up.groupBy("id").agg(*[F.sum(m).alias(m) for m in measures])
