"""Roots, depths and paths of the nodes of trees, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources import storage

from .skew import looked_up

#: Rounds after which pointers that still move are a circle: trees of 2**MOST_ROUNDS levels are beyond any path.
MOST_ROUNDS = 40


def lineage(nodes: DataFrame, node: str = "node_id", parent: str = "parent_node_id") -> DataFrame:
    """node, root, depth (0 for a root) and path (nodes from root to node, an array) of every distinct node. A
    node whose parent is null or not among the nodes is a root. Every round follows each pointer to where that one points, so a tree of
    n levels takes about log2(n) of them; parents that very many nodes share are looked up without a shuffle. A circle of
    parents is an error."""
    known = nodes.select(F.col(node).alias("node"), F.col(parent).alias("up")).where("node is not null").dropDuplicates(["node"])
    there = known.select(F.col("node").alias("up"), F.lit(True).alias("__known"))
    known = storage.written(known, "lineage")
    at = looked_up(known, there, "up", known.count())
    up = F.when(F.col("__known"), F.col("up"))
    at = storage.written(at.select("node", up.alias("up"), up.isNotNull().cast("int").alias("depth"), F.array("node").alias("path")), "lineage")
    for _ in range(MOST_ROUNDS):
        open_ = at.where("up is not null")
        n = open_.count()
        if not n:
            return at.select(F.col("node").alias(node), F.element_at("path", 1).alias("root"), "depth", "path")
        above = at.select(F.col("node").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"), F.col("path").alias("__path"))
        met = looked_up(open_, above, "up", n).select("node", F.col("__up").alias("up"), (F.col("depth") + F.col("__depth")).alias("depth"), F.concat("__path", "path").alias("path"))
        at = storage.written(met.unionByName(at.where("up is null")), "lineage")
    raise ValueError("parents form a circle")
