"""Merkle trees of numbered frames, kept as tables, and what differs between two of them.

A leaf is the digest of so many consecutive rows, a node that of so many nodes below it. Two trees are
compared from the top: of each level only the children of nodes that differ are read, so equal parts of two large
frames cost nothing but their topmost nodes. Differing leaves lead to the rows themselves.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.digests import combined, row_digest
from skyledger.sources import storage

from . import ranges as R

LEAF_ROWS, FAN = 10_000, 100
#: Consecutive nodes of a level that are written together.
TOGETHER = 100_000
#: Ranges that a scan is given as a predicate, which prunes files and row groups; beyond, they are joined.
MOST_RANGES = 500


@dataclass(frozen=True)
class Tree:
    """The folder of a tree's levels (0: leaves), rows of a leaf, nodes of a node, and the topmost level."""

    spark: SparkSession
    at: str
    leaf: int
    fan: int
    top: int

    def level(self, k: int) -> DataFrame:
        """node, digest, rows of one level."""
        return self.spark.read.schema("node long, digest string, rows long").parquet(f"{self.at}/level-{k:02d}")

    def root(self) -> str:
        """One digest of everything; empty for a frame without rows."""
        return "".join(r["digest"] for r in self.level(self.top).orderBy("node").collect())


def build(df: DataFrame, at: str | None = None, row: str = "input_row", leaf: int = LEAF_ROWS, fan: int = FAN) -> Tree:
    """The tree of a frame whose rows are numbered from 0 by `row`; it doesn't depend on how they are partitioned. A
    frame without rows has one empty level."""
    spark = df.sparkSession
    at = at or storage.fresh(spark, "digests")
    below = df.select(F.col(row).cast("bigint").alias("node"), row_digest(df).alias("digest"), F.lit(1).cast("bigint").alias("rows"))
    top = -1
    while True:
        top += 1
        own = F.array_sort(F.collect_list(F.struct(F.col("node").alias("n"), F.col("digest").alias("h"))))
        level = below.groupBy(F.expr(f"node div {leaf if top == 0 else fan}").alias("parent")).agg(combined(own).alias("digest"), F.sum("rows").alias("rows"))
        level = level.select(F.col("parent").alias("node"), "digest", "rows")
        # runs of nodes lie together in a file, so that a scan for few of them skips the others
        level.repartition(F.expr(f"node div {TOGETHER}")).sortWithinPartitions("node").write.parquet(f"{at}/level-{top:02d}")
        tree = Tree(spark, at, leaf, fan, top)
        below = tree.level(top)
        if below.limit(2).count() < 2:
            return tree


def reopened(spark: SparkSession, at: str, leaf: int = LEAF_ROWS, fan: int = FAN) -> Tree:
    """A tree that build() wrote to a folder."""
    return Tree(spark, at, leaf, fan, sum(name.startswith("level-") for name in storage.listed(spark, at)) - 1)


def _runs(numbers: Iterable[int]) -> list[tuple[int, int]]:
    """Ascending whole numbers as ranges, ends exclusive."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and out[-1][1] == n:
            out[-1][1] = n + 1
        else:
            out.append([n, n + 1])
    return [(a, b) for a, b in out]


def _below(df: DataFrame, column: str, nodes: DataFrame, width: int) -> DataFrame:
    """Rows of df whose column lies below one of the nodes, each of which covers `width` values."""
    few = nodes.limit(MOST_RANGES + 1).collect()
    if len(few) <= MOST_RANGES:
        c = F.col(column)
        within: list[Column] = [(c >= a * width) & (c < b * width) for a, b in _runs(r["node"] for r in few)]
        return df.where(reduce(or_, within, F.lit(False)))
    return df.withColumn("__node", F.expr(f"`{column}` div {width}")).join(nodes.withColumnRenamed("node", "__node"), "__node", "left_semi").drop("__node")


def differing_leaves(a: Tree, b: Tree) -> tuple[DataFrame, list[tuple[int, int]]]:
    """node of every leaf that is not the same in both, and how many nodes were compared on each level, from the top."""
    if (a.leaf, a.fan) != (b.leaf, b.fan):
        raise ValueError("trees of different shapes can't be compared")
    nodes, compared = None, []
    for k in range(min(a.top, b.top), -1, -1):
        left, right = (t.level(k).select("node", "digest") if nodes is None else _below(t.level(k).select("node", "digest"), "node", nodes, a.fan) for t in (a, b))
        both = left.withColumnRenamed("digest", "l").join(right.withColumnRenamed("digest", "r"), "node", "full")
        both = storage.written(both.select("node", (~F.col("l").eqNullSafe(F.col("r"))).alias("bad")), "digests")
        nodes = both.where("bad").select("node")
        compared.append((k, both.count()))
        if nodes.isEmpty():
            break
    return nodes, compared


def runs_of(rows: DataFrame, row: str = "row") -> DataFrame:
    """Distinct row numbers as row_start, row_end (exclusive) of the longest ranges: first and last rows are those without
    a neighbour, and the n-th first belongs to the n-th last."""
    edge = lambda step: rows.join(rows.select((F.col(row) + step).alias(row)), row, "left_anti")
    first = R.number_rows(edge(1).select(F.col(row).alias("row_start")), "row_start", out="__n")
    last = R.number_rows(edge(-1).select((F.col(row) + 1).alias("row_end")), "row_end", out="__n")
    return first.join(last, "__n").select("row_start", "row_end")


def differing_rows(a: DataFrame, b: DataFrame, left: Tree, right: Tree, row: str = "input_row") -> DataFrame:
    """row_start, row_end (exclusive) of the ranges of rows that are not the same in both frames, or only in one of them. Only rows below differing leaves are read."""
    leaves, _ = differing_leaves(left, right)
    digests = [_below(df, row, leaves, left.leaf).select(F.col(row).cast("bigint").alias("row"), row_digest(df).alias(name)) for df, name in ((a, "l"), (b, "r"))]
    bad = digests[0].join(digests[1], "row", "full").where(~F.col("l").eqNullSafe(F.col("r"))).select("row")
    return runs_of(storage.written(bad, "digests"))
