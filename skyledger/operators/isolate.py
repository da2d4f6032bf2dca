"""Failed ranges narrowed to single rows, level by level, and what can be saved of the rest.

The loop runs on the driver, one Spark job a level; its depth is the logarithm of the debug size. All
else is relational over attempts (execute.ATTEMPT)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ranges as R

GROUP_FAILURE = "group_failed_children_passed"


def debug(failed: DataFrame, run: Callable[[DataFrame], DataFrame], size: int) -> DataFrame:
    """Attempts of the debug ranges of failed chunks. `run` executes ranges and returns attempts that are
    read again without being executed again."""
    return run(R.debug_ranges(failed, size))


def isolate(first: DataFrame, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All attempts from the debug level on: failed ranges are halved until they are one row, or pass."""
    every, level, current = first, 2, first
    while True:
        todo = R.halves(current.where("status = 'failed'"), level)
        if todo.isEmpty():
            return every
        current = run(todo)
        every = every.unionByName(current)
        level += 1


def group_failures(attempts: DataFrame) -> DataFrame:
    """Failed ranges all of whose children passed: their rows only fail together."""
    children = attempts.where("parent_node_id <> ''").groupBy(F.col("parent_node_id").alias("__p")).agg(F.bool_and(F.col("status") == "done").alias("passed"))
    return attempts.where("status = 'failed'").join(children.where("passed"), F.col("node_id") == F.col("__p"), "left_semi")


def failing_rows(attempts: DataFrame) -> DataFrame:
    """Failed leaves of one row."""
    return R.leaves(attempts).where("status = 'failed' and row_end - row_start <= 1")


def unresolved(attempts: DataFrame) -> DataFrame:
    """Failed leaves of several rows."""
    return R.leaves(attempts).where("status = 'failed' and row_end - row_start > 1")


def good_leaves(attempts: DataFrame) -> DataFrame:
    return R.leaves(attempts).where("status = 'done'")


def salvage(parents: DataFrame, attempts: DataFrame) -> DataFrame:
    """Completed chunks, and the good leaves below failed ones, in order of their rows."""
    done = parents.where("status = 'done'").unionByName(good_leaves(attempts))
    return done.orderBy("row_start", "row_end", F.coalesce("debug_level", F.lit(-1)), "chunk")


def in_order(attempts: DataFrame) -> DataFrame:
    return attempts.orderBy("parent_chunk", F.col("debug_level").asc_nulls_first(), "row_start", "row_end", "node_id")
