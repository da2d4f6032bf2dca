"""Joins in which one key may have a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has at least one in HOT rows, so there are at most HOT heavy keys.
HOT = 1000


def looked_up(left: DataFrame, right: DataFrame, key: str, total: int, hot: int = HOT) -> DataFrame:
    """left with right's columns (null where there is none), of which right has one row for each key; left has `total` rows. left is read
    several times. Heavy keys, at most `hot` of them, are looked up in a broadcast table; the others meet in a shuffle, and null keys stay where they are."""
    known = left.where(F.col(key).isNotNull())
    heavy = known.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") * hot >= total).select(key)
    some = F.broadcast(heavy.join(right, key, "left"))
    rest = known.join(F.broadcast(heavy), key, "left_anti").join(right, key, "left")
    none = left.where(F.col(key).isNull()).select("*", *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns if c != key))
    return known.join(some, key).unionByName(rest).unionByName(none)
