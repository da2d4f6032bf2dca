"""Row numbers, and contiguous ranges of them: chunks, debug ranges, halves."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from skyledger.sources import storage

from .skew import looked_up

RANGE = "chunk long, parent_chunk long, node_id string, parent_node_id string, debug_level int, row_start long, row_end long, chunk_size long"
SORT_ROWS = 500_000
#: Comparisons a row takes in each of two steps, and sampled keys for each part.
SPLITS, SAMPLES = 200, 16
#: Groups of a median that are broadcast.
FEW_GROUPS = 100_000


def _points(df: DataFrame, keys: tuple[str, ...], rows: int, parts: int) -> list[tuple]:
    """Keys (columns of df) that divide the rows into parts of about one size, in ascending order, from a share of the distinct keys by
    hash: some SAMPLES for each part, however often one repeats. If there are few distinct keys the share may be empty, and is one part."""
    share = max(1, rows // (parts * SAMPLES))
    sample = [tuple(r) for r in df.select(*keys).where(F.pmod(F.xxhash64(*keys), F.lit(share)) == 0).distinct().orderBy(*keys).collect()]
    return list(dict.fromkeys(sample[len(sample) * k // parts] for k in range(1, parts))) if sample else []


def _dealt(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """df with __part: rows of lower parts come before those of higher ones in the order of the keys. Split points are found in
    two steps of at most SPLITS comparisons."""
    n = df.count()
    parts = -(-n // SORT_ROWS) or 1
    points = _points(df, keys, n, min(parts, SPLITS * SPLITS)) if parts > 1 else []
    groups = [points[k : k + SPLITS] for k in range(0, len(points), SPLITS)]
    dealt, key = df.withColumn("__part", F.lit(0)), F.struct(*keys)
    if points:
        kind = df.select(*keys).schema
        literal = lambda point: F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(point, kind, strict=True)))
        before = lambda some: F.size(F.filter(some, lambda p: p <= key))
        inner = df.sparkSession.createDataFrame([(k, g) for k, g in enumerate([[], *groups])], StructType([StructField("__group", IntegerType()), StructField("__points", ArrayType(kind))]))
        dealt = df.withColumn("__group", before(F.array(*(literal(g[0]) for g in groups)))).join(F.broadcast(inner), "__group")
        dealt = dealt.withColumn("__part", F.col("__group") * (SPLITS + 1) + before(F.col("__points"))).drop("__group", "__points")
    return dealt


def running(df: DataFrame, weight: Column, *order: str | Column, out: str) -> DataFrame:
    """df with the sum of the weights (whole numbers) of all rows before each one, in the order of columns or expressions (which
    identify a row). Large frames are dealt by split points of all keys; each part is summed by itself, from
    the sums of the parts before it, so that no task sorts everything, however frequent one value of a key is.
    Results don't depend on how rows are partitioned."""
    keys = tuple(f"__key{k}" for k in range(len(order)))
    df = df.withColumns({**{k: F.col(x) if isinstance(x, str) else x for k, x in zip(keys, order, strict=True)}, "__weight": weight.cast("bigint")})
    dealt = _dealt(df, keys)
    earlier = lambda what, window: F.coalesce(F.sum(what).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = dealt.groupBy("__part").agg(F.sum("__weight").alias("__n")).select("__part", earlier("__n", Window.orderBy("__part")).alias("__before"))
    own = earlier("__weight", Window.partitionBy("__part").orderBy(*keys))
    return dealt.withColumn("__own", own).join(F.broadcast(before), "__part").withColumn(out, F.col("__own") + F.col("__before")).drop("__part", "__own", "__before", "__weight", *keys)


def number_rows(df: DataFrame, *order: str | Column, out: str = "input_row") -> DataFrame:
    """df with 0-based row numbers in the order of columns or expressions (which identify a row)."""
    return running(df, F.lit(1), *order, out=out)


def median(df: DataFrame, value: str, *groups: str) -> DataFrame:
    """groups and the exact median of a number's values that aren't null (null without any), under the value's name. Distinct values are
    counted, put in order together and found by their rank, so no task holds a whole group."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("__times"))
    placed = storage.written(running(counted, F.col("__times"), *groups, value, out="__from").withColumn("__group", F.struct(F.lit(0), *groups)), "ranks")
    whole = storage.written(placed.groupBy("__group").agg(F.min("__from").alias("__first"), F.sum("__times").alias("__all")), "ranks")
    known = placed.join(F.broadcast(whole), "__group") if whole.count() <= FEW_GROUPS else looked_up(placed, whole, "__group", placed.count())
    holds = lambda rank: (F.col("__from") <= F.expr(rank)) & (F.expr(rank) < F.col("__from") + F.col("__times"))
    halves = holds("__first + (__all - 1) div 2").cast("int") + holds("__first + __all div 2").cast("int")
    return known.withColumn("__halves", halves).where("__halves > 0").groupBy(*groups).agg(F.sum(F.col(value) * F.col("__halves") * 0.5).alias(value))


def chunk_of(row: str | Column, size: int) -> Column:
    row = F.col(row) if isinstance(row, str) else row
    return F.floor(row / F.lit(size)).cast("bigint")


def stem(index: Column, lo: Column, hi: Column, kind: str = "chunk_%05d") -> Column:
    """The name of a range: its number, first and last row."""
    return F.format_string(f"{kind}_rows_%07d_%07d", index, lo, hi - 1)


def plan(spark: SparkSession, rows: int, size: int) -> DataFrame:
    """The chunks of so many rows; the last one is short."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    at = spark.range(-(-rows // size)).select(F.col("id").alias("chunk"), (F.col("id") * size).alias("row_start"), F.least((F.col("id") + 1) * size, F.lit(rows)).cast("bigint").alias("row_end"))
    return at.select("chunk", F.col("chunk").alias("parent_chunk"), stem(F.col("chunk"), F.col("row_start"), F.col("row_end")).alias("node_id"), F.lit("").alias("parent_node_id"), F.lit(None).cast("int").alias("debug_level"), "row_start", "row_end", F.lit(size).cast("bigint").alias("chunk_size"))


def parse_selection(spec: str | None) -> set[int] | None:
    """The numbers of a list such as 1,3-5,8; None for none."""
    if spec is None:
        return None
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in spec.split(","))):
        m = re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", part)
        if not m:
            raise ValueError(f"not a chunk number or range: {part}")
        lo, hi = int(m[1]), int(m[2] or m[1])
        if hi < lo:
            raise ValueError(f"a range of chunks must ascend: {part}")
        out.update(range(lo, hi + 1))
    if not out:
        raise ValueError("no chunk is selected")
    return out


def select_chunks(rows: DataFrame, chunks: set[int], column: str = "chunk") -> DataFrame:
    return rows.where(F.col(column).isin(sorted(chunks)))


def debug_ranges(failed: DataFrame, size: int) -> DataFrame:
    """Failed ranges cut into pieces of `size` rows, counted from each one's first row."""
    lo = F.explode(F.expr(f"sequence(row_start, row_end - 1, {int(size)}L)")).alias("lo")
    at = failed.where("row_end > row_start").select("chunk", "node_id", "row_start", F.col("row_end").alias("last"), lo)
    hi = F.least(F.col("lo") + size, F.col("last"))
    index = F.floor((F.col("lo") - F.col("row_start")) / size).cast("bigint")
    name = F.format_string("chunk_%05d_debug_%04d_rows_%07d_%07d", F.col("chunk"), index, F.col("lo"), hi - 1)
    return at.select(index.alias("chunk"), F.col("chunk").alias("parent_chunk"), name.alias("node_id"), F.col("node_id").alias("parent_node_id"), F.lit(1).alias("debug_level"), F.col("lo").alias("row_start"), hi.alias("row_end"), F.lit(size).cast("bigint").alias("chunk_size"))


def halves(failed: DataFrame, level: int) -> DataFrame:
    """The two halves of each failed range of two or more rows."""
    mid = F.expr("row_start + (row_end - row_start) div 2")
    part = F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("row_start").alias("lo"), mid.alias("hi")), F.struct(F.lit(1).alias("k"), mid.alias("lo"), F.col("row_end").alias("hi")))).alias("p")
    at = failed.where("row_end - row_start > 1").select("parent_chunk", "node_id", part)
    name = F.format_string("chunk_%05d_isolate_%02d_rows_%07d_%07d", F.col("parent_chunk"), F.lit(level), F.col("p.lo"), F.col("p.hi") - 1)
    return at.select(F.col("p.lo").alias("chunk"), "parent_chunk", name.alias("node_id"), F.col("node_id").alias("parent_node_id"), F.lit(level).alias("debug_level"), F.col("p.lo").alias("row_start"), F.col("p.hi").alias("row_end"), (F.col("p.hi") - F.col("p.lo")).alias("chunk_size"))


def rows_in(ranges: DataFrame, rows: DataFrame, step: int, row: str = "input_row") -> DataFrame:
    """Rows joined with the ranges [row_start, row_end) they lie in. Ranges are spread over buckets of
    `step` rows, so this is a join on equal buckets with a range condition and not a nested loop."""
    buckets = ranges.where("row_end > row_start").withColumn("__bucket", F.explode(F.expr(f"sequence(row_start div {int(step)}, (row_end - 1) div {int(step)})")))
    placed = rows.withColumn("__bucket", F.expr(f"`{row}` div {int(step)}"))
    return buckets.join(placed, "__bucket").where((F.col(row) >= F.col("row_start")) & (F.col(row) < F.col("row_end"))).drop("__bucket")


def leaves(nodes: DataFrame, node: str = "node_id", parent: str = "parent_node_id") -> DataFrame:
    """Nodes that are no one's parent."""
    parents = nodes.select(F.col(parent).alias("__p")).where("__p is not null").distinct()
    return nodes.join(parents, F.col(node) == F.col("__p"), "left_anti")
