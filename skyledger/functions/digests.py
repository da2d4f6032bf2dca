"""Digests of frames and of run contexts, and names that are safe in paths."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF_ROWS = 10_000


def row_digest(df: DataFrame) -> Column:
    """sha256 of a row's columns and values."""
    return F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}), 256)


def combined(parts: Column) -> Column:
    """sha256 of an array of numbered digests (n, h)."""
    return F.sha2(F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["n"].cast("string"), x["h"])), ","), 256)


def frame_digest(*frames: DataFrame, row: str = "input_row") -> str:
    """sha256 over the columns and rows of frames numbered by `row`. It depends on the rows' numbers, not on
    partitions: rows are hashed in place, leaves of LEAF_ROWS consecutive rows are combined by shuffle,
    and only one digest for each thousand leaves reaches the driver."""
    whole = hashlib.sha256()
    for df in frames:
        whole.update("\0".join(df.columns).encode())
        level = df.select(F.col(row).cast("bigint").alias("n"), row_digest(df).alias("h"))
        for width in (LEAF_ROWS, 1000):
            leaf = F.array_sort(F.collect_list(F.struct("n", "h")))
            level = level.groupBy(F.expr(f"n div {width}").alias("n2")).agg(combined(leaf).alias("h")).select(F.col("n2").alias("n"), "h")
        for r in level.orderBy("n").collect():
            whole.update(r["h"].encode())
    return whole.hexdigest()


def path_fingerprint(path: str | Path) -> str:
    """A path with its file's size and modification time, or `missing`."""
    p = Path(path).expanduser().resolve()
    if not p.exists():
        return f"{p}:missing"
    stat = p.stat()
    return f"{p}:{stat.st_size}:{stat.st_mtime_ns}"


def context_digest(**facts: object) -> str:
    """sha256 of facts in the order of their names."""
    return hashlib.sha256("\0".join(f"{k}={facts[k]}" for k in sorted(facts)).encode()).hexdigest()


def safe_token(text: str, default: str, most: int = 80) -> str:
    """text with all but letters, digits, - and _ replaced, cut to `most` characters."""
    return "".join(c if c.isalnum() or c in "-_" else "_" for c in text)[:most] or default
