"""The baseline of known objects as a bucketed table.

Rows lie in buckets of object_id, so a diff joins them where they lie and shuffles only the catalog; a new
version writes only the buckets that changed, each under the number of the version that wrote it. Which version of each bucket
counts is a list of numbers in the state file, so replacing that file changes all of them at once, and what a failed run left is never read.
The tables are external ones of the session catalog, named by folder and versions; nothing but metadata is in them.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import relational as Q

from . import storage

#: Rows that a bucket is meant for, and the least number of buckets; a table with too few is written anew.
ROWS, LEAST = 1_000_000, 8


@dataclass(frozen=True)
class Held:
    """A baseline: its folder, and for each bucket the version that wrote it."""

    at: str
    versions: tuple[int, ...]

    @property
    def buckets(self) -> int:
        return len(self.versions)


def bucket_of(buckets: int, column: str = "object_id") -> Column:
    """The bucket that Spark writes a value to."""
    return F.pmod(F.hash(column), F.lit(buckets))


def _table(spark: SparkSession, at: str, buckets: int, partitions: str = "") -> str:
    """An external table over a folder, bucketed by object_id; its name tells all of that."""
    known = hashlib.sha256(f"{at}|{buckets}|{partitions}".encode()).hexdigest()[:16]
    name, place = f"spark_catalog.default.skyledger_baseline_{known}", at.replace("\\", "\\\\").replace("'", "\\'")
    columns = "object_id STRING, element_hash STRING" + ", version INT" * bool(partitions)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {'PARTITIONED BY (version)' if partitions else ''} CLUSTERED BY (object_id) SORTED BY (object_id) INTO {buckets} BUCKETS LOCATION '{place}'")
    return name


def read(spark: SparkSession, held: Held) -> DataFrame:
    """object_id, element_hash; partitioned by the buckets."""
    versions = sorted(set(held.versions))
    name = _table(spark, held.at, held.buckets, str(versions))
    for v in versions:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (version = {v})")
    rows = spark.table(name)
    if len(versions) > 1:
        current = F.element_at(F.array(*map(F.lit, held.versions)), bucket_of(held.buckets) + 1)
        rows = rows.where(F.col("version") == current)
    return rows.select("object_id", "element_hash")


def dealt(current: DataFrame, buckets: int) -> DataFrame:
    """current's rows that have an id, partitioned as a baseline of so many buckets."""
    return current.where("object_id is not null").repartition(buckets, "object_id")


def diff(current: DataFrame, held: Held | None) -> DataFrame:
    """relational.diff() against a held baseline, which isn't moved: current (object_id, element_hash, ..) with its status."""
    if held is None:
        return current.withColumn("status", F.lit("new"))
    known = Q.diff(dealt(current, held.buckets), read(current.sparkSession, held).hint("merge"))
    # rows without an id are new whatever the baseline holds; dealt by id they would all be one task's
    return known.unionByName(current.where("object_id is null").withColumn("status", F.lit("new")))


def wanted(rows: int) -> int:
    """Buckets for so many rows: a power of two."""
    return max(LEAST, 1 << max(0, -(-rows // ROWS) - 1).bit_length())


def _write(rows: DataFrame, at: str, buckets: int, version: int) -> None:
    """Rows dealt to buckets, as one version, a folder of its own; what a failed run left under its number is replaced."""
    spark = rows.sparkSession
    name = _table(spark, f"{at}/version={version}", buckets)
    spark.sql(f"INSERT OVERWRITE TABLE {name} SELECT object_id, element_hash FROM {{rows}}", rows=rows)
    spark.sql(f"DROP TABLE {name}")  # its files stay


def save(current: DataFrame, held: Held | None, at: str, version: int) -> Held:
    """The baseline after a catalog (object_id, element_hash, catalog_row): of repeated ids the last row counts. Only buckets with new,
    updated or removed objects are written. `at` is the folder of a first version, or of one with more buckets."""
    spark = current.sparkSession
    if held is not None:
        new = Q.new_baseline(dealt(current, held.buckets))
        old = read(spark, held).hint("merge")
        both = new.select(F.col("object_id").alias("id"), F.col("element_hash").alias("now")).join(old, F.col("id") == F.col("object_id"), "full")
        moved = F.col("id").isNull() | F.col("object_id").isNull() | ~F.col("now").eqNullSafe(F.col("element_hash"))
        both = both.withColumn("key", F.coalesce("id", "object_id"))
        rows, changed = both.agg(F.count("id"), F.collect_set(F.when(moved, bucket_of(held.buckets, "key")))).first()
        if wanted(rows) <= 2 * held.buckets:
            if not changed:
                return held
            _write(new.where(bucket_of(held.buckets).isin(changed)), held.at, held.buckets, version)
            # a bucket that lost all its rows has no file of this version, which is what it should hold
            return Held(held.at, tuple(version if k in set(changed) else v for k, v in enumerate(held.versions)))
        n = wanted(rows)
    else:
        n = wanted(current.where("object_id is not null").agg(F.approx_count_distinct("object_id")).first()[0])
    _write(Q.new_baseline(dealt(current, n)), at, n, version)
    return Held(at, (version,) * n)


_BUCKET = re.compile(r"_(\d+)(?:\.[^/]*)?$")


def forget(spark: SparkSession, held: Held) -> list[str]:
    """Deletes files of the folder that `held` doesn't name and that are older than its latest version; what was deleted."""
    gone = []
    for folder in storage.listed(spark, held.at):
        version = re.fullmatch(r"version=(\d+)", folder)
        if not version or int(version[1]) > max(held.versions):
            continue
        for name in storage.listed(spark, f"{held.at}/{folder}"):
            bucket = _BUCKET.search(name)
            if bucket and held.versions[int(bucket[1])] != int(version[1]):
                storage.remove(spark, f"{held.at}/{folder}/{name}")
                gone.append(f"{folder}/{name}")
    return gone
