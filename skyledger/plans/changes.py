"""Queries over tables that are written and read again: bucketed baselines, digest trees, lineage, streams."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import values as V
from skyledger.operators import combine as K
from skyledger.operators import digest_tree, lineage
from skyledger.operators import execute as E
from skyledger.operators import ranges as R
from skyledger.operators import relational as Q
from skyledger.sources import baseline as B
from skyledger.sources import catalog, storage
from skyledger.streaming import catalogs, pointings

from .job import Options, Run


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as catalog rows; the hash is of customer and status."""
    return _t(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("object_id"), F.col("o_orderkey").alias("catalog_row"), V.hash_of(F.col("o_custkey").cast("string"), F.col("o_orderstatus")).alias("element_hash"))


def _versions(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three versions of a catalog: a tenth is missing and a seventh stale at first; later some are changed and some gone."""
    now, key = _catalog(spark, sf), F.col("catalog_row")
    first = now.where(key % 10 != 0).withColumn("element_hash", F.when(key % 7 == 0, "stale").otherwise(F.col("element_hash")))
    last = now.where(key % 100 != 11).withColumn("element_hash", F.when(key % 100 == 7, "moved").otherwise(F.col("element_hash")))
    return [first, now, last]


def bucketed_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Each version against the baseline of the one before, which lies in buckets and is rewritten where it changed."""
    held, at, found = None, storage.fresh(spark, "baseline"), []
    for number, current in enumerate(_versions(spark, sf), 1):
        found.append(storage.written(Q.status_counts(B.diff(current, held)).withColumn("cycle", F.lit(number)), "statuses"))
        held = B.save(current, held, at, number)
    left = B.read(spark, held).select(F.lit("baseline").alias("status"), F.lit(len(found)).alias("cycle"))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(left.groupBy("status", "cycle").agg(F.count("*").alias("n")))


def digest_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Where a changed copy differs: a run of rows, single rows, and a missing end."""
    rows = R.number_rows(_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
    one = storage.written(rows, "rows")
    key, n = F.col("o_orderkey"), one.count()
    other = one.where(F.col("input_row") < n - 3).withColumn("o_custkey", F.when((key % 997 == 5) | (key % 1499 < 4), F.lit(-1)).otherwise(F.col("o_custkey")))
    trees = [digest_tree.build(df, leaf=512, fan=32) for df in (one, other)]
    return digest_tree.differing_rows(one, other, *trees)


def tree_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as a forest of attempts: three roots, node n below (n - 3) div 2."""
    node = F.col("p_partkey")
    nodes = _t(spark, sf, "part").select(node.cast("bigint").alias("node"), F.when(node >= 3, F.expr("(p_partkey - 3) div 2")).alias("parent"))
    found = lineage.lineage(nodes, "node", "parent")
    return found.select("node", "root", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


def streamed_diff(spark: SparkSession, sf: str) -> DataFrame:
    """The same versions as files of a stream, each taken up by a query that is started again from its checkpoint."""
    at, buckets = storage.fresh(spark, "catalogs"), catalogs.buckets_for(_t(spark, sf, "orders").count())
    for number, current in enumerate(_versions(spark, sf), 1):
        current.select(F.lit(number).cast("bigint").alias("version"), "catalog_row", "object_id", "element_hash").write.parquet(f"{at}/in/version-{number}")
        catalogs.take_up_catalogs(spark, f"{at}/in", f"{at}/checkpoint", f"{at}/out", buckets=buckets)
    return catalogs.taken(spark, f"{at}/out").groupBy("version", "status").agg(F.count("*").alias("n"))


SLICES, LATE, GAP = 3, "6 hours", "4 hours"


def user_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of users, of events that arrive in slices of time; a part of them arrives twice, at once or a slice later."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    events = _t(spark, sf, "events").select("event_id", "user_id", F.timestamp_micros(micros).alias("at"))
    low, high = events.agg(F.min(F.unix_micros("at")), F.max(F.unix_micros("at"))).first()
    part = F.least(F.floor((F.unix_micros("at") - F.lit(low)) * SLICES / F.lit(max(1, (high or 0) - (low or 0)))), F.lit(SLICES - 1))
    again = F.when(F.col("event_id") % 5 == 0, F.array("part", F.col("part") + F.col("event_id") % 2)).otherwise(F.array("part"))
    sent = storage.written(events.withColumn("part", part).withColumn("part", F.explode(again)), "events")
    at = storage.fresh(spark, "stream")
    for k in range(SLICES + 1):
        sent.where(F.col("part") == k).drop("part").write.parquet(f"{at}/in/slice-{k}")
        stream = spark.readStream.schema("event_id long, user_id long, at timestamp").option("recursiveFileLookup", True).parquet(f"{at}/in")
        pointings.into(pointings.sessions(pointings.once(stream, "event_id", "at", LATE), "at", GAP, "user_id"), f"{at}/checkpoint", f"{at}/out")
    found = spark.read.schema("user_id long, session_start timestamp, session_end timestamp, n_events long").parquet(f"{at}/out")
    return found.select("user_id", F.unix_micros("session_start").alias("start_micros"), F.unix_micros("session_end").alias("end_micros"), "n_events")


def folder_of(spark: SparkSession, what: str) -> Path:
    """A new folder on the shared mount, by its path: simulators and probes of single files know no other."""
    at = urlparse(storage.fresh(spark, what))
    if at.scheme != "file":
        raise ValueError("files that programs open by path need spark.checkpoint.dir on a shared mount (file://)")
    folder = Path(at.path)
    folder.mkdir(parents=True)
    return folder


def combined_slices(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written in slices of different columns, orders of columns and formats, and read again as one table by two scans."""
    key, folder = F.col("o_orderkey"), folder_of(spark, "slices")
    orders = _t(spark, sf, "orders").select(key, F.format_string("%07d", key).alias("ObjID"), "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    slices = [("csv", ["ObjID", "o_custkey", "cents"]), ("csv", ["cents", "objid", "o_orderstatus"]), ("parquet", ["ObjID", "o_orderstatus"]), ("csv", ["o_orderstatus", "ObjID"]), ("parquet", ["cents", "ObjID", "o_custkey"])]
    files = []
    for k, (kind, columns) in enumerate(slices):
        at = folder / f"slice {k}+"
        part = orders.where(F.pmod(key, F.lit(len(slices))) == k).select(*(F.col("ObjID").alias("objid") if c == "objid" else F.col(c) for c in columns))
        part.write.option("header", True).format(kind).save(storage.uri(at))
        files += sorted(at.glob("part-*"))
    found = catalog.read_outputs(spark, files, {"o_custkey": "bigint"})
    return found.select(F.col("ObjID").alias("object_id"), "o_custkey", "o_orderstatus", "cents")


def one_day(spark: SparkSession, sf: str) -> DataFrame:
    """Events as detections, combined in order of time, and one day of them read back from the files that hold it."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    mjd, folder = micros / F.lit(86_400_000_000.0) + F.lit(float(V.UNIX_EPOCH_MJD)), folder_of(spark, "detections")
    rows = _t(spark, sf, "events").select(F.col("event_id").cast("string").alias("ObjID"), mjd.alias(K.SORT_COLUMN), F.col("user_id").cast("string").alias("user_id"))
    rows.write.parquet(storage.uri(folder / "chunks"))
    K.combine(spark, sorted((folder / "chunks").glob("part-*")), folder / "all.parquet")
    return K.between(spark, folder / "all.parquet", 60320.0, 60321.0).select("ObjID", "user_id")


CHUNK = 2000


def resumed_execution(spark: SparkSession, sf: str) -> DataFrame:
    """A run of which only even chunks are executed at first, and then all: chunks with a bad key fail, those that have an outcome aren't
    executed again."""

    def simulate(orbits, physics):
        if (orbits["ObjID"].astype("int64") % 4999 == 17).any():
            raise RuntimeError("a bad row")
        return orbits[["ObjID"]].assign(fieldMJD_TAI=orbits["a"]), None

    key = F.col("o_orderkey")
    rows = _t(spark, sf, "orders").select(key.cast("string").alias("ObjID"), F.col("o_custkey").cast("double").alias("a"), F.lit(15.0).alias("H_r"), key.alias("o_orderkey"))
    rows = storage.written(R.number_rows(rows, "o_orderkey"), "rows")
    run = Run(rows, "new", "2024-01-01", Options(E.FunctionExecutor(simulate), folder_of(spark, "run"), chunk_size=CHUNK, workers=spark.sparkContext.defaultParallelism, orbit_columns=["ObjID", "a"], physical_columns=["ObjID", "H_r"]))
    run.execute(run.plan.where("chunk % 2 = 0"))
    return run.execute(run.plan).select("chunk", "node_id", "row_start", "row_end", "status", "resumed", "output_exists")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q35_bucketed_diff": bucketed_diff, "q36_digest_ranges": digest_ranges, "q37_tree_lineage": tree_lineage, "q38_streamed_diff": streamed_diff, "q39_user_sessions": user_sessions,
    "q40_combined_slices": combined_slices, "q41_one_day": one_day, "q42_resumed_execution": resumed_execution,
}
