"""Queries over catalogs, ignore lists, audits and reports, as files and frames made from the tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import audit as A
from skyledger.operators import digest_tree, reports
from skyledger.operators import ranges as R
from skyledger.operators import relational as Q
from skyledger.sources import catalog, storage

from .changes import folder_of


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _array(lines: DataFrame, path: Path) -> None:
    """JSON lines, written by tasks in their order, as one array with line breaks, with elements that are no objects between them."""
    parts = path.with_suffix(".parts")
    lines.write.text(storage.uri(parts))
    with path.open("wb") as out:
        out.write(b"[0")
        for part in sorted(parts.glob("part-*")):
            with part.open("rb") as f:
                for line in f:
                    out.write(b",\r\n  " + line.rstrip(b"\n"))
        out.write(b", null]\n")


def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a catalog file, read back with their places in the array, ids and element hashes; two elements are no objects."""
    at = folder_of(spark, "catalog")
    fields = F.struct(F.format_string("%s", "o_orderkey").alias("Principal_desig"), F.col("o_custkey").alias("e"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("i"))
    _array(_t(spark, sf, "orders").orderBy("o_orderkey").select(F.to_json(fields).alias("value")), at / "catalog.json")
    return Q.identified(catalog.read_catalog(spark, str(at / "catalog.json"), at / "work")).select("catalog_row", "object_id", "element_hash")


def ignored_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Customers that neither a CSV list (suppliers), a text list with comments (nations) nor single ids leave out."""
    at = folder_of(spark, "lists")
    suppliers, nations = _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    suppliers.select(F.col("s_name").alias("note"), F.format_string(" %d ", "s_suppkey").alias("ObjID")).write.option("header", True).csv(storage.uri(at / "list.csv"))
    nations.select(F.format_string("%d , %d,, # %d", F.col("n_nationkey") + 300, F.col("n_nationkey") + 301, F.col("n_nationkey") + 700)).write.text(storage.uri(at / "list.txt"))
    both = catalog.ignore_ids(spark, str(at / "list.csv"), ["777", " "]).unionByName(catalog.ignore_ids(spark, str(at / "list.txt")))
    return Q.drop_ignored(_t(spark, sf, "customer"), both, "c_custkey").select("c_custkey")


def missing_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of object and time that combined detections lack, with the catalog rows they belong to."""
    lines = _t(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("ObjID"), F.col("l_linenumber").cast("double").alias("fieldMJD_TAI"), "l_suppkey")
    objects = _t(spark, sf, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("catalog_row"), F.col("o_orderkey").cast("string").alias("Principal_desig"))
    _, lost = A.audit(lines, lines.where("l_suppkey % 13 <> 0"), "detections", "combined", 1, objects)
    columns = ["output_name", "object_id", "id_column", "timestamp_column", "source_count", "combined_count", "missing_count", "catalog_row"]
    if lost is None:
        return lines.limit(0).select(*(F.lit(None).alias(c) for c in (*columns, "time")))
    return lost.select(*columns, F.col("timestamp").cast("double").cast("bigint").alias("time"))


def failing_catalog_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the ranges that hold a bad key, led by the range's columns under a prefix."""
    rows = R.number_rows(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    bad = rows.where("o_orderkey % 4999 = 17").select(R.chunk_of("input_row", 500).alias("chunk")).distinct().withColumn("bad", F.lit(True))
    status = F.when(F.col("bad"), "failed").otherwise("done")
    attempts = R.plan(spark, rows.count(), 500).join(bad, "chunk", "left").select("*", status.alias("status"), (F.col("row_end") - F.col("row_start")).alias("row_count"), F.when(F.col("bad"), "bad row").otherwise("").alias("error"), F.lit(0.5).alias("duration_seconds"), F.lit(0.25).alias("simulator_seconds"), F.lit(False).alias("resumed"))
    found = reports.catalog_rows(attempts.where("status = 'failed'"), rows, "failure", 500, {"kind": F.concat(F.lit("rows "), F.col("row_count").cast("string"))})
    return found.select("failure_node_id", "failure_parent_chunk", "failure_row_start", "failure_row_end", "failure_status", "failure_error", "failure_kind", "failure_input_row", "o_orderkey", "o_custkey")


def digest_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every 100 customers, in the order of their keys."""
    rows = R.number_rows(_t(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("k"), F.col("c_nationkey").cast("bigint").alias("n")), "k")
    return digest_tree.build(rows.select("input_row", "k", "n"), leaf=100, fan=10).level(0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q43_catalog_scan": catalog_scan, "q44_ignored_ids": ignored_ids, "q45_missing_pairs": missing_pairs, "q46_failing_catalog_rows": failing_catalog_rows, "q47_digest_leaves": digest_leaves,
}
