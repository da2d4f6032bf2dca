"""The engine's operators over the star-schema tables: orders stand for objects, events for pointings,
lineitem for simulator output."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import values as V
from skyledger.operators import audit as A
from skyledger.operators import combine as K
from skyledger.operators import convert
from skyledger.operators import execute as E
from skyledger.operators import isolate as I
from skyledger.operators import ranges as R
from skyledger.operators import relational as Q
from skyledger.operators import reports

from . import changes, files

WATERMARK = datetime(2024, 1, 21)
BAD = "o_orderkey % 4999 = 17"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _mark():
    return F.lit(WATERMARK).cast("timestamp_ntz")


def _objects(spark: SparkSession, sf: str, name: str, *keep: str, **fields: Column | str) -> DataFrame:
    """A table's rows as catalog objects: the columns to keep, and obj, a variant with the fields."""
    members = [(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    return _t(spark, sf, name).select(*keep, F.to_variant_object(F.struct(*members)).alias("obj"))


def q01(spark: SparkSession, sf: str) -> DataFrame:
    return Q.since(_t(spark, sf, "events"), "ts", _mark()).select("event_id", "user_id", "event_type", "value")


def q02(spark: SparkSession, sf: str) -> DataFrame:
    return Q.extent(_t(spark, sf, "events"), "event_id", 0).select(F.col("max_value").cast("bigint").alias("max_id"), "n_rows")


def q03(spark: SparkSession, sf: str) -> DataFrame:
    objects = _objects(spark, sf, "documents", "doc_id", Provisional_packed_desig="source", Designation_and_name="lang", Principal_desig="cast(doc_id as string)")
    return objects.select("doc_id", V.object_id().alias("object_id"))


ORDER_FIELDS = ["o_custkey", "o_orderstatus", "cents"]


def _hashed(spark: SparkSession, sf: str, fields: list[str]) -> DataFrame:
    objects = _objects(spark, sf, "orders", "o_orderkey", o_custkey="o_custkey", o_orderstatus="o_orderstatus", cents="cast(round(o_totalprice * 100) as bigint)")
    return objects.select("o_orderkey", V.element_hash("obj", fields).alias("element_hash"))


def q04(spark: SparkSession, sf: str) -> DataFrame:
    return _hashed(spark, sf, ORDER_FIELDS)


def q05(spark: SparkSession, sf: str) -> DataFrame:
    return Q.keep_objects(_objects(spark, sf, "part", "p_partkey", "p_brand", a="p_retailprice / 36", U="p_size", Arc_length="p_brand")).select("p_partkey", "p_brand")


def q06(spark: SparkSession, sf: str) -> DataFrame:
    ignored = _t(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("object_id"))
    return Q.drop_ignored(_t(spark, sf, "customer"), ignored, "c_custkey").select("c_custkey")


def q07(spark: SparkSession, sf: str) -> DataFrame:
    now = _hashed(spark, sf, ORDER_FIELDS[:2]).withColumnRenamed("o_orderkey", "object_id")
    stale = F.when(F.col("object_id") % 7 == 0, "stale").otherwise(F.col("element_hash"))
    return Q.status_counts(Q.diff(now, now.where("object_id % 10 <> 0").withColumn("element_hash", stale)))


def q08(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    objects = _t(spark, sf, "customer").select(key.alias("id"), F.when(key % 10 == 0, "new").when(key % 7 == 0, "updated").otherwise("unchanged").alias("status"))
    pairs = Q.route(objects, _t(spark, sf, "events").select("event_id", "user_id", "ts"), ("id", "user_id"), "ts", _mark())
    per_object = pairs.groupBy("job", "id").agg(F.count("*").alias("n"))  # so that no distinct set is gathered for a job
    return per_object.groupBy("job").agg(F.sum("n").alias("n_pairs"), F.count("*").alias("n_objects"))


def q09(spark: SparkSession, sf: str) -> DataFrame:
    objects = _objects(spark, sf, "supplier", Principal_desig="s_name", Epoch="s_acctbal + 2461000.5D", H="s_nationkey")
    return convert.asteroid_inputs(objects).select("ObjID", F.round("epochMJD_TDB", 4).alias("epochMJD_TDB"), "FORMAT", "H_r", "g-r")


def q10(spark: SparkSession, sf: str) -> DataFrame:
    year, month, day = (F.expr(f"cast({part}(o_orderdate) as double)") for part in ("year", "month", "dayofmonth"))
    return _t(spark, sf, "orders").select("o_orderkey", V.mjd_of_calendar(year, month, day).cast("bigint").alias("epoch_mjd"))


def q11(spark: SparkSession, sf: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    day = F.dayofmonth("ts") + F.pmod(micros, F.lit(86_400_000_000)) / F.lit(86_400_000_000.0)
    return _t(spark, sf, "events").select("event_id", V.mjd_of_calendar_fraction(F.year("ts").cast("double"), F.month("ts").cast("double"), day).alias("mjd"))


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    return R.number_rows(_t(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


def q12(spark: SparkSession, sf: str) -> DataFrame:
    return _numbered(spark, sf).select("o_orderkey", "input_row", R.chunk_of("input_row", 5000).alias("chunk"))


def q13(spark: SparkSession, sf: str) -> DataFrame:
    return R.plan(spark, _t(spark, sf, "orders").count(), 4000).select("chunk", "node_id", "row_start", "row_end", (F.col("row_end") - F.col("row_start")).alias("row_count"))


def q14(spark: SparkSession, sf: str) -> DataFrame:
    rows = _numbered(spark, sf).withColumn("chunk", R.chunk_of("input_row", 1000))
    return R.select_chunks(rows, R.parse_selection("1,3-5,8")).select("o_orderkey", "chunk")


def q15(spark: SparkSession, sf: str) -> DataFrame:
    rows = _numbered(spark, sf)
    bad = rows.where(BAD).select(R.chunk_of("input_row", 1000).alias("chunk")).distinct()
    failed = R.plan(spark, rows.count(), 1000).join(bad, "chunk", "left_semi").select("chunk", "row_start", "row_end")
    return R.rows_in(failed, rows, 1000).select("chunk", F.col("row_start").alias("chunk_row_start"), F.col("row_end").alias("chunk_row_end"), "o_orderkey")


def q16(spark: SparkSession, sf: str) -> DataFrame:
    """The debug ranges of every chunk of a table's rows."""
    found = R.debug_ranges(R.plan(spark, _t(spark, sf, "orders").count(), 1000), 300)
    return found.select("node_id", F.col("parent_node_id").alias("parent"), (F.col("parent_chunk") * 1000).alias("parent_start"), "row_start", "row_end")


def _failing(spark: SparkSession, sf: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Numbered rows, and an executor that fails if a bad key is in its range. Where the bad rows are is worked out once."""
    rows = _numbered(spark, sf)
    bad = E.held(rows.where(BAD))

    def run(ranges: DataFrame) -> DataFrame:
        hit = R.rows_in(ranges, bad, 1000).select("node_id").distinct().withColumn("__bad", F.lit(True))
        status = F.when(F.col("__bad"), "failed").otherwise("done")
        return E.held(ranges.join(hit, "node_id", "left").withColumn("status", status).drop("__bad"))

    return rows, run


def q17(spark: SparkSession, sf: str) -> DataFrame:
    """The isolation loop itself."""
    rows, run = _failing(spark, sf)
    parents = run(R.plan(spark, rows.count(), 1000))
    tree = I.isolate(I.debug(parents.where("status = 'failed'"), run, 250), run)
    failing = R.rows_in(I.failing_rows(tree).select("row_start", "row_end"), rows, 1000).select(F.col("o_orderkey").alias("failing_id"))
    return R.number_rows(failing, "failing_id", out="ordinal")


def q18(spark: SparkSession, sf: str) -> DataFrame:
    node = F.col("p_partkey")
    nodes = _t(spark, sf, "part").select(node.cast("bigint").alias("node"), F.when(node != 0, F.expr("(p_partkey - 1) div 2")).alias("parent"))
    return R.leaves(nodes, "node", "parent").select(F.col("node").alias("leaf"))


def q19(spark: SparkSession, sf: str) -> DataFrame:
    a = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"))
    b = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("supp"))
    return K.union_all(a, b).select("k", "cust", "supp")


def q20(spark: SparkSession, sf: str) -> DataFrame:
    return A.key_counts(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return lines, lines.where("l_suppkey % 13 <> 0")


def q21(spark: SparkSession, sf: str) -> DataFrame:
    return A.shortfall(*_lines(spark, sf), ["l_orderkey", "l_linenumber"]).withColumnsRenamed({"l_orderkey": "object_id", "l_linenumber": "line"})


def q22(spark: SparkSession, sf: str) -> DataFrame:
    t = A.totals(*_lines(spark, sf), ["l_orderkey"])
    return t.select(F.lit("detections").alias("output_name"), "source_rows", "combined_rows", "source_pairs", "combined_pairs", "missing_rows")


def q23(spark: SparkSession, sf: str) -> DataFrame:
    key = F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey").cast("string"))
    rows = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("catalog_row"), key.alias("ObjID"), (F.col("o_orderkey") % 2000).cast("string").alias("Designation_and_name"))
    return A.catalog_lookup(rows)


def q24(spark: SparkSession, sf: str) -> DataFrame:
    attempts = _t(spark, sf, "events").select(
        F.nullif(F.col("event_id") % 4, F.lit(0)).cast("int").alias("debug_level"), (F.col("user_id") % 5).alias("row_count"), F.when(F.col("value") < 50, "done").otherwise("failed").alias("status"),
        (F.col("event_id") % 2 == 0).alias("resumed"), F.col("value").alias("simulator_seconds"), (F.col("value") + 1).alias("duration_seconds"), F.lit(0.25).alias("input_write_seconds"),
    )
    t = reports.timing_summary(attempts)
    return t.withColumns({c: F.round(c, 4) for c in t.columns if c.endswith("_seconds")})


def q25(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select("event_id", V.text_of(V.field(F.try_parse_json("props"), "k")).try_cast("bigint").alias("k"))


def q26(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "orders").select(F.col("o_custkey").alias("object_id"), F.col("o_orderpriority").alias("element_hash"), F.col("o_orderkey").alias("catalog_row"))
    return Q.new_baseline(rows)


def q27(spark: SparkSession, sf: str) -> DataFrame:
    return Q.selected(_t(spark, sf, "nation"), _t(spark, sf, "supplier"), "n_nationkey", "s_nationkey").select("n_nationkey", "n_name")


def q28(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as comets; those that aren't pending lack a date field."""
    dates = {f"{part}_of_perihelion": f"{f}(o_orderdate)" for part, f in (("Year", "year"), ("Month", "month"))}
    dates |= {"Day_of_perihelion": "dayofmonth(o_orderdate) + (o_orderkey % 8) / 8D", "Epoch_year": "year(o_orderdate)", "Epoch_day": "dayofmonth(o_orderdate) + 0.5D"}
    objects = _objects(spark, sf, "orders", Designation_and_name="cast(o_orderkey as string)", Epoch_month="if(o_orderstatus = 'P', month(o_orderdate), null)", e="o_custkey", **dates)
    return convert.comet_inputs(objects).select("ObjID", "epochMJD_TDB", "t_p_MJD_TDB", "e", "FORMAT")


def q29(spark: SparkSession, sf: str) -> DataFrame:
    """A tree of attempts: node n's parent is (n - 1) div 2; every third one failed."""
    node = F.col("p_partkey")
    nodes = _t(spark, sf, "part").select(node.cast("string").alias("node_id"), F.when(node > 0, F.expr("cast((p_partkey - 1) div 2 as string)")).otherwise("").alias("parent_node_id"), F.when(node % 3 == 0, "failed").otherwise("done").alias("status"))
    return I.group_failures(nodes).select("node_id")


def q30(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of chunks with bad rows: complete chunks, and good debug ranges of the others."""
    rows, run = _failing(spark, sf)
    parents = run(R.plan(spark, rows.count(), 1000))
    tree = I.debug(parents.where("status = 'failed'"), run, 250)
    return I.salvage(parents, tree).select("row_start", "row_end", "debug_level", "status")


def q31(spark: SparkSession, sf: str) -> DataFrame:
    """Detections in time order, with the place that order gives them."""
    rows = _t(spark, sf, "events").select(F.when(F.col("event_id") % 10 > 0, F.col("value")).alias(K.SORT_COLUMN), F.col("event_id").cast("string").alias("ObjID"))
    return R.number_rows(rows, *K.time_order(rows), out="place")


def q32(spark: SparkSession, sf: str) -> DataFrame:
    return R.halves(R.plan(spark, _t(spark, sf, "lineitem").count(), 777), 2).select("node_id", "parent_node_id", "row_start", "row_end")


def q33(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without events, as objects that left a catalog."""
    ids = lambda table, c: _t(spark, sf, table).select(F.col(c).alias("object_id"))
    return Q.removed(ids("events", "user_id"), ids("customer", "c_custkey"))


def q34(spark: SparkSession, sf: str) -> DataFrame:
    full, part = _lines(spark, sf)
    return A.surplus(part, full, ["l_orderkey"]).select(F.col("l_orderkey").alias("object_id"), "source_count", "combined_count", "missing_count")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_pointings_since_watermark": q01, "q02_pointings_extent": q02, "q03_canonical_id": q03, "q04_element_hash": q04, "q05_keep_filter": q05,
    "q06_ignore_anti": q06, "q07_diff_status": q07, "q08_work_routing": q08, "q09_orbit_projection": q09, "q10_calendar_mjd": q10,
    "q11_fractional_mjd": q11, "q12_chunk_assignment": q12, "q13_chunk_manifest": q13, "q14_selected_chunks": q14, "q15_failed_range_rows": q15,
    "q16_debug_subchunks": q16, "q17_isolated_rows": q17, "q18_leaf_anti_join": q18, "q19_combine_union_by_name": q19, "q20_key_counts": q20,
    "q21_audit_missing_pairs": q21, "q22_audit_summary": q22, "q23_lookup_first": q23, "q24_timing_summary": q24, "q25_json_field": q25,
    "q26_baseline_last_wins": q26, "q27_semi_select": q27, "q28_missing_dates_drop": q28, "q29_group_failures": q29, "q30_salvage": q30,
    "q31_time_order": q31, "q32_halves": q32, "q33_removed": q33, "q34_audit_surplus": q34, **changes.QUERIES, **files.QUERIES,
}
