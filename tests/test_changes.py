"""Bucketed baselines, digest trees, lineage, medians, and streams, on small tables."""

import random
import re
import sqlite3
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skyledger.operators import digest_tree as D
from skyledger.operators import lineage as L
from skyledger.operators import ranges as R
from skyledger.operators import relational as Q
from skyledger.plans import changes
from skyledger.plans import cycle as cycles
from skyledger.plans.state import State
from skyledger.sources import baseline as B
from skyledger.sources import storage
from skyledger.sources.sqlite import SqliteReader, extent, read_sqlite, stream_sqlite
from skyledger.streaming import catalogs, pointings

CATALOG = "object_id string, element_hash string, catalog_row long"


def catalog(spark, hashes, more=()):
    rows = [(k, h, n) for n, (k, h) in enumerate(hashes.items())]
    return spark.createDataFrame([*rows, *more], CATALOG)


def plain(spark, current, before):
    base = spark.createDataFrame(list(before.items()), "object_id string, element_hash string")
    return sorted(map(tuple, Q.diff(current, base).select("object_id", "catalog_row", "status").collect()), key=repr)


def test_bucketed_baseline_follows_the_plain_diff(spark):
    rng, at, held, before = random.Random(3), storage.fresh(spark, "baseline"), None, {}
    for version in range(1, 6):
        now = {f"o{k}": f"h{rng.randrange(3)}" for k in range(200) if rng.random() < 0.9}
        more = [(None, "x", 900), (None, "x", 901), ("o1", "last", 902), ("o1", "older", 899)]
        current = catalog(spark, now, more)
        got = B.diff(current, held).select("object_id", "catalog_row", "status").collect()
        assert sorted(map(tuple, got), key=repr) == plain(spark, current, before)
        held = B.save(current, held, at, version)
        before = {**now, "o1": "last"}
        assert dict(map(tuple, B.read(spark, held).collect())) == before
        B.forget(spark, held)
        assert dict(map(tuple, B.read(spark, held).collect())) == before


def test_only_changed_buckets_are_written(spark):
    at, hashes = storage.fresh(spark, "baseline"), {f"o{k}": "a" for k in range(400)}
    first = B.save(catalog(spark, hashes), None, at, 1)
    assert B.save(catalog(spark, hashes), first, at, 2) is first  # nothing changed: nothing is written
    second = B.save(catalog(spark, hashes | {"o7": "b"}), first, at, 3)
    (bucket,) = [k for k, v in enumerate(second.versions) if v == 3]
    files = storage.listed(spark, f"{at}/version=3")
    assert len([f for f in files if f.endswith(".parquet")]) == 1 and f"_{bucket:05d}." in [f for f in files if f.endswith(".parquet")][0]
    assert dict(map(tuple, B.read(spark, second).collect())) == hashes | {"o7": "b"}
    assert dict(map(tuple, B.read(spark, first).collect())) == hashes  # the version before can still be read
    gone = B.forget(spark, second)
    assert len(gone) == 1 and gone[0].startswith("version=1/")
    emptied = {k: h for k, h in hashes.items() if spark.sql(f"SELECT pmod(hash('{k}'), {first.buckets})").first()[0] != bucket}
    third = B.save(catalog(spark, emptied), second, at, 4)
    assert dict(map(tuple, B.read(spark, third).collect())) == emptied and third.versions[bucket] == 4


def test_what_a_failed_run_left_is_replaced(spark):
    at, hashes = storage.fresh(spark, "baseline"), {f"o{k}": "a" for k in range(50)}
    first = B.save(catalog(spark, hashes), None, at, 1)
    B.save(catalog(spark, {k: "lost" for k in hashes}), first, at, 2)  # its state file was never written
    second = B.save(catalog(spark, hashes | {"o3": "b"}), first, at, 2)
    assert dict(map(tuple, B.read(spark, second).collect())) == hashes | {"o3": "b"}


def test_the_baseline_is_not_shuffled(spark):
    at, hashes = storage.fresh(spark, "baseline"), {f"o{k}": "a" for k in range(400)}
    held = B.save(catalog(spark, hashes), None, at, 1)
    held = B.save(catalog(spark, hashes | {"o7": "b"}), held, at, 2)
    plan = B.diff(catalog(spark, hashes).where("object_id is not null"), held).where("object_id is not null")._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin") :]
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan and "BroadcastExchange" not in plan
    below = join[: join.index("FileScan")]
    assert below.count("Exchange") == 1 and "Bucketed: true" in plan


def test_more_buckets_when_it_has_grown(spark, monkeypatch):
    at = storage.fresh(spark, "baseline")
    held = B.save(catalog(spark, {"a": "1"}), None, f"{at}-1", 1)
    monkeypatch.setattr(B, "ROWS", 2)
    many = {f"o{k}": "1" for k in range(100)}
    grown = B.save(catalog(spark, many), held, f"{at}-2", 2)
    assert grown.buckets == 64 > held.buckets and grown.at.endswith("-2") and dict(map(tuple, B.read(spark, grown).collect())) == many


def test_state_takes_over_a_plain_baseline(spark, tmp_path):
    from skyledger.plans.state import write_json

    state = State(tmp_path, tmp_path / "p.db", False)
    spark.createDataFrame([("a", "1"), ("b", "2")], "object_id string, element_hash string").write.parquet((tmp_path / "old_v1").as_uri())
    write_json(state.file, {"last_mjd": 5.0, "baseline": "old_v1", "version": 1})
    current = catalog(spark, {"a": "1", "b": "3", "c": "4"})
    assert sorted((r["object_id"], r["status"]) for r in state.diff(current).collect()) == [("a", "unchanged"), ("b", "updated"), ("c", "new")]
    state.save(6.0, current)
    assert state.watermark == 6.0 and state.buckets and not (tmp_path / "old_v1").exists()
    assert dict(map(tuple, state.baseline(spark).collect())) == {"a": "1", "b": "3", "c": "4"}
    state.save(7.0, current.where("object_id <> 'c'"))
    assert sorted(r["status"] for r in state.diff(current).collect()) == ["new", "unchanged", "unchanged"]


def numbered(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "input_row long, x string")


def test_digest_trees_lead_to_what_differs(spark):
    values = [f"v{k}" for k in range(3000)]
    other = [*values]
    for k in (0, 1, 2, 700, 1203, 1204, 2047, 2048):
        other[k] = "changed"
    one, two = numbered(spark, values), numbered(spark, other[:-5])
    left, right = (D.build(df.repartition(5), leaf=16, fan=4) for df in (one, two))
    assert D.build(one.repartition(3), leaf=16, fan=4).root() == left.root() != right.root()
    leaves, compared = D.differing_leaves(left, right)
    assert sorted(r["node"] for r in leaves.collect()) == sorted({k // 16 for k in (0, 700, 1203, 2047, 2048, 2995, 2999)})
    depth = [k for k, _ in compared]
    assert depth == [*range(left.top, -1, -1)] and compared[-1][1] <= 4 * 7 < left.level(0).count()  # only children of nodes that differ
    got = sorted(map(tuple, D.differing_rows(one, two, left, right).collect()))
    assert got == [(0, 3), (700, 701), (1203, 1205), (2047, 2049), (2995, 3000)]
    assert D.differing_rows(one, one, left, left).collect() == []
    again = D.reopened(spark, left.at, 16, 4)
    assert (again.top, again.root()) == (left.top, left.root())


def test_digest_trees_with_very_many_differences(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_RANGES", 3)
    one, two = (numbered(spark, [f"{a}{k}" if k % 7 < 3 else "same" for k in range(500)]) for a in "ab")
    left, right = (D.build(df, leaf=8, fan=4) for df in (one, two))
    assert sorted(map(tuple, D.differing_rows(one, two, left, right).collect())) == [(k, min(k + 3, 500)) for k in range(0, 500, 7)]


def test_digest_trees_of_nothing(spark):
    none, some = numbered(spark, ["x"]).limit(0), numbered(spark, ["a", "b"])
    empty, full = (D.build(df, leaf=8, fan=4) for df in (none, some))
    assert empty.root() == "" and D.differing_rows(none, some, empty, full).collect() == [(0, 2)]
    assert D.differing_rows(none, none, empty, empty).collect() == []


def test_only_differing_leaves_are_read(spark):
    leaves = spark.createDataFrame([(3,), (4,), (9,)], "node long")
    at = storage.fresh(spark, "rows")
    spark.range(1000).write.parquet(at)
    plan = D._below(spark.read.parquet(at), "id", leaves, 10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(id,30\).*LessThan\(id,50\).*GreaterThanOrEqual\(id,90\)", plan)


@pytest.mark.parametrize("hot", [2, 1000])
def test_lineage_against_a_walk(spark, hot, monkeypatch):
    monkeypatch.setattr(L.looked_up, "__defaults__", (hot,))
    rng = random.Random(1)
    up = {f"n{k}": (None if k == 0 else f"n{rng.randrange(k)}" if k % 3 else "n0") for k in range(150)}
    up |= {f"c{k}": f"c{k - 1}" for k in range(1, 70)} | {"c0": "gone", "alone": None}
    rows = [*up.items(), ("n3", up["n3"])]  # one node twice
    got = {r["node_id"]: (r["root"], r["depth"], r["path"]) for r in L.lineage(spark.createDataFrame(rows, "node_id string, parent_node_id string")).collect()}

    def walk(n):
        path = [n]
        while up.get(path[0]) in up:
            path.insert(0, up[path[0]])
        return path[0], len(path) - 1, path

    assert got == {n: walk(n) for n in up}
    assert L.lineage(spark.createDataFrame([], "node_id string, parent_node_id string")).collect() == []


def test_lineage_of_a_circle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_ROUNDS", 4)
    with pytest.raises(ValueError, match="circle"):
        L.lineage(spark.createDataFrame([("a", "b"), ("b", "a")], "node_id string, parent_node_id string"))


def test_medians_are_exact(spark, monkeypatch):
    monkeypatch.setattr(R, "SORT_ROWS", 50)
    rows = [("hot", float(k * 37 % 1001)) for k in range(900)] + [("hot", 5.0)] * 300 + [("two", 1.0), ("two", 4.0), ("one", 2.5), ("none", None), (None, 7.0), (None, 9.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, x double")
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("x").alias("m")).collect() if r["m"] is not None}
    assert {r["g"]: r["x"] for r in R.median(df, "x", "g").collect()} == want
    parts = R._dealt(df.where("x is not null").distinct(), ("g", "x")).groupBy("__part").count().collect()
    assert len(parts) > 5 and max(r["count"] for r in parts) < 300  # the group of most rows is divided


def database(path, script):
    Path(path).unlink(missing_ok=True)
    with sqlite3.connect(path) as db:
        db.executescript(script)


TIMES = [10.0, 11.5, None, 12.0, 9.0, 12.0]
INSERTS = "".join(f"INSERT INTO base VALUES ({k}, {'NULL' if t is None else t});" for k, t in enumerate(TIMES))
KINDS = {
    "table": f"CREATE TABLE base (observationId INTEGER, observationStartMJD REAL); {INSERTS} ALTER TABLE base RENAME TO observations;",
    "view": f"CREATE TABLE base (observationId INTEGER, observationStartMJD REAL); {INSERTS} CREATE VIEW observations AS SELECT observationId, observationStartMJD + 0 AS observationStartMJD FROM base;",
    "without rowid": f"CREATE TABLE base (observationId TEXT PRIMARY KEY, observationStartMJD REAL) WITHOUT ROWID; {INSERTS} ALTER TABLE base RENAME TO observations;",
    "column named rowid": f"CREATE TABLE base (rowid TEXT, observationStartMJD REAL); {INSERTS} ALTER TABLE base RENAME TO observations;",
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_sqlite_reads_tables_and_views(spark, tmp_path, kind, partitions):
    database(tmp_path / "p.db", KINDS[kind])
    df = read_sqlite(spark, tmp_path / "p.db", partitions=partitions)
    assert sorted((int(r[0]), r[1]) for r in df.collect()) == list(enumerate(TIMES))
    assert sorted(int(r[0]) for r in Q.since(df, "observationStartMJD", 10.0).collect()) == [1, 3, 5]
    assert extent(tmp_path / "p.db", "observationStartMJD") == (12.0, 6)


def test_sqlite_carries_out_the_comparison(spark, tmp_path):
    database(tmp_path / "p.db", KINDS["table"])
    later = Q.since(read_sqlite(spark, tmp_path / "p.db"), "observationStartMJD", 11.0, 0.5).where(F.col("observationStartMJD") <= 12.0)
    assert "Filter (" not in later._jdf.queryExecution().executedPlan().toString()
    reader = SqliteReader({"path": str(tmp_path / "p.db")}, later.schema)
    from pyspark.sql.datasource import GreaterThan, IsNotNull, StringContains

    other = StringContains(("observationId",), "x")
    assert list(reader.pushFilters([GreaterThan(("observationStartMJD",), 11.0), IsNotNull(("observationStartMJD",)), other])) == [other]
    assert [r[1] for p in reader.partitions() for r in reader.read(p)] == [11.5, 12.0, 12.0]


def test_a_missing_table_is_an_error(spark, tmp_path):
    database(tmp_path / "p.db", "CREATE TABLE other (a INTEGER);")
    with pytest.raises(Exception, match="observations"):
        read_sqlite(spark, tmp_path / "p.db").collect()


def test_a_cycle_reads_the_increment_alone(spark, tmp_path, monkeypatch):
    import json

    from skyledger.plans.job import Options

    from test_engine import Fake, asteroid

    database(tmp_path / "p.db", KINDS["view"])
    (tmp_path / "c.json").write_text(json.dumps([asteroid("A")]))
    (tmp_path / "cfg").write_text("")
    seen = []
    written = cycles.write_sqlite
    monkeypatch.setattr(cycles, "write_sqlite", lambda df, path: seen.append(sorted(r[0] for r in df.collect())) or written(df, path))
    c = cycles.Cycle(tmp_path / "p.db", tmp_path / "c.json", tmp_path / "cfg", Options(Fake(tmp_path / "calls"), tmp_path / "results", chunk_size=10), state_folder=tmp_path, work=tmp_path / "work")
    assert cycles.run_cycle(spark, c) and not seen and State(tmp_path, tmp_path / "p.db", False).watermark == 12.0
    with sqlite3.connect(tmp_path / "p.db") as db:
        db.execute("INSERT INTO base VALUES (6, 12.5), (7, 1.0)")
    assert cycles.run_cycle(spark, c) and seen == [[6]]


def test_rows_are_delivered_once_however_late(spark, tmp_path):
    database(tmp_path / "p.db", KINDS["table"])
    at = (spark, str(tmp_path / "p.db"), str(tmp_path / "ck"), str(tmp_path / "out"))
    have = lambda: sorted(r[0] for r in spark.read.schema("observationId long, observationStartMJD double").parquet(str(tmp_path / "out")).collect())
    pointings.take_up_rows(*at)
    assert have() == [0, 1, 2, 3, 4, 5]
    with sqlite3.connect(tmp_path / "p.db") as db:
        db.execute("INSERT INTO observations VALUES (6, 12.5), (7, 1.0)")  # the second is far below the mark

    def fail(batch, number):
        assert sorted(r[0] for r in batch.collect()) == [6, 7]
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        pointings.take_up_rows(*at, check=fail)
    with sqlite3.connect(tmp_path / "p.db") as db:
        db.execute("INSERT INTO observations VALUES (8, 3.0)")  # after the batch was planned
    seen = []
    pointings.take_up_rows(*at, check=lambda batch, number: seen.append((number, sorted(r[0] for r in batch.collect()))))
    assert seen == [(1, [6, 7]), (2, [8])] and have() == [*range(9)]
    pointings.take_up_rows(*at)
    assert have() == [*range(9)]


def test_a_view_streams_by_a_column_that_grows(spark, tmp_path):
    database(tmp_path / "p.db", KINDS["view"])
    pointings.take_up_rows(spark, str(tmp_path / "p.db"), str(tmp_path / "ck"), str(tmp_path / "out"), offset="observationId")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
    with pytest.raises(Exception, match="offset"):
        stream_sqlite(spark, tmp_path / "p.db").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start().awaitTermination()


def test_streamed_statuses_equal_the_batch_diff(spark, tmp_path):
    rng, folder, before = random.Random(2), str(tmp_path / "in"), {}
    for version in range(1, 5):
        now = {f"o{k}": f"h{rng.randrange(2)}" for k in range(60) if rng.random() < 0.8}
        rows = [(k, h, n) for n, (k, h) in enumerate(now.items())] + [(None, "x", 70), ("o1", "last", 71)]
        frame = spark.createDataFrame(rows, CATALOG)
        files = frame.select(F.lit(version).cast("long").alias("version"), "catalog_row", "object_id", "element_hash")
        files.repartition(3).write.mode("append").parquet(folder)
        catalogs.take_up_catalogs(spark, folder, str(tmp_path / "ck"), str(tmp_path / "out"), files=1 if version % 2 else None, buckets=4)  # a version in one trigger or several
        got = catalogs.taken(spark, str(tmp_path / "out")).where(F.col("version") == version)
        assert sorted(map(tuple, got.select("object_id", "catalog_row", "status").collect()), key=repr) == plain(spark, frame, before)
        before = {**before, **now, "o1": "last"}


def test_buckets_of_a_stream_grow_with_its_objects(spark, tmp_path, monkeypatch):
    assert [catalogs.buckets_for(n) for n in (0, 64 * catalogs.OBJECTS, 64 * catalogs.OBJECTS + 1, 54_000_000)] == [64, 64, 65, 3296]
    spark.range(200).select(F.col("id").alias("o_orderkey"), F.lit(1).alias("o_custkey"), F.lit("O").alias("o_orderstatus")).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(catalogs, "OBJECTS", 3)
    seen, take_up = [], catalogs.take_up_catalogs
    monkeypatch.setattr(catalogs, "take_up_catalogs", lambda *args, buckets: (seen.append(buckets), take_up(*args, buckets=buckets)))
    got = changes.streamed_diff(spark, str(tmp_path)).collect()
    assert seen == [67] * 3  # the same for the life of the checkpoint
    assert sorted(map(tuple, got)) == [(1, "new", 180), (2, "new", 20), (2, "unchanged", 154), (2, "updated", 26), (3, "unchanged", 196), (3, "updated", 2)]


def test_sessions_with_repeats_and_late_rows(spark, tmp_path):
    schema = "event_id long, user_id long, at timestamp"

    def put(rows):
        df = spark.createDataFrame([(e, u, f"2024-01-01 {t}") for e, u, t in rows], "event_id long, user_id long, at string")
        df.select("event_id", "user_id", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = pointings.once(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "event_id", "at", "1 hour")
        pointings.into(pointings.sessions(stream, "at", "10 minutes", "user_id"), str(tmp_path / "ck"), str(tmp_path / "out"))

    put([(1, 7, "00:00:00"), (2, 7, "00:09:59"), (1, 7, "00:00:00"), (3, 8, "00:30:00")])
    put([(4, 7, "00:12:00"), (2, 7, "00:09:59"), (5, 8, "03:00:00")])  # late by less than the bound, and a repeat
    put([(6, 7, "00:05:00"), (7, 8, "06:00:00")])  # too late
    got = spark.read.parquet(str(tmp_path / "out")).select("user_id", F.date_format("session_start", "HH:mm:ss"), F.date_format("session_end", "HH:mm:ss"), "n_events").collect()
    assert sorted(map(tuple, got)) == [(7, "00:00:00", "00:22:00", 3), (8, "00:30:00", "00:40:00", 1), (8, "03:00:00", "03:10:00", 1)]
