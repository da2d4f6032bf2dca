"""Output files of many headers, clustered outputs, audits, reports, dealing of work, and the command line."""

import csv
import gzip
import io
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyledger.operators import audit as A
from skyledger.operators import combine as K
from skyledger.operators import execute as E
from skyledger.operators import ranges as R
from skyledger.operators import reports
from skyledger.plans import cli
from skyledger.sources import catalog as C
from skyledger.sources import storage


def test_many_files_of_many_headers_are_two_scans(spark, tmp_path):
    names, want, paths = [f"x{k}" for k in range(12)], [], []
    for k in range(60):
        own = [names[(k * 5 + j) % 12] for j in range(3 + k % 4)]
        row = {n: f"{k}-{n}" for n in own}
        path = tmp_path / f"f {k}+é%.csv"
        pd.DataFrame([row, {**row, own[0]: ""}]).to_csv(path, index=False)
        want += [row, {n: v for n, v in row.items() if n != own[0]}]
        paths.append(path)
    for k in range(6):
        row = {names[k]: k, "X11": f"0{k}"}  # another case, and numbers
        spark.createDataFrame([tuple(row.values())], f"{names[k]} long, X11 string").coalesce(1).write.parquet(storage.uri(tmp_path / f"p{k}.parquet"))
        want.append({names[k]: str(k), "x11": f"0{k}"})
        paths.append(tmp_path / f"p{k}.parquet")
    (tmp_path / "empty.csv").write_text("")
    df = C.read_outputs(spark, [*paths, tmp_path / "empty.csv", tmp_path / "none.csv"])
    got = [{n: v for n, v in r.asDict().items() if v is not None} for r in df.select(*names).collect()]
    assert sorted(got, key=repr) == sorted((dict(sorted(w.items(), key=lambda x: names.index(x[0]))) for w in want), key=repr)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[.*\] csv", plan)) == 1 and len(re.findall(r"Relation \[.*\] parquet", plan)) == 1


def test_parquet_files_that_contradict_each_other(spark, tmp_path):
    for k, kind in enumerate(("long", "double", "string")):
        spark.sql(f"SELECT CAST(7 AS {kind}) AS v, CAST({k} AS STRING) AS t").coalesce(1).write.parquet(storage.uri(tmp_path / f"{k}.parquet"))
    df = C.read_outputs(spark, sorted(tmp_path.glob("*.parquet")), {"t": "double"})
    assert sorted(map(tuple, df.collect())) == [("7", 0.0), ("7", 2.0), ("7.0", 1.0)] and C.read_outputs(spark, []) is None


def test_a_day_opens_few_files(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") * 7919 % 40_000 / 1000.0 + 60000).alias(K.SORT_COLUMN), F.col("id").cast("string").alias("ObjID"))
    rows = rows.unionByName(spark.createDataFrame([(None, "n"), (float("nan"), "m")], f"{K.SORT_COLUMN} double, ObjID string"))
    rows.repartition(3).write.parquet(storage.uri(tmp_path / "in"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        K.combine(spark, sorted((tmp_path / "in").glob("part-*")), tmp_path / "out.parquet")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole, day = spark.read.parquet(str(tmp_path / "out.parquet")), K.between(spark, tmp_path / "out.parquet", 60003.0, 60004.0)
    assert len(whole.inputFiles()) >= 4 and len(day.inputFiles()) <= 2 and whole.count() == 40_002
    assert sorted(map(tuple, day.collect())) == sorted(map(tuple, rows.where("fieldMJD_TAI >= 60003 and fieldMJD_TAI < 60004").collect()))
    assert K.between(spark, tmp_path / "out.parquet", 1.0, 2.0).count() == 0
    for f in whole.inputFiles():
        own = [tuple(r) for r in spark.read.parquet(f).where("fieldMJD_TAI < 1e9").collect()]
        assert own == sorted(own)
    (tmp_path / "plain").mkdir()
    rows.write.mode("overwrite").parquet(str(tmp_path / "plain"))
    assert K.between(spark, tmp_path / "plain", 60003.0, 60004.0).count() == 1000  # without noted ranges


def test_audit_groups_once(spark, monkeypatch):
    source = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0), (None, 3.0)], "ObjID string, fieldMJD_TAI double")
    combined = spark.createDataFrame([("a", 1.0), (None, 3.0), ("z", 9.0), ("z", 9.0)], "ObjID string, fieldMJD_TAI double")
    written, seen = storage.written, []
    monkeypatch.setattr(A.storage, "written", lambda df, what: seen.append(what) or written(df, what))
    s, lost = A.audit(source, combined, "detections", "p", 2, spark.createDataFrame([(5, "b")], "catalog_row long, ObjID string"))
    assert seen == ["audit"] and (s.source_rows, s.source_pairs, s.combined_rows, s.combined_pairs, s.missing_pairs, s.missing_rows, s.status) == (4, 3, 4, 3, 2, 2, "missing")
    assert sorted((r["object_id"], r["source_count"], r["combined_count"], r["missing_count"], r["catalog_row"]) for r in lost.collect()) == [("a", 2, 1, 1, None), ("b", 1, 0, 1, 5)]
    assert A.audit(source, source, "detections", "p", 1, None)[1] is None


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_reports_are_written_by_tasks(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(reports, "SMALL", small)
    rows = [(1, 'say "hi", you', True, None), (2, "", False, 0.5), (3, None, None, 1.0)]
    frame = spark.createDataFrame(rows, "n int, text string, yes boolean, x double").withColumn("nothing", F.lit(None))
    for _ in range(2):  # the second replaces the first
        path = reports.write_csv(frame.orderBy("n"), tmp_path / "sub" / "r.csv")
    files = [path] if small else sorted(path.glob("part-*"))
    assert path.is_file() == bool(small) and not list((tmp_path / "sub").glob(".r*"))
    got = [r for f in files for r in csv.DictReader(f.open(newline=""))]
    assert [(r["n"], r["text"], r["yes"], r["x"], r["nothing"]) for r in got] == [("1", 'say "hi", you', "True", "", ""), ("2", "", "False", "0.5", ""), ("3", "", "", "1.0", "")]
    if small:
        empty = reports.write_csv(frame.limit(0), tmp_path / "none.csv")
        assert empty.read_text().strip() == "n,text,yes,x,nothing"


def test_the_longest_ranges_go_first(spark):
    todo = spark.createDataFrame([(f"n{k}", 0, k, float(s)) for k, s in enumerate((1, 9, 2, 8, 3, 7, 30))], "node_id string, row_start long, row_end long, expected double")
    got = E.dealt(todo, 3).collect()
    load = {t: sum(r["expected"] for r in got if r["__turn"] == t) for t in range(3)}
    assert sorted(load.values()) == [15.0, 15.0, 30.0] and [r["node_id"] for r in sorted(got, key=lambda r: r["__place"])][:3] == ["n6", "n1", "n3"]


def test_seconds_are_expected_from_earlier_attempts(spark):
    earlier = spark.createDataFrame([("a", 10, 5.0), ("b", 10, 20.0)], "node_id string, row_count long, simulator_seconds double")
    todo = spark.createDataFrame([("a", "", 0, 10), ("c", "b", 10, 15), ("d", "x", 0, 4)], "node_id string, parent_node_id string, row_start long, row_end long")
    got = {r["node_id"]: r["expected"] for r in E.expected_seconds(todo, earlier).collect()}
    assert got == {"a": 5.0, "c": 10.0, "d": 5.0}
    assert {r["expected"] for r in E.expected_seconds(todo, earlier.limit(0)).collect()} == {10.0, 5.0, 4.0}


def test_a_download_is_unpacked_in_blocks(tmp_path):
    text, blocks = b'[{"a": 1}]' * 300_000, []

    class Reply(io.BytesIO):
        def read(self, n=-1):
            blocks.append(n)
            return super().read(n)

    path = C.download_catalog("2024-01-01", tmp_path, fetch=lambda url: Reply(gzip.compress(text)))
    assert path.read_bytes() == text and max(blocks) < len(text) and -1 not in blocks
    with pytest.raises(Exception):
        C.download_catalog("2024-01-02", tmp_path, fetch=lambda url: Reply(gzip.compress(text)[:500]))
    assert [p.name for p in tmp_path.iterdir()] == ["2024-01-01_asteroids.json"]  # nothing half-written has a name


def test_the_command_line_names_all_that_is_missing(tmp_path, capsys):
    ran = []
    assert cli.main(["--orbits", "o"], run=lambda *a: ran.append(a)) == 2 and "--db, --config" in capsys.readouterr().out
    assert cli.main([]) == 2 and "--orbits" in capsys.readouterr().out
    assert cli.main(["--download_orbits", "--db", "d"], fetch=lambda *a: ran.append(a)) == 2 and not ran
