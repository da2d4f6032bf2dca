import csv
import json
import shutil
import sqlite3
import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from skyledger.operators import audit as A
from skyledger.operators import combine as K
from skyledger.operators import execute as E
from skyledger.operators import ranges as R
from skyledger.operators import relational as Q
from skyledger.plans import cli, maintenance
from skyledger.plans.cycle import Cycle, run_cycle
from skyledger.plans.job import Options, Run, run_job
from skyledger.plans.state import State, snapshot
from skyledger.sources import catalog as C
from skyledger.sources.sqlite import read_sqlite, write_sqlite

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module


def rows_of(spark, ids):
    data = [(k, i, float(k), 15.0, 0.5, k + 10) for k, i in enumerate(ids)]
    return spark.createDataFrame(data, "input_row long, ObjID string, a double, H_r double, `g-r` double, catalog_row long")


class Fake:
    """Fails as told; counts calls in a folder, since it runs in workers."""

    def __init__(self, folder, bad=(), together=0, silent=()):
        self.folder, self.bad, self.together, self.silent = Path(folder), set(bad), together, set(silent)

    def __call__(self, task):
        ids = pd.read_csv(task.orbits, dtype=str)["ObjID"].tolist()
        self.folder.mkdir(parents=True, exist_ok=True)
        (self.folder / f"{'-'.join(ids)}-{len(list(self.folder.iterdir()))}").write_text("")
        hit = self.bad & set(ids)
        if hit and len(ids) >= self.together:
            raise RuntimeError(f"bad row {sorted(hit)}")
        if set(ids) <= self.silent:
            return
        pd.DataFrame({"ObjID": ids, "fieldMJD_TAI": [60000.1 + k for k in range(len(ids))]}).to_csv(task.output, index=False)
        pd.DataFrame({"ObjID": ids, "fieldMJD_TAI": 1.0}).to_csv(task.ephemeris, index=False)

    def calls(self):
        return len(list(self.folder.iterdir())) if self.folder.exists() else 0


def options(tmp_path, fake, **more):
    return Options(**{"execute": fake, "results": tmp_path / "results", "chunk_size": 2, "workers": 2, "orbit_columns": ["ObjID", "a"], "physical_columns": ["ObjID", "H_r"], **more})


def report(tmp_path, name):
    path = next((tmp_path / "results").rglob(name))
    with path.open(newline="") as f:
        return list(csv.DictReader(f))


def combined(spark, tmp_path):
    return sorted(r["ObjID"] for r in spark.read.parquet(str(next((tmp_path / "results").glob("*_job_new.parquet")))).collect())


def test_plan(spark):
    got = R.plan(spark, 5, 2).orderBy("chunk").collect()
    assert [(r["chunk"], r["row_start"], r["row_end"]) for r in got] == [(0, 0, 2), (1, 2, 4), (2, 4, 5)]
    assert got[1]["node_id"] == "chunk_00001_rows_0000002_0000003"
    assert R.plan(spark, 0, 2).count() == 0


@pytest.mark.parametrize(("spec", "want"), [("1,3-5,8", {1, 3, 4, 5, 8}), (None, None), (" 2 ", {2})])
def test_selection(spec, want):
    assert R.parse_selection(spec) == want


@pytest.mark.parametrize("spec", ["5-3", "x", ""])
def test_bad_selection(spec):
    with pytest.raises(ValueError):
        R.parse_selection(spec)


@pytest.mark.parametrize(("n", "size"), [(0, 3), (1, 3), (10, 3), (12, 4)])
def test_chunks_partition_the_rows(spark, n, size):
    rows = spark.range(n).select(F.col("id").alias("input_row"))
    got = R.rows_in(R.plan(spark, n, size), rows, 5)
    assert sorted(r["input_row"] for r in got.collect()) == list(range(n))


def test_numbering_in_parts(spark, monkeypatch):
    monkeypatch.setattr(R, "SORT_ROWS", 50)
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(5)
    got = [tuple(r) for r in R.number_rows(df, "k").orderBy("input_row").select("input_row", "k").collect()]
    assert [g[0] for g in got] == list(range(1000)) and [g[1] for g in got] == sorted(g[1] for g in got)


def test_halves_and_debug_ranges_cover_their_parent(spark):
    parent = R.plan(spark, 7, 7)
    debug = R.debug_ranges(parent, 3).orderBy("row_start").collect()
    assert [(r["row_start"], r["row_end"], r["debug_level"]) for r in debug] == [(0, 3, 1), (3, 6, 1), (6, 7, 1)]
    half = R.halves(R.debug_ranges(parent, 3), 2).orderBy("row_start").collect()
    assert [(r["row_start"], r["row_end"]) for r in half] == [(0, 1), (1, 3), (3, 4), (4, 6)]


def test_runs_once_then_resumes(spark, tmp_path):
    fake = Fake(tmp_path / "calls")
    rows = rows_of(spark, "ABC")
    assert run_job(rows, "new", "2024-01-01T00", options(tmp_path, fake)) is True
    assert fake.calls() == 2 and combined(spark, tmp_path) == ["A", "B", "C"]
    assert run_job(rows, "new", "2024-01-02T00", options(tmp_path, fake)) is True
    assert fake.calls() == 2
    assert run_job(rows, "new", "2024-01-01T00", options(tmp_path, fake, context="other")) is True
    assert fake.calls() == 4
    assert run_job(rows, "new", "2024-01-01T00", options(tmp_path, fake, resume=False)) is True
    assert fake.calls() == 6


def test_missing_output_is_run_again(spark, tmp_path):
    fake, rows = Fake(tmp_path / "calls"), rows_of(spark, "AB")
    run_job(rows, "new", "2024-01-01", options(tmp_path, fake))
    for f in (tmp_path / "results").rglob("attempts_data/*/chunk_00000*.csv"):
        f.unlink()
    run_job(rows, "new", "2024-01-01", options(tmp_path, fake))
    assert fake.calls() == 2


def test_bad_row_is_isolated_and_the_rest_saved(spark, tmp_path):
    fake = Fake(tmp_path / "calls", bad="D")
    rows = rows_of(spark, "ABCD")
    assert run_job(rows, "new", "2024-01-01", options(tmp_path, fake, debug_size=1)) is True
    assert combined(spark, tmp_path) == ["A", "B", "C"]
    failing = report(tmp_path, "failing_rows.csv")
    assert [(r["ObjID"], r["failure_row_count"], r["catalog_row"]) for r in failing] == [("D", "1", "13")]
    assert [r["status"] for r in report(tmp_path, "output_audit.csv")] == ["ok", "ok"]
    assert [r["chunk_error"] for r in report(tmp_path, "failed_catalog_rows.csv")] == ["bad row ['D']"] * 2
    before = fake.calls()
    assert run_job(rows, "new", "2024-01-01", options(tmp_path, fake, debug_size=1)) is True
    assert fake.calls() == before  # failures are resumed as failures


@pytest.mark.parametrize(("bad", "rows"), [("C", ["2"]), ("CD", ["2", "3"])])
def test_isolation_levels(spark, tmp_path, bad, rows):
    fake = Fake(tmp_path / "calls", bad=bad)
    assert run_job(rows_of(spark, "ABCD"), "new", "2024-01-01", options(tmp_path, fake, chunk_size=4, debug_size=2)) is True
    assert [r["debug_level"] for r in report(tmp_path, "isolation_report.csv")] == ["1", "1", "2", "2"]
    assert [r["failure_input_row"] for r in report(tmp_path, "failing_rows.csv")] == rows
    assert report(tmp_path, "group_failures.csv") == []
    timing = report(tmp_path, "debug_timing_summary.csv")
    assert [(r["debug_level"], r["total_ranges"], r["failed"]) for r in timing] == [("1", "2", "1"), ("2", "2", str(len(rows)))]


def test_group_failure(spark, tmp_path):
    fake = Fake(tmp_path / "calls", bad="C", together=2)
    assert run_job(rows_of(spark, "ABCD"), "new", "2024-01-01", options(tmp_path, fake, chunk_size=4, debug_size=2)) is True
    group = report(tmp_path, "group_failures.csv")
    assert [(g["row_start"], g["row_end"], g["failure_type"]) for g in group] == [("2", "4", "group_failed_children_passed")]
    assert [r["group_failure_input_row"] for r in report(tmp_path, "group_failure_catalog_rows.csv")] == ["2", "3"]
    assert report(tmp_path, "failing_rows.csv") == [] and combined(spark, tmp_path) == list("ABCD")


def test_success_without_output(spark, tmp_path):
    fake = Fake(tmp_path / "calls", bad="D", silent="C")
    assert run_job(rows_of(spark, "ABCD"), "new", "2024-01-01", options(tmp_path, fake, debug_size=1)) is True
    assert combined(spark, tmp_path) == ["A", "B"]


def test_no_isolation_raises(spark, tmp_path):
    with pytest.raises(RuntimeError, match="chunk 00001: bad row"):
        run_job(rows_of(spark, "ABCD"), "new", "2024-01-01", options(tmp_path, Fake(tmp_path / "c", bad="D"), isolate=False))
    assert len(report(tmp_path, "subchunk_debug_report.csv")) == 1


def test_selected_and_forced_chunks(spark, tmp_path):
    fake = Fake(tmp_path / "calls")
    rows = rows_of(spark, "ABCDE")
    assert run_job(rows, "new", "2024-01-01", options(tmp_path, fake, only_chunks={1})) is False
    assert fake.calls() == 1
    with pytest.raises(ValueError, match="unknown chunk"):
        run_job(rows, "new", "2024-01-01", options(tmp_path, fake, only_chunks={9}))
    with pytest.raises(ValueError):
        run_job(rows, "new", "2024-01-01", options(tmp_path, fake, force_debug=True))
    assert run_job(rows, "new", "2024-01-01", options(tmp_path, fake, only_chunks={0}, force_debug=True, debug_size=1)) is False
    assert [r["row_count"] for r in report(tmp_path, "subchunk_debug_report.csv")] == ["1", "1"]


def test_unchunked_run_counts_as_done(spark, tmp_path):
    fake = Fake(tmp_path / "calls")
    assert run_job(rows_of(spark, "ABC"), "new", "2024-01-01", options(tmp_path, fake, chunk_size=0)) is True
    assert fake.calls() == 1


def test_subprocess_executor(tmp_path):
    task = E.Task(tmp_path / "o.csv", tmp_path / "p.csv", tmp_path / "out.csv", "db", "cfg", 1.0)
    run = lambda code: E.SubprocessExecutor(f"{sys.executable} -c \"{code}\" {{output_dir}} {{output_stem}}")(task)
    run("import sys; open(sys.argv[1] + '/' + sys.argv[2] + '.csv', 'w').write('x')")
    assert task.output.read_text() == "x"
    with pytest.raises(RuntimeError, match="exit code 3"):
        run("import sys; sys.exit(3)")
    with pytest.raises(TimeoutError, match="timed out"):
        run("import time; time.sleep(60)")


def test_audit(spark, tmp_path):
    rows = spark.createDataFrame([("A", 10), ("B", 11), ("B", 12)], "ObjID string, catalog_row long")
    source = spark.createDataFrame([("A", 1.0, "x"), ("B", 2.0, "y"), ("B", 2.0, "z"), (None, None, "n")], "ObjID string, fieldMJD_TAI double, value string")
    summary, missing = A.audit(source, source.where("value <> 'z'"), "detections", "p", 2, rows)
    assert (summary.status, summary.missing_rows, summary.missing_pairs, summary.source_rows, summary.combined_rows) == ("missing", 1, 1, 4, 3)
    r = missing.first()
    assert (r["object_id"], r["source_count"], r["combined_count"], r["missing_count"], r["catalog_row"]) == ("B", 2, 1, 1, 11)
    assert A.audit(source, source, "d", "p", 1, rows)[0].status == "ok"
    assert A.audit(None, None, "d", "p", 0, rows)[0].status == "skipped_no_key_columns"
    assert A.surplus(source, source.union(source), ["ObjID"]).count() == 3
    assert A.key_columns(source.select("value"), source) == ("ObjID", "fieldMJD_TAI")


def test_outputs_keep_text_and_union_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ObjID,fieldMJD_TAI,value\n00123,60000.10,x\n")
    (tmp_path / "b.csv").write_text("fieldMJD_TAI,ObjID\n5,\n")
    (tmp_path / "c.csv").write_text("")
    paths = [tmp_path / n for n in ("a.csv", "b.csv", "c.csv", "none.csv")]
    df = K.combine(spark, paths, tmp_path / "out.parquet")
    assert [tuple(r) for r in K.in_time_order(df).select("ObjID", "fieldMJD_TAI", "value").collect()] == [(None, 5.0, None), ("00123", 60000.1, "x")]
    assert K.combine(spark, paths[2:], tmp_path / "none.parquet") is None
    assert K.combine_csv([paths[0], paths[2], paths[3], paths[0]], tmp_path / "all.csv") == 2
    assert (tmp_path / "all.csv").read_text().count("ObjID") == 1


def test_publish(tmp_path):
    a, b = tmp_path / "a", tmp_path / "v" / "a"
    assert K.publish(a, b) == "missing"
    a.write_text("1")
    assert [K.publish(a, b), K.publish(a, b)] == ["linked", "already_visible"]
    other = tmp_path / "o"
    other.write_text("2")
    assert K.publish(other, b) == "conflict"


def test_snapshot_is_named_by_content(tmp_path):
    import gzip

    (tmp_path / "c.json").write_bytes(b"[1]")
    (tmp_path / "c2.json.gz").write_bytes(gzip.compress(b"[1]"))
    one, two = snapshot(tmp_path / "c.json", tmp_path / "r", "2024-01-01T"), snapshot(tmp_path / "c.json", tmp_path / "r", "2024-01-01T")
    assert one == two and gzip.decompress(one.read_bytes()) == b"[1]"
    assert snapshot(tmp_path / "c2.json.gz", tmp_path / "r", "2024-01-01T").name.split("_")[-1] == one.name.split("_")[-1]


def pointings(path, times):
    path.unlink(missing_ok=True)
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE observations (observationId INTEGER, observationStartMJD REAL)")
        db.executemany("INSERT INTO observations VALUES (?, ?)", list(enumerate(times)))


def test_sqlite(spark, tmp_path):
    pointings(tmp_path / "p.db", [10.0, 11.5, None, 12.0])
    df = read_sqlite(spark, tmp_path / "p.db")
    assert tuple(Q.extent(df, "observationStartMJD").first()) == (12.0, 4)
    later = Q.since(df, "observationStartMJD", 10.0)
    assert sorted(r[0] for r in later.collect()) == [1, 3]
    assert write_sqlite(later.where("false"), tmp_path / "w" / "n.db") == 0
    assert read_sqlite(spark, tmp_path / "w" / "n.db").count() == 0
    assert write_sqlite(later, tmp_path / "w" / "n.db") == 2 and read_sqlite(spark, tmp_path / "w" / "n.db").count() == 2


def asteroid(name, **more):
    return {"Principal_desig": name, "a": 2.0, "e": 0.1, "i": 1.0, "Node": 2.0, "Peri": 3.0, "M": 4.0, "Epoch": 2461000.5, "H": 15.0, "U": 0, "Arc_length": 5, **more}


def test_cycles(spark, tmp_path):
    fake = Fake(tmp_path / "calls")
    (tmp_path / "c.json").write_text(json.dumps([asteroid("A"), asteroid("B"), asteroid("X")]))
    (tmp_path / "cfg").write_text("")
    pointings(tmp_path / "p.db", [10.0])
    cycle = Cycle(tmp_path / "p.db", tmp_path / "c.json", tmp_path / "cfg", Options(fake, tmp_path / "results", chunk_size=10), ignore_ids=["X"], state_folder=tmp_path, work=tmp_path / "work")
    assert run_cycle(spark, cycle) is True
    state = State(tmp_path, tmp_path / "p.db", False)
    assert fake.calls() == 1 and state.watermark == 10.0 and state.baseline(spark).count() == 2
    assert run_cycle(spark, cycle) is True and fake.calls() == 1  # nothing new: nothing runs
    pointings(tmp_path / "p.db", [10.0, 11.0])
    (tmp_path / "c.json").write_text(json.dumps([asteroid("A", e=0.2), asteroid("B"), asteroid("C")]))
    assert run_cycle(spark, cycle) is True
    assert fake.calls() == 4 and state.watermark == 11.0  # updated A, unchanged B with the new pointing, new C
    assert {r[0] for r in state.baseline(spark).collect()} == {"A", "B", "C"}
    cycle.options.only_chunks = {0}
    (tmp_path / "c.json").write_text(json.dumps([asteroid("D")]))
    assert run_cycle(spark, cycle) is False and {r[0] for r in state.baseline(spark).collect()} == {"A", "B", "C"}


def test_tidy(spark, tmp_path):
    fake, rows = Fake(tmp_path / "calls"), rows_of(spark, "ABC")
    run_job(rows, "new", "2024-01-01", options(tmp_path, fake, only_chunks={0}))
    assert "missing_chunks=1" in maintenance.tidy(spark, tmp_path)[0]
    run_job(rows, "new", "2024-01-01", options(tmp_path, fake, only_chunks={0, 1}))
    said = maintenance.tidy(spark, tmp_path)
    assert said[0].startswith("combine ") and said[0].endswith(": planned") and not list((tmp_path / "results").glob("*.parquet"))
    maintenance.tidy(spark, tmp_path, apply=True)
    assert combined(spark, tmp_path) == ["A", "B", "C"]
    (tmp_path / "results" / "x-simulator.log").write_text("")
    assert any(s.startswith("file ") and s.endswith(": filed") for s in maintenance.tidy(spark, tmp_path, apply=True))
    assert (tmp_path / "results" / "logs" / "x-simulator.log").exists()


def test_published_outputs_restore_a_runs_own(spark, tmp_path):
    run_job(rows_of(spark, "ABC"), "new", "2024-01-01", options(tmp_path, Fake(tmp_path / "calls")))
    results = tmp_path / "results"
    own = next(results.rglob("chunk_runs/*/2024-01-01_job_new.parquet"))
    shutil.rmtree(own)
    said = maintenance.tidy(spark, tmp_path, apply=True)
    assert any(s.startswith("restore ") and s.endswith((": linked", ": copied")) for s in said)
    assert sorted(r["ObjID"] for r in spark.read.parquet(str(own)).collect()) == ["A", "B", "C"]
    assert sum(s.endswith(": already_visible") for s in maintenance.tidy(spark, tmp_path, apply=True)) == 2


def older_run(root, job="new", chunks=2, done=2, ephemeris=True):
    """A run as earlier versions left it: CSV chunk files with markers, named by the manifest."""
    run, work = root / "results" / f"2024-05-06_job_{job}_0123456789ab", root / "work" / f"2024-05-06_job_{job}_0123456789ab"
    run.mkdir(parents=True)
    work.mkdir(parents=True)
    listed = []
    for k in range(chunks):
        path = work / f"chunk_{k:05d}.csv"
        listed.append({"index": k, "output_path": str(path.relative_to(root))})
        if k < done:
            path.write_text(f"ObjID,x\nobject{k},{k}\n")
            path.with_suffix(".done").write_text(json.dumps({"output_exists": True, "ew_output_exists": ephemeris}))
            if ephemeris:
                path.with_name(f"chunk_{k:05d}_ew.csv").write_text(f"ObjID,y\nobject{k},{k}\n")
    (run / "manifest.json").write_text(json.dumps({"job_name": job, "chunks": listed}))
    return run, work


def test_older_runs_become_csv(spark, tmp_path):
    run, work = older_run(tmp_path)
    maintenance.tidy(spark, tmp_path)
    assert run.exists() and not list(run.glob("*.csv"))  # nothing is done without being asked for
    maintenance.tidy(spark, tmp_path, apply=True)
    filed = tmp_path / "results" / "chunk_runs" / run.name
    for folder in (tmp_path / "results", filed):
        assert (folder / "2024-05-06_job_new.csv").read_text() == "ObjID,x\nobject0,0\nobject1,1\n"
        assert (folder / "2024-05-06_job_new_ew.csv").read_text() == "ObjID,y\nobject0,0\nobject1,1\n"
    assert (tmp_path / "work" / "chunk_runs" / work.name).exists() and not run.exists()


def test_older_runs_with_open_chunks(spark, tmp_path):
    run, _ = older_run(tmp_path, done=1)
    said = maintenance.tidy(spark, tmp_path, apply=True, archive=False)
    assert said == [f"keep {run}: incomplete, missing_chunks=1"]
    for name in ("2024-05-06_job_new.csv", "2024-05-06_job_new_ew.csv"):
        (run / name).write_text("ObjID\n")
    audits = [("", False), ("status,missing_rows\n", False), ("status,missing_rows\nok,many\n", False), ("status,missing_rows\nok,1\n", False), ("status,missing_rows\nmissing,0\n", False), ("status,missing_rows\nok,0\nok,\n", True)]
    for text, fine in audits:  # a malformed audit is one that didn't pass
        (run / "output_audit.csv").write_text(text)
        assert maintenance.audit_ok(run) is fine
        assert ("missing_chunks" in maintenance.tidy(spark, tmp_path, archive=False)[0]) is not fine
    maintenance.tidy(spark, tmp_path, apply=True, archive=False)
    assert (tmp_path / "results" / "2024-05-06_job_new.csv").samefile(run / "2024-05-06_job_new.csv")


def test_chunks_without_output_count_as_complete(spark, tmp_path):
    run, _ = older_run(tmp_path, ephemeris=False)
    (tmp_path / "results" / "broken").mkdir()
    (tmp_path / "results" / "broken" / "manifest.json").write_text("{")
    said = maintenance.tidy(spark, tmp_path, apply=True, archive=False)
    assert any("broken" in s and s.startswith("keep") for s in said)
    assert (tmp_path / "results" / "2024-05-06_job_new.csv").exists() and (run / "2024-05-06_job_new_ew.csv").read_text() == ""


def test_maintenance_command(spark, tmp_path, capsys):
    run, _ = older_run(tmp_path)
    maintenance.main([str(tmp_path)])
    assert "planned" in capsys.readouterr().out and run.exists()
    maintenance.main([str(tmp_path), "--apply", "--no-archive"])
    assert run.exists() and (tmp_path / "results" / "2024-05-06_job_new.csv").exists()


def test_runs_resume_from_older_markers(spark, tmp_path):
    fake, rows = Fake(tmp_path / "calls"), rows_of(spark, "ABC")
    own = options(tmp_path, fake)
    run = Run(rows, "new", "2024-01-01", own)
    first = run.plan.orderBy("chunk").first()
    out = run.folder / "old" / f"{first['node_id']}.csv"
    out.parent.mkdir(parents=True)
    out.write_text("ObjID,fieldMJD_TAI\nA,1.0\nB,2.0\n")
    marker = {"chunk": 0, "row_start": 0, "row_end": 2, "output_path": str(out), "output_exists": True, "ew_output_exists": False}
    out.with_suffix(".done").write_text(json.dumps(marker))
    assert run_job(rows, "new", "2024-01-01", own) is True
    assert fake.calls() == 1 and combined(spark, tmp_path) == ["A", "B", "C"]


def test_cli(tmp_path, capsys):
    assert cli.main([]) == 2
    assert cli.main(["--download_orbits"], fetch=lambda *a: tmp_path / "c.json") == 0
    assert "No database" in capsys.readouterr().out
    with pytest.raises(ValueError):
        cli.main(["--db", "d", "--orbits", "o", "--config", "c", "--force-debug-chunking"])


def test_stream_takes_up_each_file_once(spark, tmp_path):
    from skyledger.streaming.pointings import take_up_into

    schema = "observationId long, observationStartMJD double"
    for n, t in enumerate((9.0, 11.0)):
        spark.createDataFrame([(n, t)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    at = (str(tmp_path / "in"), schema, str(tmp_path / "ck"), str(tmp_path / "out"), "observationStartMJD", 10.0)
    take_up_into(spark, *at)
    spark.createDataFrame([(2, 12.0)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    take_up_into(spark, *at)
    take_up_into(spark, *at)
    assert sorted(r[0] for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_json_state_reads(tmp_path):
    (tmp_path / "bad").write_text("{")
    assert C.read_json(tmp_path / "bad") == {} == C.read_json(tmp_path / "none")


def test_large_catalogs_are_split(spark, tmp_path, monkeypatch):
    import gzip
    import io

    objects = [asteroid(f"O{k}", Arc_length=3.0 if k % 2 else "3 days") for k in range(300)]
    objects[5] = 7
    with gzip.open(tmp_path / "c.json.gz", "wt") as f:
        json.dump(objects, f)
    values = [1, 23, "a]", {"b": [2]}, None]
    assert list(C.elements(io.StringIO(json.dumps(values)), block=3)) == [(v, json.dumps(v)) for v in values]
    whole = C.read_catalog(spark, str(tmp_path / "c.json.gz"))
    monkeypatch.setattr(C, "WHOLE_GZ_BYTES", 10)
    monkeypatch.setattr(C, "split_catalog", lambda path, folder, f=C.split_catalog: f(path, folder, 100))
    split = C.read_catalog(spark, str(tmp_path / "c.json.gz"), tmp_path / "work")
    text = lambda df: sorted((r["catalog_row"], r["j"]) for r in df.select("catalog_row", F.to_json("obj").alias("j")).collect())
    assert len(list((tmp_path / "work").rglob("objects-*.json"))) == 3 and len(text(split)) == 299
    assert [(n, json.loads(j)) for n, j in text(split)] == [(n, json.loads(j)) for n, j in text(whole)]


def test_old_markers(spark, tmp_path):
    (tmp_path / "a.done").write_text(json.dumps({"chunk": 1, "row_start": 0, "row_end": 2, "duration_seconds": 2.5, "completed_at": "t"}))
    (tmp_path / "b.failed").write_text(json.dumps({"chunk": 2, "row_start": 2, "row_end": 4, "error": "it Timed out", "failed_at": "u", "debug_level": ""}))
    (tmp_path / "c.failed").write_text("{")
    got = {r["node_id"]: r for r in E.read_markers(spark, [str(tmp_path)]).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["status"], a["simulator_seconds"], a["parent_chunk"], a["output_exists"], a["resumed"]) == ("done", 2.5, 1, True, True)
    assert (b["status"], b["completed_at"], b["timed_out"], b["debug_level"]) == ("failed", "u", True, None)
    assert (c["status"], c["error"]) == ("failed", "")


def test_numbers_keep_their_spelling_on_both_paths(spark, tmp_path, monkeypatch):
    from skyledger.operators import relational as Q

    text = '[{"Principal_desig": "A",\n "e": 0.12345678901234567890, "i": 1.50},\r\n {"Principal_desig": "B", "e": 1e-7, "Node": 12345678901234567890123}]'
    (tmp_path / "c.json").write_text(text)
    rows = lambda df: [(r["catalog_row"], r["element_hash"], r["j"]) for r in Q.identified(df).select("catalog_row", "element_hash", F.to_json("obj").alias("j")).orderBy("catalog_row").collect()]
    whole = rows(C.read_catalog(spark, str(tmp_path / "c.json")))
    monkeypatch.setattr(C, "WHOLE_BYTES", 10)
    assert rows(C.read_catalog(spark, str(tmp_path / "c.json"), tmp_path / "work")) == whole


def test_numbering_with_one_frequent_key(spark, monkeypatch):
    monkeypatch.setattr(R, "SORT_ROWS", 40)
    monkeypatch.setattr(R, "SPLITS", 5)  # two steps
    rows = spark.range(900).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("k"), (F.col("id") * 37 % 900).alias("n"))
    points = R._points(rows, ("k", "n"), 900, 22)
    assert len(points) > 15 and sum(p[0] == "hot" for p in points) > 10  # the frequent key itself is divided
    got = R.number_rows(rows, "k", "n").orderBy("input_row").collect()
    want = sorted(((r["k"], r["n"]) for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert [(r["k"], r["n"]) for r in got] == want and [r["input_row"] for r in got] == [*range(900)]


def test_ranges_are_dealt_in_turn(spark, tmp_path):
    fake = Fake(tmp_path / "calls")
    todo = R.plan(spark, 12, 2)
    attempts = E.run_ranges(rows_of(spark, "ABCDEFGHIJKL"), todo, tmp_path / "run", fake, ["ObjID", "a"], ["ObjID", "H_r"], workers=3)
    per_task = attempts.select(F.spark_partition_id().alias("p"), "chunk").collect()
    dealt = {}
    for r in per_task:
        dealt.setdefault(r["p"], []).append(r["chunk"])
    assert sorted(map(len, dealt.values())) == [2, 2, 2] and all(b - a == 3 for a, b in map(sorted, dealt.values()))


def test_windowed_counts_of_a_stream(spark, tmp_path):
    from skyledger.streaming.pointings import windowed_counts

    schema = "ts timestamp, kind string"
    times = ["2024-01-01 00:01:00", "2024-01-01 00:04:00", "2024-01-01 00:07:00", "2024-01-01 02:00:00"]
    spark.createDataFrame([(t, "a") for t in times], "ts string, kind string").select(F.col("ts").cast("timestamp"), "kind").coalesce(1).write.parquet(str(tmp_path / "in"))
    late = spark.createDataFrame([("2024-01-01 00:02:00", "a")], "ts string, kind string").select(F.col("ts").cast("timestamp"), "kind")

    def run():
        stream = windowed_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "ts", "5 minutes", "10 minutes", "kind")
        stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    run()
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # two hours late: left out
    run()
    got = spark.read.parquet(str(tmp_path / "out")).select(F.date_format("window.start", "HH:mm").alias("t"), "kind", "n").collect()
    assert sorted(map(tuple, got)) == [("00:00", "a", 2), ("00:05", "a", 1)]
