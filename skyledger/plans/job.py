"""One job: rows in resumable chunks through an executor; failures isolated, the rest combined and audited."""

from __future__ import annotations

import hashlib
import time as clock
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.digests import frame_digest
from skyledger.operators import audit as A
from skyledger.operators import combine as K
from skyledger.operators import execute as E
from skyledger.operators import isolate as I
from skyledger.operators import ranges as R
from skyledger.operators import reports
from skyledger.operators.convert import ORBIT_COLUMNS, PHYSICAL_COLUMNS
from skyledger.sources import storage

from .state import write_json

RUNS = "chunk_runs"
#: Failures that a message names; the report has all.
MOST_ERRORS = 100


@dataclass
class Options:
    execute: E.Executor
    results: Path = Path("results")
    database: str = ""
    config: str = ""
    chunk_size: int = 5000
    workers: int = 1
    timeout: float | None = None
    resume: bool = True
    only_chunks: set[int] | None = None
    debug_size: int = 250
    force_debug: bool = False
    isolate: bool = True
    snapshot: str = ""
    context: str = ""
    orbit_columns: list[str] = field(default_factory=lambda: list(ORBIT_COLUMNS["KEP"]))
    physical_columns: list[str] = field(default_factory=lambda: list(PHYSICAL_COLUMNS))

    def check(self) -> None:
        if self.force_debug and self.only_chunks is None:
            raise ValueError("forced debug chunking needs selected chunks")
        if (self.force_debug or self.isolate) and self.debug_size <= 0:
            raise ValueError("forced debug chunking and isolation need a positive debug size")


class Run:
    """The folder, attempts and ranges of one job's inputs in one context."""

    def __init__(self, rows: DataFrame, job: str, time: str, options: Options):
        options.check()
        self.spark: SparkSession = rows.sparkSession
        self.job, self.date, self.o, self.rows = job, time[:10], options, rows
        inputs = rows.select("input_row", *(F.col(f"`{c}`") for c in dict.fromkeys([*options.orbit_columns, *options.physical_columns])))
        digest = frame_digest(inputs)
        self.digest = hashlib.sha256(f"{digest}|{options.context}".encode()).hexdigest() if options.context else digest
        self.folder = Path(options.results).resolve() / RUNS / f"job_{job}_{self.digest[:12]}"
        self.debug_folder = self.folder / "debug"
        self.count = rows.count()
        self.plan = R.plan(self.spark, self.count, options.chunk_size)

    def attempts(self) -> DataFrame:
        """The last attempt of every node, older runs' markers included."""
        return E.recorded(self.spark, self.folder)

    def execute(self, ranges: DataFrame) -> DataFrame:
        """Attempts of all ranges: those that earlier runs left, and new ones of the others. What is executed
        is written before it is read, so nothing is executed twice."""
        held, earlier = None, self.attempts() if (self.folder / "attempts").is_dir() else None
        if self.o.resume:
            held = E.complete(self.attempts() if earlier is None else earlier, self.folder).join(ranges.select("node_id"), "node_id", "left_semi").select(*E.ATTEMPT_COLUMNS)
            held = E.held(held)
            held = None if held.isEmpty() else held
        todo = ranges if held is None else ranges.join(held.select("node_id"), "node_id", "left_anti")
        out = None
        if not todo.isEmpty():
            at = storage.uri(self.folder / "attempts" / uuid.uuid4().hex)
            todo = todo if earlier is None else E.expected_seconds(todo, earlier)
            new = E.run_ranges(self.rows, todo, self.folder, self.o.execute, self.o.orbit_columns, self.o.physical_columns, self.o.database, self.o.config, self.o.timeout, self.o.workers)
            new.write.parquet(at)
            out = self.spark.read.schema(E.ATTEMPT).parquet(at)
        if held is not None:
            held = held.withColumns({"resumed": F.lit(True), "worker_count": F.lit(self.o.workers)})
            out = held if out is None else out.unionByName(held)
        return out if out is not None else self.spark.createDataFrame([], E.ATTEMPT)

    def forced(self, ranges: DataFrame) -> DataFrame:
        """Failed attempts of ranges that weren't run."""
        rows = [E.attempt(r.asDict(), "failed", "forced debug chunking", workers=self.o.workers) for r in ranges.collect()]
        return self.spark.createDataFrame([tuple(r[c] for c in E.ATTEMPT_COLUMNS) for r in rows], E.ATTEMPT)

    def debug(self, failed: DataFrame) -> DataFrame | None:
        """Debug ranges of failed chunks, then isolation; None if the debug size forbids it."""
        if self.o.debug_size <= 0:
            return None
        began = clock.perf_counter()
        first = I.debug(failed, self.execute, self.o.debug_size)
        reports.write_debug(self.debug_folder, first, self.rows, self.o.debug_size)
        every = I.isolate(first, self.execute) if self.o.isolate else first
        wall = clock.perf_counter() - began
        if self.o.isolate:
            reports.write_isolation(self.debug_folder, every, self.rows, self.o.debug_size, wall)
        else:
            reports.write_csv(reports.timing_summary(every, wall), self.debug_folder / "debug_timing_summary.csv")
        return every

    def write_manifest(self) -> None:
        chunks = [{"index": r["chunk"], "row_start": r["row_start"], "row_end": r["row_end"], "node_id": r["node_id"]} for r in self.plan.orderBy("chunk").toLocalIterator()]
        write_json(self.folder / "manifest.json", {"job_name": self.job, "date": self.date, "row_count": self.count, "chunk_size": self.o.chunk_size, "digest": self.digest, "context_digest": self.o.context, "catalog_snapshot_path": self.o.snapshot, "chunks": chunks})

    def finish(self, used: DataFrame) -> None:
        """Combines, audits and publishes the outputs of the attempts used."""
        finish(self.spark, self.folder, self.date, self.job, used, self.rows, Path(self.o.results).resolve())


def finals(folder: Path, date: str, job: str) -> dict[str, Path]:
    return {"detections": folder / f"{date}_job_{job}.parquet", "ephemeris": folder / f"{date}_job_{job}_ew.parquet"}


def outputs(attempts: DataFrame) -> dict[str, list[str]]:
    rows = attempts.select("output_path", "output_exists", "ew_output_exists").collect()
    return {
        "detections": [r["output_path"] for r in rows if r["output_exists"]],
        "ephemeris": [r["output_path"].removesuffix(".csv") + "_ew.csv" for r in rows if r["ew_output_exists"]],
    }


def finish(spark: SparkSession, folder: Path, date: str, job: str, used: DataFrame, rows: DataFrame, results: Path) -> dict[str, str]:
    paths, visible = outputs(used), finals(results, date, job)
    summaries, lost = [], None
    for name, target in finals(folder, date, job).items():
        combined = K.combine(spark, paths[name], target)
        source = K.C.read_outputs(spark, paths[name], K.OUTPUT_SCHEMA)
        summary, missing = A.audit(source, combined, name, str(target), len(paths[name]), rows)
        summaries.append(summary.row())
        if missing is not None:
            lost = missing if lost is None else lost.unionByName(missing, allowMissingColumns=True)
    reports.write_csv(spark.createDataFrame([tuple(s[c] for c in A.SUMMARY) for s in summaries], ", ".join(f"{c} {'long' if c.endswith(('_rows', '_pairs', '_count')) else 'string'}" for c in A.SUMMARY)), folder / "output_audit.csv")
    reports.write_csv(lost if lost is not None else spark.createDataFrame([], ", ".join(f"{c} string" for c in A.MISSING)), folder / "missing_output_pairs.csv")
    return {name: K.publish(target, visible[name]) for name, target in finals(folder, date, job).items()}


def run_job(rows: DataFrame, job: str, time: str, options: Options, say: Callable[[str], None] = print) -> bool:
    """True: all outputs are combined. False: a diagnostic run, of selected chunks. Failures that can't be
    isolated raise RuntimeError. `rows` has input_row, the simulator's columns and catalog columns."""
    options.check()
    if options.chunk_size <= 0:  # one range, not resumed
        options = Options(**{**options.__dict__, "chunk_size": max(1, rows.count()), "resume": False, "isolate": False, "debug_size": 0})
    run = Run(rows, job, time, options)
    chosen = run.plan
    if options.only_chunks is not None:
        unknown = sorted(options.only_chunks - set(range(-(-run.count // options.chunk_size))))
        if unknown:
            raise ValueError(f"unknown chunk index for {job}: {unknown[0]}")
        chosen = R.select_chunks(run.plan, options.only_chunks)
    run.write_manifest()
    if options.force_debug:
        run.debug(run.forced(chosen))
        say(f"  {job}: forced debug chunking is done; nothing is combined")
        return False
    attempts = run.execute(chosen)
    failed = attempts.where("status = 'failed'")
    say(f"  {job}: {run.count} rows, " + ", ".join(f"{r['n']} chunks {r['status']}" for r in attempts.groupBy("status").agg(F.count("*").alias("n")).orderBy("status").collect()))
    if not failed.isEmpty():
        reports.write_failures(run.folder, failed, rows, options.chunk_size)
        tree = run.debug(failed)
        if options.only_chunks is None and options.isolate and tree is not None and I.unresolved(tree).isEmpty():
            used = I.salvage(attempts, tree)
            if used.isEmpty():
                raise RuntimeError(f"all of {job} failed; there is nothing to combine")
            run.finish(used)
            say(f"  {job}: combined without {I.failing_rows(tree).count()} failing rows")
            return True
        first = failed.orderBy("chunk").limit(MOST_ERRORS + 1).collect()
        errors = ", ".join(f"chunk {r['chunk']:05d}: {r['error']}" for r in first[:MOST_ERRORS])
        raise RuntimeError(f"chunks of {job} failed: {errors}" + (f", and more: see {run.folder / 'failures.csv'}" if len(first) > MOST_ERRORS else ""))
    if options.only_chunks is not None:
        say(f"  {job}: selected chunks are done; nothing is combined")
        return False
    run.finish(attempts.orderBy("row_start"))
    return True
