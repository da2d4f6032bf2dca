"""Black-box execution of row ranges: one task call for each range, failures as rows.

Every attempt writes its files into a folder of its own, so a retried Spark task leaves the other
attempt's files unread. Simulator errors are caught and returned as `failed` attempts; Spark only
retries what the cluster itself loses.
"""

from __future__ import annotations

import contextlib
import heapq
import os
import shlex
import signal
import subprocess
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources import storage

from . import ranges as R

GRACE_SECONDS = 10
ATTEMPT = (
    "chunk long, parent_chunk long, node_id string, parent_node_id string, debug_level int, row_start long, row_end long, row_count long, "
    "status string, error string, started_at string, completed_at string, duration_seconds double, input_write_seconds double, "
    "simulator_seconds double, timed_out boolean, resumed boolean, worker_count int, chunk_size long, failed_path string, "
    "orbits_path string, physparams_path string, output_path string, output_exists boolean, ew_output_exists boolean"
)
ATTEMPT_COLUMNS = [c.split()[0] for c in ATTEMPT.split(", ")]


@dataclass
class Task:
    """What an executor gets: input files, where outputs go, and the job's context."""

    orbits: Path
    physics: Path
    output: Path
    database: str
    config: str
    timeout: float | None = None

    @property
    def ephemeris(self) -> Path:
        return self.output.with_name(f"{self.output.stem}_ew.csv")


Executor = Callable[[Task], None]


def stop_group(process: subprocess.Popen, grace: float = GRACE_SECONDS) -> None:
    """Ends a process and all it has started: politely, then for good."""
    for sign in (signal.SIGTERM, signal.SIGKILL):
        with contextlib.suppress(ProcessLookupError, PermissionError):
            os.killpg(process.pid, sign)
        with contextlib.suppress(subprocess.TimeoutExpired):
            process.wait(grace)
            return


@dataclass
class SubprocessExecutor:
    """Runs a simulator's command line. `command` has the places {config}, {orbits}, {physics}, {database},
    {output_dir} and {output_stem}; the simulator writes <stem>.csv and <stem>_ew.csv into output_dir."""

    command: str

    def __call__(self, task: Task) -> None:
        places = {"config": task.config, "orbits": task.orbits, "physics": task.physics, "database": task.database, "output_dir": task.output.parent, "output_stem": task.output.stem}
        args = [a.format(**places) for a in shlex.split(self.command)]
        process = subprocess.Popen(args, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True, start_new_session=True)
        try:
            said, _ = process.communicate(timeout=task.timeout)
        except subprocess.TimeoutExpired:
            stop_group(process)
            raise TimeoutError(f"simulator timed out after {task.timeout:g} seconds") from None
        except BaseException:
            stop_group(process)
            raise
        if process.returncode:
            raise RuntimeError(f"simulator failed with exit code {process.returncode}: {said[-500:].strip()}")


@dataclass
class FunctionExecutor:
    """Calls simulate(orbits, physics), which returns detections and ephemeris (frames or None)."""

    simulate: Callable[[pd.DataFrame, pd.DataFrame], tuple[pd.DataFrame | None, pd.DataFrame | None]]

    def __call__(self, task: Task) -> None:
        for frame, path in zip(self.simulate(pd.read_csv(task.orbits, dtype={"ObjID": str}), pd.read_csv(task.physics, dtype={"ObjID": str})), (task.output, task.ephemeris), strict=True):
            if frame is not None:
                frame.to_csv(path, index=False)


def now() -> str:
    return datetime.now(UTC).isoformat()


def attempt(head: dict, status: str, error: str = "", started: str = "", input_seconds: float = 0.0, seconds: float = 0.0, workers: int = 1, paths: tuple[str, str, str] = ("", "", ""), resumed: bool = False) -> dict:
    """One attempt's row; `head` has the range's own columns."""
    orbits, physics, output = paths
    exists = [bool(output) and Path(p).exists() for p in (output, output.removesuffix(".csv") + "_ew.csv")]
    return {
        **{k: head[k] for k in ("chunk", "parent_chunk", "node_id", "parent_node_id", "debug_level", "row_start", "row_end")},
        "row_count": head["row_end"] - head["row_start"], "status": status, "error": error, "started_at": started, "completed_at": now(),
        "duration_seconds": input_seconds + seconds, "input_write_seconds": input_seconds, "simulator_seconds": seconds, "timed_out": "timed out" in error.lower(),
        "resumed": resumed, "worker_count": workers, "chunk_size": head["chunk_size"] or head["row_end"] - head["row_start"],
        "failed_path": "" if status == "done" else output, "orbits_path": orbits, "physparams_path": physics, "output_path": output,
        "output_exists": exists[0], "ew_output_exists": exists[1],
    }


def expected_seconds(todo: DataFrame, earlier: DataFrame) -> DataFrame:
    """todo with `expected`: the simulator's seconds that a range will take, by the rate of its parent's or its own last attempt, else by that of all
    attempts, else its rows."""
    rate = F.sum("simulator_seconds") / F.nullif(F.sum("row_count"), F.lit(0))
    known = earlier.groupBy(F.col("node_id").alias("__node")).agg(rate.alias("__rate"))
    whole = earlier.agg(rate).first()[0]
    of = lambda column, out: known.select(F.col("__node").alias(column), F.col("__rate").alias(out))
    met = todo.join(of("node_id", "__own"), "node_id", "left").join(of("parent_node_id", "__parent"), "parent_node_id", "left")
    seconds = F.coalesce("__own", "__parent", F.lit(float(whole) if whole else 1.0)) * (F.col("row_end") - F.col("row_start"))
    return met.withColumn("expected", seconds).drop("__own", "__parent")


def dealt(todo: DataFrame, workers: int) -> DataFrame:
    """todo with its worker (__turn) and its place in that worker's work: ranges go, longest first, to the worker with the least to do so
    far. A range stands for thousands of rows, so their list is small."""
    cost = F.col("expected") if "expected" in todo.columns else F.col("row_end") - F.col("row_start")
    ranges = todo.select("node_id", "row_start", cost.cast("double").alias("cost")).collect()
    load, out = [(0.0, k) for k in range(max(1, workers))], []
    for place, r in enumerate(sorted(ranges, key=lambda r: (-r["cost"], r["row_start"], r["node_id"]))):
        seconds, worker = heapq.heappop(load)
        out.append((r["node_id"], worker, place))
        heapq.heappush(load, (seconds + r["cost"], worker))
    return todo.join(F.broadcast(todo.sparkSession.createDataFrame(out, "node_id string, __turn int, __place int")), "node_id")


def run_ranges(rows: DataFrame, todo: DataFrame, folder: str | Path, execute: Executor, orbit_columns: list[str], physical_columns: list[str], database: str = "", config: str = "", timeout: float | None = None, workers: int = 1) -> DataFrame:
    """Executes the ranges `todo` over numbered rows, at most `workers` at once, those expected to take longest first; attempts, lazily."""
    root = Path(folder)
    heads = ["chunk", "parent_chunk", "node_id", "parent_node_id", "debug_level", "row_start", "row_end", "chunk_size"]
    columns = list(dict.fromkeys([*orbit_columns, *physical_columns]))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("input_row")
        first = frame.iloc[0]
        head = {k: (None if pd.isna(first[k]) else first[k]) for k in heads}
        place = root / "attempts_data" / f"{head['node_id']}-{uuid.uuid4().hex}"
        task = Task(place / "orbits.csv", place / "physparams.csv", place / f"{head['node_id']}.csv", database, config, timeout)
        paths = (str(task.orbits), str(task.physics), str(task.output))
        started, t0 = now(), time.perf_counter()
        place.mkdir(parents=True)
        frame[orbit_columns].to_csv(task.orbits, index=False)
        frame[physical_columns].to_csv(task.physics, index=False)
        t1, status, error = time.perf_counter(), "done", ""
        try:
            execute(task)
        except Exception as e:
            status, error = "failed", str(e) or type(e).__name__
        row = attempt(head, status, error, started, t1 - t0, time.perf_counter() - t1, workers, paths)
        return pd.DataFrame([row], columns=ATTEMPT_COLUMNS).astype({"debug_level": "Int32", "worker_count": "int32"})

    step = max(1, todo.agg(F.max(F.col("row_end") - F.col("row_start"))).first()[0] or 1)
    given = R.rows_in(dealt(todo, workers).select(*heads, "__turn", "__place"), rows.select("input_row", *(F.col(f"`{c}`") for c in columns)), step)
    return given.repartitionById(max(1, workers), F.col("__turn")).groupBy("__turn", "__place", "node_id").applyInPandas(one, ATTEMPT)


def held(attempts: DataFrame) -> DataFrame:
    """A small table of ranges or attempts (one row for thousands of objects), worked out once."""
    table = attempts.toArrow()
    session = attempts.sparkSession
    return session.createDataFrame(table, attempts.schema) if table.num_rows else session.createDataFrame([], attempts.schema)


def latest(attempts: DataFrame) -> DataFrame:
    """The last attempt of each node."""
    return attempts.groupBy("node_id").agg(F.max_by(F.struct(*ATTEMPT_COLUMNS), F.struct("completed_at", "started_at")).alias("a")).select("a.*")


def recorded(spark: SparkSession, folder: Path) -> DataFrame:
    """The last attempt of every node below a run's folder: of its own attempts, and of older runs' markers."""
    found = sorted(storage.uri(p.parent) for p in (folder / "attempts").glob("*/_SUCCESS"))
    read = spark.read.schema(ATTEMPT).parquet(*found) if found else spark.createDataFrame([], ATTEMPT)
    markers = sorted(str(p) for kind in ("done", "failed") for p in folder.rglob(f"*.{kind}"))
    return latest(read.unionByName(read_markers(spark, markers)) if markers else read)


def complete(attempts: DataFrame, folder: Path) -> DataFrame:
    """Attempts whose outcome still holds: failed ones, and done ones whose expected files exist. The folder is
    listed once."""
    spark = attempts.sparkSession
    files = spark.createDataFrame([], "path string")
    if next(folder.rglob("*.csv"), None):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(storage.uri(folder)).select("path")
    there = files.select(F.regexp_replace("path", "^file:/+", "/").alias("__there")).distinct()
    for expected, path in (("output_exists", F.col("output_path")), ("ew_output_exists", F.regexp_replace("output_path", r"\.csv$", "_ew.csv"))):
        held = attempts.join(there, path == F.col("__there"), "left").where((F.col("status") == "failed") | ~F.coalesce(expected, F.lit(False)) | F.col("__there").isNotNull())
        attempts = held.drop("__there")
    return attempts


def read_markers(spark: SparkSession, paths: list[str], seconds: str = "simulator_seconds") -> DataFrame:
    """Attempts from the JSON markers (.done, .failed) of file-based runs, older forms included: the name
    tells the status; `failed_at` stands in for completed_at, duration_seconds for the simulator's
    seconds; what is missing has its default, and malformed markers only their status."""
    kinds = {c.split()[0]: c.split()[1] for c in ATTEMPT.split(", ")}
    fields = ", ".join(f"{c}: string" for c in dict.fromkeys([*kinds, "failed_at", seconds]))
    text = spark.read.text([storage.uri(p) for p in paths], wholetext=True).select(F.from_json("value", f"struct<{fields}>").alias("m"), F.col("_metadata.file_name").alias("f"))
    done = F.col("f").endswith(".done")
    m = lambda c: F.col(f"m.{c}")
    node = F.regexp_replace("f", r"\.(done|failed)$", "")
    value = {c: m(c).try_cast(k) if c != "simulator_seconds" else F.coalesce(m(seconds), m("duration_seconds")).try_cast("double") for c, k in kinds.items()}
    value |= {"status": F.when(done, "done").otherwise("failed"), "resumed": F.lit(True), "completed_at": F.coalesce(m("completed_at"), m("failed_at"), F.lit("")), "node_id": F.coalesce(F.nullif(m("node_id"), F.lit("")), node)}
    for c in ("error", "started_at", "parent_node_id", "orbits_path", "physparams_path", "output_path"):
        value[c] = F.coalesce(value[c], F.lit(""))
    for c, k in kinds.items():
        if k in ("double", "long", "int") and c not in ("debug_level", "chunk", "row_start", "row_end"):
            value[c] = F.coalesce(value[c], F.lit(0).cast(k))
    value["parent_chunk"] = F.coalesce(m("parent_chunk").try_cast("long"), m("chunk").try_cast("long"))
    value["timed_out"] = F.coalesce(value["timed_out"], F.lower(value["error"]).contains("timed out"))
    value["failed_path"] = F.when(done, "").otherwise(F.coalesce(m("failed_path"), F.lit("")))
    for c in ("output_exists", "ew_output_exists"):
        value[c] = F.coalesce(value[c], done)
    return text.select(*(value[c].cast(kinds[c]).alias(c) for c in ATTEMPT_COLUMNS))
