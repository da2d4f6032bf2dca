"""Reports on attempts: failures, isolation, timings, and the catalog rows behind them."""

from __future__ import annotations

import csv
import shutil
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.sources import storage

from . import isolate as I
from . import ranges as R

#: Bytes of a report that is one file.
SMALL = 64 << 20
PREFIXED = ["parent_chunk", "node_id", "parent_node_id", "debug_level", "row_start", "row_end", "row_count", "status", "error", "duration_seconds", "simulator_seconds", "resumed"]


def write_csv(df: DataFrame, path: str | Path) -> Path:
    """A report as CSV with a header even if there are no rows. Tasks write it; up to SMALL bytes their files are joined into one, beyond, the
    report is a folder of that name, of files with a header each, which reads the same."""
    path, spark = Path(path), df.sparkSession
    path.parent.mkdir(parents=True, exist_ok=True)
    kinds = dict(df.dtypes)
    text = df.select(*(F.initcap(F.col(f"`{c}`").cast("string")).alias(c) if kinds[c] == "boolean" else F.col(f"`{c}`").cast("string").alias(c) if kinds[c] == "void" else F.col(f"`{c}`") for c in df.columns))
    parts = path.with_name(f".{path.name}-{uuid.uuid4().hex}")
    text.write.options(header=True, escape='"', emptyValue="").csv(storage.uri(parts))
    files = sorted(f for f in parts.glob("part-*") if f.stat().st_size)
    if path.is_dir():
        shutil.rmtree(path)
    if sum(f.stat().st_size for f in files) > SMALL:
        path.unlink(missing_ok=True)
        parts.rename(path)
        return path
    with path.open("w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerow(df.columns)
        for f in files:
            with f.open(newline="") as part:
                next(csv.reader(part))  # the header; what follows is taken over as it is
                shutil.copyfileobj(part, out)
    shutil.rmtree(parts)
    return path


def timing_summary(attempts: DataFrame, wall_seconds: float = 0.0) -> DataFrame:
    """By debug level and row count: ranges, outcomes, simulator and total times. The median is exact, without a task that
    holds a whole group."""
    s, groups = F.col("simulator_seconds"), ("debug_level", "row_count")
    sums = attempts.groupBy(*groups).agg(
        F.count("*").alias("total_ranges"), F.count_if(F.col("status") == "done").alias("completed"), F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum(F.col("resumed").cast("bigint")).alias("resumed"), F.avg(s).alias("mean_simulator_seconds"), F.max(s).alias("max_simulator_seconds"),
        F.sum("duration_seconds").alias("total_duration_seconds"), F.sum("input_write_seconds").alias("total_input_write_seconds"), F.lit(wall_seconds).alias("wall_time_seconds"),
    )
    middle = R.median(attempts, "simulator_seconds", *groups).select(F.col("debug_level").alias("__level"), F.col("row_count").alias("__rows"), F.col("simulator_seconds").alias("median_simulator_seconds"))
    both = sums.join(middle, F.col("debug_level").eqNullSafe(F.col("__level")) & F.col("row_count").eqNullSafe(F.col("__rows")), "left")
    order = ["debug_level", "row_count", "total_ranges", "completed", "failed", "resumed", "mean_simulator_seconds", "median_simulator_seconds", "max_simulator_seconds", "total_duration_seconds", "total_input_write_seconds", "wall_time_seconds"]
    return both.select(*order).orderBy(F.col("debug_level").asc_nulls_first(), "row_count")


def catalog_rows(attempts: DataFrame, rows: DataFrame, prefix: str, step: int, extra: dict[str, Column] | None = None) -> DataFrame:
    """The rows of each attempt's range, led by the attempt's columns under a prefix; `extra` adds columns,
    constants or expressions over an attempt."""
    extra = extra or {}
    heads = attempts.select("row_start", "row_end", *(F.col(c).alias(f"{prefix}_{c}") for c in PREFIXED), *(v.alias(f"{prefix}_{k}") for k, v in extra.items()))
    names = [*(f"{prefix}_{c}" for c in PREFIXED), *(f"{prefix}_{k}" for k in extra)]
    joined = R.rows_in(heads, rows.withColumnRenamed("input_row", f"{prefix}_input_row"), step, f"{prefix}_input_row")
    own = [c for c in rows.columns if c != "input_row"]
    return joined.select(*names, f"{prefix}_input_row", *(F.col(f"`{c}`") for c in own)).orderBy(f"{prefix}_input_row")


def failed_ranges(attempts: DataFrame, rows: DataFrame, step: int, names: dict[str, str]) -> DataFrame:
    """Rows of failed ranges, led by the range's columns under the names given."""
    heads = attempts.where("status = 'failed'").select("row_start", "row_end", *(F.col(c).alias(n) for c, n in names.items()))
    joined = R.rows_in(heads, rows, step)
    return joined.orderBy("input_row").select(*names.values(), *(F.col(f"`{c}`") for c in rows.columns if c != "input_row"))


def write_failures(folder: Path, attempts: DataFrame, rows: DataFrame, step: int) -> None:
    write_csv(I.in_order(attempts.where("status = 'failed'")), folder / "failures.csv")
    write_csv(failed_ranges(attempts, rows, step, {"chunk": "chunk", "row_start": "chunk_row_start", "row_end": "chunk_row_end", "error": "chunk_error"}), folder / "failed_catalog_rows.csv")


def write_debug(folder: Path, attempts: DataFrame, rows: DataFrame, step: int) -> None:
    write_csv(attempts.withColumn("subchunk", F.col("chunk")).orderBy("parent_chunk", "subchunk"), folder / "subchunk_debug_report.csv")
    names = {"parent_chunk": "parent_chunk", "chunk": "subchunk", "row_start": "subchunk_row_start", "row_end": "subchunk_row_end", "error": "subchunk_error"}
    write_csv(failed_ranges(attempts, rows, step, names), folder / "failed_subchunk_catalog_rows.csv")


def write_isolation(folder: Path, attempts: DataFrame, rows: DataFrame, step: int, wall_seconds: float) -> None:
    group, kind = I.group_failures(attempts), {"failure_type": F.lit(I.GROUP_FAILURE)}
    write_csv(I.in_order(attempts), folder / "isolation_report.csv")
    write_csv(catalog_rows(I.failing_rows(attempts), rows, "failure", step), folder / "failing_rows.csv")
    write_csv(I.in_order(group).withColumns(kind), folder / "group_failures.csv")
    write_csv(catalog_rows(group, rows, "group_failure", step, kind), folder / "group_failure_catalog_rows.csv")
    write_csv(timing_summary(attempts, wall_seconds), folder / "debug_timing_summary.csv")
