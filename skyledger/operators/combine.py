"""Chunk outputs combined by name into sorted Parquet, and published under a visible name."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources import catalog as C
from skyledger.sources import storage

#: Columns that an output's object id and time may have, in order of preference.
ID_COLUMNS = ["ObjID", "objectId", "objectID", "ssObjectId", "ssObjectID", "Principal_desig", "Provisional_packed_desig", "Designation_and_name"]
TIME_COLUMNS = ["fieldMJD_TAI", "midPointTai", "observationStartMJD_TAI", "observationStartMJD", "observationMidpointMJD_TAI", "MJD_TDB", "MJD", "fieldJD_TDB"]
SORT_COLUMN = "fieldMJD_TAI"
#: One schema for chunk and combined data: times are numbers, all else is text.
OUTPUT_SCHEMA = {c: "double" for c in TIME_COLUMNS}


def first_present(columns: Iterable[str], candidates: Iterable[str]) -> str:
    """The column that is first among the candidates, whatever its case; or empty."""
    by_name = {c.lower(): c for c in reversed(list(columns))}
    return next((by_name[c.lower()] for c in candidates if c.lower() in by_name), "")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; absent columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def time_order(df: DataFrame) -> list[Column]:
    """What df is sorted by: time, nulls and nan last, then object id; nothing without a time column."""
    if SORT_COLUMN not in df.columns:
        return []
    key = F.col(f"`{SORT_COLUMN}`")
    missing = key.isNull() | (F.isnan(key) if dict(df.dtypes)[SORT_COLUMN] in ("double", "float") else F.lit(False))
    own = first_present(df.columns, ID_COLUMNS)
    return [missing, key, *([F.col(f"`{own}`").isNull(), F.col(f"`{own}`")] if own else [])]


def in_time_order(df: DataFrame) -> DataFrame:
    """Sorted by time, nulls and nan last, ties by object id; unsorted without a time column."""
    order = time_order(df)
    return df.orderBy(*order) if order else df


def combine(spark: SparkSession, paths: Iterable[str | Path], output: str | Path, one_file: bool = False) -> DataFrame | None:
    """Writes the union of output files as Parquet (a folder); None, and nothing written, if all are empty."""
    df = C.read_outputs(spark, paths, OUTPUT_SCHEMA)
    if df is None:
        return None
    clustered, at = in_time_order(df), storage.uri(output)
    (clustered.coalesce(1) if one_file else clustered).write.mode("overwrite").parquet(at)
    if SORT_COLUMN in df.columns:
        note_files(spark, at)
    return spark.read.schema(df.schema).parquet(at)


FILES = "name string, first double, last double, rows long"


def note_files(spark: SparkSession, output: str) -> None:
    """Writes, beside the files of a combined output, the range of times in each. Readers that don't know it skip a
    folder of that name."""
    held = spark.read.parquet(output).groupBy(F.col("_metadata.file_name").alias("name"))
    held.agg(F.min(SORT_COLUMN).alias("first"), F.max(F.when(~F.isnan(SORT_COLUMN), F.col(SORT_COLUMN))).alias("last"), F.count(F.lit(1)).alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{output}/_files")


def between(spark: SparkSession, output: str | Path, low: float, high: float) -> DataFrame:
    """Rows of a combined output with times from low to below high. Files are clustered by time, so only those whose
    range meets that are opened; of outputs without noted ranges, all."""
    at, wanted = storage.uri(output), (F.col(SORT_COLUMN) >= low) & (F.col(SORT_COLUMN) < high)
    if "_files" not in storage.listed(spark, at):
        return spark.read.parquet(at).where(wanted)
    names = spark.read.schema(FILES).parquet(f"{at}/_files").where((F.col("first") < high) & (F.col("last") >= low)).select("name").collect()
    whole = spark.read.parquet(at)
    return spark.read.schema(whole.schema).parquet(*(f"{at}/{r['name']}" for r in names)).where(wanted) if names else whole.where(F.lit(False))


def combine_csv(paths: Iterable[str | Path], output: str | Path) -> int:
    """Joins CSV files under the first one's header, line by line; missing and empty files are skipped.
    The number of files taken."""
    n = 0
    Path(output).parent.mkdir(parents=True, exist_ok=True)
    with Path(output).open("wb") as out:
        for path in map(Path, paths):
            if not path.exists() or not path.stat().st_size:
                continue
            with path.open("rb") as f:
                header = f.readline()
                if not n:
                    out.write(header.rstrip(b"\r\n") + b"\n")
                for line in f:
                    out.write(line if line.endswith(b"\n") else line + b"\n")
            n += 1
    return n


def _files(path: Path) -> dict[str, Path]:
    return {str(p.relative_to(path)): p for p in path.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))} if path.is_dir() else {"": path}


def publish(source: str | Path, visible: str | Path) -> str:
    """Shows a file or folder under another name by hard links, or copies where links can't be made:
    missing, already_visible, conflict (something else has the name), linked or copied."""
    source, visible = Path(source), Path(visible)
    if not source.exists():
        return "missing"
    own = _files(source)
    if visible.exists():
        there = _files(visible)
        same = own.keys() == there.keys() and all(own[k].samefile(there[k]) for k in own)
        return "already_visible" if same else "conflict"
    status = "linked"
    for name, path in own.items():
        target = visible / name if name else visible
        target.parent.mkdir(parents=True, exist_ok=True)
        try:
            os.link(path, target)
        except OSError:
            shutil.copy2(path, target)
            status = "copied"
    return status
