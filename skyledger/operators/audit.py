"""Audit of combined outputs against chunk outputs, as multisets of object and time keys."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources import storage

from .combine import ID_COLUMNS, TIME_COLUMNS, first_present

SUMMARY = ["output_name", "combined_path", "source_file_count", "id_column", "timestamp_column", "key_columns", "source_rows", "combined_rows", "source_pairs", "combined_pairs", "missing_pairs", "missing_rows", "status"]
MISSING = ["output_name", "object_id", "timestamp", "id_column", "timestamp_column", "source_count", "combined_count", "missing_count", "catalog_row"]


@dataclass
class Summary:
    output_name: str
    combined_path: str
    source_file_count: int
    id_column: str = ""
    timestamp_column: str = ""
    key_columns: str = ""
    source_rows: int = 0
    combined_rows: int = 0
    source_pairs: int = 0
    combined_pairs: int = 0
    missing_pairs: int = 0
    missing_rows: int = 0
    status: str = "skipped_no_key_columns"

    def row(self) -> dict:
        return asdict(self)


def key_columns(*frames: DataFrame | None) -> tuple[str, str]:
    """Id and time column of the first frame that has an id column."""
    for f in frames:
        if f is not None and (own := first_present(f.columns, ID_COLUMNS)):
            return own, first_present(f.columns, TIME_COLUMNS)
    return "", ""


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and row_count; null keys are a group."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count"))


def compare(source: DataFrame, combined: DataFrame, keys: list[str]) -> DataFrame:
    """keys, source_count and combined_count (0 if absent) of every source key; null keys meet null keys."""
    left = key_counts(source, keys).withColumnRenamed("row_count", "source_count")
    right = key_counts(combined, keys).withColumnRenamed("row_count", "__n")
    right = right.select(*(F.col(k).alias(f"__{i}") for i, k in enumerate(keys)), "__n")
    on = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    joined = left.join(right, on, "left")
    return joined.select(*keys, "source_count", F.coalesce("__n", F.lit(0)).cast("bigint").alias("combined_count"))


def compare_both(source: DataFrame, combined: DataFrame, keys: list[str]) -> DataFrame:
    """keys, source_count and combined_count (0 if absent) of every key of either side, by one grouping of both together; null keys meet null keys."""
    sides = [df.select(*keys, F.lit(k).alias("__side")) for k, df in enumerate((source, combined))]
    return sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.count_if(F.col("__side") == 0).alias("source_count"), F.count_if(F.col("__side") == 1).alias("combined_count"))


def shortfall(source: DataFrame, combined: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that the combined data has fewer rows of than the sources, with missing_count."""
    return compare(source, combined, keys).where("source_count > combined_count").withColumn("missing_count", F.col("source_count") - F.col("combined_count"))


def surplus(source: DataFrame, combined: DataFrame, keys: list[str]) -> DataFrame:
    """The other direction: keys that the combined data has more rows of."""
    return shortfall(combined, source, keys)


def totals(source: DataFrame, combined: DataFrame, keys: list[str]) -> DataFrame:
    """One row: source_rows, combined_rows and combined_pairs (over the sources' keys), source_pairs, missing_pairs, missing_rows."""
    less = F.greatest(F.col("source_count") - F.col("combined_count"), F.lit(0))
    return compare(source, combined, keys).agg(
        F.coalesce(F.sum("source_count"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("combined_count"), F.lit(0)).alias("combined_rows"), F.count("*").alias("source_pairs"),
        F.count_if(F.col("combined_count") > 0).alias("combined_pairs"), F.count_if(less > 0).alias("missing_pairs"), F.coalesce(F.sum(less), F.lit(0)).alias("missing_rows"),
    )


def catalog_lookup(rows: DataFrame, row: str = "catalog_row") -> DataFrame:
    """object_id and catalog_row, by any id column: the first column in order decides, then the first row."""
    columns = [c for c in ID_COLUMNS if c in rows.columns]
    ids = F.explode(F.array(*(F.struct(F.lit(k).alias("rank"), F.col(c).cast("string").alias("object_id")) for k, c in enumerate(columns))))
    each = rows.select(F.col(row), ids.alias("i")).where("i.object_id is not null")
    return each.groupBy(F.col("i.object_id").alias("object_id")).agg(F.min_by(row, F.struct("i.rank", row)).alias(row))


def audit(source: DataFrame | None, combined: DataFrame | None, name: str, path: str, files: int, rows: DataFrame) -> tuple[Summary, DataFrame | None]:
    """The summary of one output, and its missing keys with the catalog rows they belong to."""
    own, time = key_columns(source, combined)
    summary = Summary(name, path, files, own, time, ",".join(filter(None, (own, time))))
    if not own:
        return summary, None
    keys, nothing = [own, *([time] if time else [])], (source if source is not None else combined).limit(0)
    source, combined = (f if f is not None else nothing for f in (source, combined))
    for k in keys:
        source, combined = (f if k in f.columns else f.withColumn(k, F.lit(None)) for f in (source, combined))
    both = storage.written(compare_both(source, combined, keys), "audit")  # the outputs are grouped once
    source_n, combined_n = F.col("source_count"), F.col("combined_count")
    less = F.greatest(source_n - combined_n, F.lit(0))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    summary.source_rows, summary.source_pairs, summary.combined_rows, summary.combined_pairs, summary.missing_pairs, summary.missing_rows = both.agg(
        count(source_n), F.count_if(source_n > 0), count(combined_n), F.count_if(combined_n > 0), F.count_if(less > 0), count(less)
    ).first()
    summary.status = "missing" if summary.missing_pairs else "ok"
    if not summary.missing_pairs:
        return summary, None
    less = both.where(source_n > combined_n).withColumn("missing_count", source_n - combined_n)
    lost = less.select(F.lit(name).alias("output_name"), F.col(own).cast("string").alias("object_id"), (F.col(time).cast("string") if time else F.lit("")).alias("timestamp"), F.lit(own).alias("id_column"), F.lit(time).alias("timestamp_column"), *keys, "source_count", "combined_count", "missing_count")
    return summary, lost.join(catalog_lookup(rows), "object_id", "left").select("output_name", "object_id", *(c for c in lost.columns if c not in ("output_name", "object_id")), "catalog_row")
