"""Filters, change detection and work routing over catalogs and pointings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import values as V

STATUSES = ("new", "updated", "unchanged")


def arc_long_enough(years: Column, length: Column, days: float = V.LONG_ARC_DAYS) -> Column:
    """Arc years (a text) are given, or the arc length (a variant) is a range of years or at least so many days."""
    text = V.text_of(length)
    spelled = F.when(V.is_text(length), V.first_number(text)).otherwise(V.lenient_double(text))
    span = ~V.missing(text) & V.bare(text).rlike(r"^[0-9]{4}\s*-\s*[0-9]{4}$")
    return ~V.missing(years) | F.coalesce(span, F.lit(False)) | F.coalesce(~V.missing(text) & (spelled >= days), F.lit(False))


def worth_keeping(distance: Column, code: Column, long_arc: Column, distant: float = V.DISTANT_AU, certain: float = V.CERTAIN_CODE) -> Column:
    """Distant, or well determined, or observed for long; what is missing (null, not nan) doesn't speak for an object."""
    return F.coalesce(distance > distant, F.lit(False)) | F.coalesce(code <= certain, F.lit(False)) | F.coalesce(long_arc, F.lit(False))


def keep_objects(catalog: DataFrame, comets: bool = False, obj: str = "obj") -> DataFrame:
    """The objects that are worth simulating; comets all are."""
    if comets:
        return catalog
    known, f = V.typed(catalog, obj, ["a", "U", "Arc_years"], ["Arc_length"]), "__fields"
    long_arc = arc_long_enough(F.col(f"{f}.Arc_years"), F.col(f"{f}.Arc_length"))
    return known.where(worth_keeping(V.lenient_double(F.col(f"{f}.a")), V.lenient_double(F.col(f"{f}.U")), long_arc)).drop(f)


def drop_ignored(objects: DataFrame, ignored: DataFrame, *columns: str) -> DataFrame:
    """objects without those whose id, in any of the columns (object_id), is ignored; null ids stay."""
    ids = ignored.select(F.col("object_id").cast("string").alias("__ignored")).where("__ignored is not null").distinct()
    for c in columns or ("object_id",):
        objects = objects.join(ids, F.col(f"`{c}`").cast("string") == F.col("__ignored"), "left_anti")
    return objects


def identified(catalog: DataFrame, obj: str = "obj", fields: list[str] = V.ELEMENT_FIELDS) -> DataFrame:
    """catalog with object_id and element_hash."""
    return catalog.withColumns({"object_id": V.object_id(obj), "element_hash": V.element_hash(obj, fields)})


def diff(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """current (object_id, element_hash, ..) with status new, updated or unchanged against the baseline
    (object_id, element_hash; unique). A null id is always new; repeated ids each get a status."""
    base = baseline.select(F.col("object_id").alias("__id"), F.col("element_hash").alias("__hash"), F.lit(True).alias("__known"))
    status = F.when(F.col("__known").isNull(), "new").when(~F.col("__hash").eqNullSafe(F.col("element_hash")), "updated").otherwise("unchanged")
    return current.join(base, F.col("object_id") == F.col("__id"), "left").withColumn("status", status).drop("__id", "__hash", "__known")


def removed(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Baseline ids that the catalog no longer has."""
    return baseline.join(current.select("object_id").distinct(), "object_id", "left_anti")


def last_by(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """For each key the value of its last row; null keys are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, order).alias(value))


def new_baseline(current: DataFrame) -> DataFrame:
    """object_id, element_hash; of repeated ids the last catalog row counts."""
    return last_by(current, "object_id", "element_hash", "catalog_row")


def status_counts(objects: DataFrame, by: str = "status") -> DataFrame:
    return objects.groupBy(by).agg(F.count("*").alias("n"))


def since(pointings: DataFrame, column: str, watermark: object, lookback: float | None = None) -> DataFrame:
    """Pointings strictly later than the watermark, less a lookback for late arrivals; null times are not later."""
    mark = watermark if isinstance(watermark, Column) else F.lit(watermark)
    return pointings.where(F.col(column) > (mark if lookback is None else mark - F.lit(lookback)))


def extent(pointings: DataFrame, column: str, empty: object = 0.0) -> DataFrame:
    """One row: max_value (`empty` if there is none) and n_rows, of one snapshot."""
    return pointings.agg(F.coalesce(F.max(column), F.lit(empty)).alias("max_value"), F.count("*").alias("n_rows"))


def route(objects: DataFrame, pointings: DataFrame, on: tuple[str, str], time: str, watermark: Column) -> DataFrame:
    """Object and pointing pairs of each job: new and updated objects meet all pointings of their key,
    unchanged ones those after the watermark. Two equi-joins, so that the watermark prunes the larger one."""
    left, right = on
    changed = objects.where(F.col("status").isin("new", "updated")).join(pointings, F.col(left) == F.col(right))
    same = objects.where(F.col("status") == "unchanged").join(since(pointings, time, watermark), F.col(left) == F.col(right))
    return changed.unionByName(same).withColumnRenamed("status", "job")


def selected(rows: DataFrame, ids: DataFrame, column: str, id_column: str | None = None) -> DataFrame:
    """rows whose column is among the ids."""
    return rows.join(ids.select(F.col(id_column or column).alias("__id")).distinct(), F.col(column) == F.col("__id"), "left_semi")
