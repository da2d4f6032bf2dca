"""What the operators share: tables in the shared folder, size checks, row keys."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

_own: dict[str, str] = {}
_open: list[list] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a session that
    is one process uses a temporary folder until it ends; on a cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or _own.get("at")
    if not at:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="skyledger-")
        atexit.register(shutil.rmtree, folder, True)
        at = _own["at"] = f"file://{folder}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(at)
    at = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", at).rstrip("/")


def fresh(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of what runs within when that has ended. The setting is put back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def materialize(df: DataFrame, what: str, *facts: Column) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends here, and the rows
    outlive any executor. The number of rows, and more aggregates of them if asked for (facts), are
    noted while they are written, see rows() and noted(). What was shuffled for it is deleted at once, as
    nothing reads that again."""
    at, seen = fresh(df.sparkSession, what), Observation()
    with _cleaned(df.sparkSession):
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *facts).write.parquet(at)
    trim()  # the driver's Python may just have let go of a model or a set of bits
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out._skyledger_path, out._skyledger_facts = at, seen.get
    for tables in _open:
        tables.append(out)
    return out


class Scratch:
    """Removes, when it is left, the tables made by materialize() meanwhile, but for those to keep. What is
    still to be computed must read kept tables only."""

    def __enter__(self) -> Scratch:
        self.made: list[DataFrame] = []
        self.kept: set[str] = set()
        _open.append(self.made)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(df._skyledger_path)
        return df

    def __exit__(self, kind, *_: object) -> None:
        _open[:] = [x for x in _open if x is not self.made]
        if kind is None:
            for df in self.made:
                if df._skyledger_path not in self.kept:
                    remove(df)


def remove(df: DataFrame) -> None:
    """Deletes a table made by materialize() that nothing reads any more."""
    at = getattr(df, "_skyledger_path", None)
    if at:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def noted(df: DataFrame) -> dict:
    """The facts that materialize() noted of a table; `rows` is always among them."""
    return df._skyledger_facts


def rows(df: DataFrame) -> int:
    return noted(df)["rows"]


def small(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A table of numbers made by materialize(), marked for broadcast if it has at most `most` rows; beyond, the join shuffles."""
    return F.broadcast(df) if rows(df) <= most else df


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: str | Column, parts: int, part: int) -> Column:
    """crc32(doc_id as text) mod parts = part; false for a null id, which has no text to hash."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % parts == part, F.lit(False))


def drawn(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """df's rows of the first `most` distinct values of the keys, in the order of a hash of these, one row for each, with that
    hash as `place`. Equal rows count as one, so at most `most` rows are left however many repeat, and none only if df is empty."""
    placed = df.withColumn("place", F.xxhash64(*keys))
    last = placed.select("place").distinct().orderBy("place").limit(most).agg(F.max("place")).first()[0]
    return placed.where(F.col("place") <= F.lit(last)).dropDuplicates(["place"])


def cut(text: str | Column, ranges: str | Column) -> Column:
    """A text without the character ranges [start, end) of a flat, ascending array start, end, start, end, .."""
    text, ranges = (F.col(x) if isinstance(x, str) else x for x in (text, ranges))
    steps = F.filter(F.sequence(F.lit(0), F.size(ranges)), lambda k: k % 2 == 0)
    begin = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.get(ranges, k - 1)).cast("int")
    pieces = F.transform(steps, lambda k: F.substring(text, begin(k) + 1, (F.coalesce(F.get(ranges, k), F.char_length(text).cast("long")) - begin(k)).cast("int")))
    return F.when(F.size(ranges) > 0, F.array_join(pieces, "")).otherwise(text)


def islands(df: DataFrame, key: str, start: str, end: str, touching: bool, *others: str) -> DataFrame:
    """key and ranges: of df's ranges [start, end) of each key, those that overlap (or, if asked for, touch) as one, in
    ascending order. A range is a struct start, end and the other columns, of which the first two are the start
    and end on another scale."""
    order = Window.partitionBy(key).orderBy(start, end)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col(start) > reached if touching else F.col(start) >= reached, F.lit(True))
    numbered = df.withColumn("fresh", fresh).withColumn("island", F.sum(F.col("fresh").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = [F.min(start).alias(start), F.max(end).alias(end), *(f(c).alias(c) for f, c in zip((F.min, F.max), others, strict=False))]
    whole = numbered.groupBy(key, "island").agg(*ends)
    return whole.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(start, end, *others))).alias("ranges"))


def carried(df: DataFrame, *needed: str) -> DataFrame:
    """Only the columns an operator reads; missing ones are an error that names them."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*(F.col(f"`{c}`") for c in needed))


def renamed(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with all but the needed columns under names of its own, so that no working column clashes with them,
    and what gives such a table the columns of df again."""
    carried(df, *needed)
    own = [c if c in needed else f"own_{k}" for k, c in enumerate(df.columns)]
    return df.toDF(*own), lambda out: out.select(*(F.col(o).alias(c) for o, c in zip(own, df.columns, strict=True)))


def dealt(df: DataFrame, parts: int, column: str = "shard") -> DataFrame:
    """df with the rows of shard k (an int below parts) in partition k."""
    return df.repartitionById(parts, F.col(column))


def trim() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


BATCH_BYTES = 4 << 20


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gets batches of at most BATCH_BYTES and gives freed memory back to
    the system when a task ends: workers are used again, and what one task needed shouldn't add to the
    next one's."""
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped
