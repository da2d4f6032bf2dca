"""Pointings that arrive as files, as an increment: each one is taken up once, by a streaming checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.operators.relational import since
from skyledger.sources.sqlite import stream_sqlite


def take_up(spark: SparkSession, folder: str, schema: StructType | str, checkpoint: str, use: Callable[[DataFrame, int], None]) -> None:
    """Hands all files that no earlier call has seen to `use` (frame, batch number), then stops. A batch
    that fails is handed over again under its number by the next call."""
    stream = spark.readStream.schema(schema).parquet(folder)
    stream.writeStream.foreachBatch(use).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def take_up_into(spark: SparkSession, folder: str, schema: StructType | str, checkpoint: str, table: str, time: str, watermark: object) -> None:
    """Adds new pointings later than the watermark to a Parquet table, one folder for each batch number, so
    that a repeated batch replaces itself."""

    def put(batch: DataFrame, number: int) -> None:
        since(batch, time, watermark).write.mode("overwrite").parquet(f"{table}/batch={number}")

    take_up(spark, folder, schema, checkpoint, put)


def windowed_counts(events: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts in tumbling windows of a stream, with a bound on lateness."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def once(events: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """A stream without repeats of a key that come within the bound on lateness; what is known of a key is let go after that."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, time: str, gap: str, *keys: str) -> DataFrame:
    """Runs of a key's events of which each is at most `gap` after the one before, of a stream with a watermark (or of a table): start, the time
    at which the gap ends the session, and how many events it has. A session is given once the watermark has passed its end."""
    found = events.groupBy(F.session_window(time, gap).alias("__session"), *keys).agg(F.count(F.lit(1)).alias("n_events"))
    return found.select(*keys, F.col("__session.start").alias("session_start"), F.col("__session.end").alias("session_end"), "n_events")


def into(stream: DataFrame, checkpoint: str, table: str) -> None:
    """Adds all there is of a stream to a Parquet table, each row once, then stops."""
    stream.writeStream.outputMode("append").format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def take_up_rows(spark: SparkSession, database: str, checkpoint: str, table: str, source: str = "observations", offset: str | None = None, check: Callable[[DataFrame, int], None] | None = None) -> None:
    """Adds all rows of a SQLite table that no earlier call has delivered to a Parquet table, in the order of their insertion: rows that come
    late, with times below the watermark of a cycle, too. `check` may look at a batch first; if it fails, the next call delivers the
    same batch again."""

    def put(batch: DataFrame, number: int) -> None:
        if check:
            check(batch, number)
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    writer = stream_sqlite(spark, database, source, offset=offset).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    while True:  # a run is one batch, which may be that of a failed call
        query = writer.start()
        query.awaitTermination()
        if not any(p.numInputRows for p in query.recentProgress):
            return
