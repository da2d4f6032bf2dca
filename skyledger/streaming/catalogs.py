"""Change detection over a stream of catalog versions: keyed state in place of a baseline table.

Objects are dealt to buckets by their id, and a bucket's state is one block of columns: of each object the hash that it had before the version
at hand, and its last row in that version. A version may come in any number of triggers, and every row is compared with the
version before it. A catalog holds all objects, so each trigger reads and writes each block once, as a whole. A query that is
started again goes on from its checkpoint; each trigger's rows are written under the trigger's number, so one that is repeated replaces itself.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyledger.sources import storage

CATALOG = "version long, catalog_row long, object_id string, element_hash string"
STATUS = f"{CATALOG}, status string"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Buckets of a stream; they stay as they are for the life of a checkpoint.
BUCKETS = 4096
#: Objects of a bucket that buckets_for() aims at: one bucket with its rows is what a task holds in Python.
OBJECTS = 16384
_STATE = pa.schema([("object_id", pa.string()), ("known", pa.bool_()), ("before", pa.string()), ("version", pa.int64()), ("last_row", pa.int64()), ("last", pa.string())])


def buckets_for(objects: int, least: int = 64) -> int:
    """Buckets for a new stream over catalogs of about so many objects, so that a bucket doesn't grow with the catalog."""
    return max(least, -(-objects // OBJECTS))


def _unpacked(block: bytes | None) -> pd.DataFrame:
    table = pa.ipc.open_stream(block).read_all() if block else _STATE.empty_table()
    return table.to_pandas().set_index("object_id")


def _packed(state: pd.DataFrame) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, _STATE) as writer:
        writer.write_table(pa.Table.from_pandas(state.reset_index(), _STATE, preserve_index=False))
    return out.getvalue().to_pybytes()


def compared(state: pd.DataFrame, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The state after rows (version, catalog_row, object_id, element_hash), and the rows with their status. A row of an older version than one
    already seen of its object is compared with what was before the newest version, and changes nothing."""
    out = []
    for version, part in rows.sort_values(["version", "catalog_row"], kind="stable").groupby("version", sort=True):
        own = state.reindex(part["object_id"])
        new = own["version"].isna().to_numpy()
        turned = new | (own["version"].to_numpy() < version)
        known = np.where(turned, ~new, own["known"].to_numpy() == True)  # noqa: E712
        before = np.where(turned, own["last"].to_numpy(), own["before"].to_numpy())
        now = part["element_hash"].to_numpy()
        same = (before == now) | (pd.isna(before) & pd.isna(now))
        out.append(part.assign(status=np.where(~known, "new", np.where(same, "unchanged", "updated"))))
        later = turned | ((own["version"].to_numpy() == version) & (own["last_row"].to_numpy() <= part["catalog_row"].to_numpy()))
        last = pd.DataFrame({"object_id": part["object_id"].to_numpy(), "known": known, "before": before, "version": version, "last_row": part["catalog_row"].to_numpy(), "last": now})[later]
        last = last.drop_duplicates("object_id", keep="last").set_index("object_id")
        state = pd.concat([state[~state.index.isin(last.index)], last]) if len(state) else last
    return state, pd.concat(out)


class Statuses(StatefulProcessor):
    """new, updated or unchanged for the rows of one bucket."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("objects", "block binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.held.get()
        state, out = compared(_unpacked(bytes(held[0]) if held is not None else None), pd.concat(list(rows)).drop(columns="bucket"))
        self.held.update((_packed(state),))
        yield out

    def close(self) -> None:
        pass


def statuses(catalogs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A stream of catalog rows (version, catalog_row, object_id, element_hash) with the status of each. Rows without an id are always
    new; they take no part in the state, so they don't meet in one task."""
    named = catalogs.where("object_id is not null").withColumn("bucket", F.pmod(F.xxhash64("object_id"), F.lit(buckets)))
    known = named.groupBy("bucket").transformWithStateInPandas(Statuses(), STATUS, "append", "None")
    return known.unionByName(catalogs.where("object_id is null").select("*", F.lit("new").alias("status")))


@contextlib.contextmanager
def _rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for queries started within. The setting is put back."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before is not None else spark.conf.unset(_STORE)


def take_up_catalogs(spark: SparkSession, folder: str, checkpoint: str, table: str, files: int | None = None, buckets: int = BUCKETS) -> None:
    """Compares all catalog files (Parquet, CATALOG) of a folder that no earlier call has seen, `files` of them in a trigger if given, and
    adds their statuses to a table, one folder for each trigger; then stops."""
    stream = spark.readStream.schema(CATALOG).option("recursiveFileLookup", True)
    stream = (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(folder)

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    with _rocks(spark):
        statuses(stream, buckets).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def taken(spark: SparkSession, table: str) -> DataFrame:
    """What take_up_catalogs() wrote: the statuses of all triggers."""
    found = storage.listed(spark, table)
    return spark.read.schema(f"{STATUS}, batch int").parquet(table) if found else spark.createDataFrame([], f"{STATUS}, batch int")
