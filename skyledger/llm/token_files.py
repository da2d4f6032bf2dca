"""Token-id output: Arrow files of equal-length sequences and masks, with random access without copies.

Documents are dealt by ranges of doc_id, so shard k holds no greater ids than shard k + 1. Rows of one id, however
many, are dealt on by a hash of their texts and their places. A shard is
one Arrow file whose record batches have `ids` and `mask` as fixed-size lists, and one Arrow file of
its documents (doc_id, start within the shard, n_tokens). The last sequence of a shard is padded,
and its mask tells. Files are written into the shared folder under a name that belongs to one task
attempt, and only those named by the attempt that succeeded are read, so lost executors and retried
tasks leave no mixture.

Defined results: a null or empty text is a document of the end id alone, and a very long one lies in one shard.
Null doc_ids come first; rows of equal doc_ids are documents of their own, in the order of their texts' hashes.
An empty table gives no shard and no rows; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe, shared

SEQUENCE = 2048
BATCH = 256
SHARD_BYTES = 24 << 20
END = 1


class LibraryBPE(bpe.BPE):
    """Texts split into words as in bpe; each distinct word is encoded by the tokenizers library, once."""

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.kit = Tokenizer.from_file(path)
        self.kit.normalizer = normalizers.Sequence([])
        self.kit.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.kit.encode_special_tokens = True
        self.kit.no_padding()
        self.kit.no_truncation()
        self.closes = np.asarray(pc.ends_with(self.tokens, "</w>"))

    def learn(self, data, starts, lengths):
        raw = data.tobytes()
        texts = [raw[s : s + n].decode() for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
        joined = [" ".join(texts[k : k + 256]) for k in range(0, len(texts), 256)]
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.kit.encode_batch_fast(joined, add_special_tokens=False)])
        return ids, np.diff(np.r_[0, np.flatnonzero(self.closes[ids]) + 1])


@lru_cache(2)
def load(name: str) -> LibraryBPE:
    return LibraryBPE(bpe.find(name))


def _target(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def write_sequences(path: str, ids: np.ndarray, length: int = SEQUENCE, batch: int = BATCH) -> None:
    """ids as fixed-size lists of `length`; the last one is padded with 0 and masked."""
    store, at = _target(path)
    kind = pa.from_numpy_dtype(ids.dtype)
    schema = pa.schema([("ids", pa.list_(pa.field("item", kind, False), length)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))], {"n_ids": str(len(ids))})
    with store.open_output_stream(at) as sink, pa.ipc.new_file(sink, schema) as out:
        for k in range(0, len(ids), length * batch):
            part = ids[k : k + length * batch]
            pad = -len(part) % length
            mask = np.r_[np.ones(len(part), bool), np.zeros(pad, bool)]
            part = np.r_[part, np.zeros(pad, ids.dtype)] if pad else part
            out.write(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((part, mask), schema, strict=True)], schema=schema))


class SequenceFile:
    """Random access to a file of sequences: local files are mapped, nothing is copied until asked for."""

    def __init__(self, path: str):
        store, at = _target(path)
        self.source = pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)
        self.reader = pa.ipc.open_file(self.source)
        self.n_ids = int(self.reader.schema.metadata[b"n_ids"])
        self.length = self.reader.schema.field("ids").type.list_size
        self.per_batch = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1

    def __len__(self) -> int:
        return -(-self.n_ids // self.length)

    def __getitem__(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Sequence k, a view of the file, and its mask."""
        b = self.reader.get_batch(k // self.per_batch)
        r = k % self.per_batch
        return b.column(0).values.to_numpy()[r * self.length : (r + 1) * self.length], b.column(1).values[r * self.length : (r + 1) * self.length]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """n ids from `start`; a view where they lie in one batch."""
        size, parts = self.per_batch * self.length, []
        while n > 0:
            a = start % size
            m = min(n, size - a)
            parts.append(self.reader.get_batch(start // size).column(0).values.to_numpy()[a : a + m])
            start, n = start + m, n - m
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)

    def close(self) -> None:
        self.source.close()


def write(docs: DataFrame, folder: str, tokenizer: str = bpe.TOKENIZER, end: int = END, length: int = SEQUENCE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encodes and writes all documents under `folder` (a URI that all executors reach).

    Returns one row per shard: shard, ids_path, docs_path, n_docs, n_ids, start (ids before it).
    The rows are written next to the files, so that nothing is encoded again when they are read.
    """
    docs = shared.carried(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    total = docs.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    placed = docs.select("doc_id", "text", F.xxhash64("text").alias("order"), F.monotonically_increasing_id().alias("place"))
    keys = ("doc_id", "order", "place")
    dealt = placed.repartitionByRange(max(1, -(-total // shard_bytes)), *keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kit, ids, keys, sizes = load(tokenizer), [], [], []
        kind = np.uint16 if len(kit.tokens) <= 1 << 16 else np.uint32
        for batch in batches:
            keys.append(batch.column(0))
            for a, b, got, at in bpe.chunks(kit, batch.column(1)):
                ids.append(np.insert(got.astype(kind), at[1:], end))
                sizes.append(np.diff(at) + 1)
        if not keys:
            return
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}"
        flat, size = np.concatenate(ids), np.concatenate(sizes)
        write_sequences(f"{name}.arrow", flat, length)
        index = pa.table({"doc_id": pa.chunked_array(keys), "start": np.cumsum(size) - size, "n_tokens": size})
        store, at = _target(f"{name}.docs.arrow")
        with store.open_output_stream(at) as sink, pa.ipc.new_file(sink, index.schema) as out:
            out.write_table(index)
        yield pa.record_batch([pa.array([x]) for x in (shard, f"{name}.arrow", f"{name}.docs.arrow", len(size), len(flat))], ["shard", "ids_path", "docs_path", "n_docs", "n_ids"])

    store, at = _target(folder)
    store.create_dir(at, recursive=True)
    shards = shared.materialize(dealt.mapInArrow(shared.lean(run), "shard long, ids_path string, docs_path string, n_docs long, n_ids long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = SequenceFile(row["ids_path"])
                store, at = _target(row["docs_path"])
                with store.open_input_file(at) as source:
                    for part in pa.ipc.open_file(source).read_all().combine_chunks().to_batches(1024):
                        begin, size = (np.asarray(part.column(c)) for c in (1, 2))
                        ids = file.tokens(int(begin[0]), int(size.sum())).astype("<u4")
                        offsets = np.r_[0, np.cumsum(size)] * 4
                        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                        yield pa.record_batch([part.column(0), pa.array(begin + row["start"]), part.column(2), packed.cast(pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
                file.close()

    ranked = shards.withColumn("at", (F.row_number().over(Window.orderBy("shard")) - 1).cast("int"))  # one row per shard; a task reads one
    given = shared.dealt(ranked, max(1, shards.count()), "at").drop("at")
    return given.mapInArrow(shared.lean(run), "doc_id long, start long, n_tokens long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = write(shared.read(spark, sf_dir, "documents"), shared.fresh(spark, "token-files"))
    return read(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
