"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A text's shingles are its runs of five words (all its words together, if fewer), words being lower-cased
runs of ASCII letters and digits and non-ASCII characters. A shingle's weight is its count in the text
times an inverse document frequency, 1 for a shingle that all texts hold and 1 + SPREAD for one that a RARE share of
them or fewer hold, rounded to sixteenths on a logarithmic scale. Frequencies are shares, so weights are alike at
every size of corpus. They cover all documents: a count-min sketch, summed over tasks as blocks of
counters, whose width follows the mean length of a text. Its error, which only raises a share, is a small part of
RARE, and only the sketch of texts of that mean length is broadcast, however many texts there are.

Each of 63 samples draws, for a shingle and its weight, Ioffe's (r, c, beta) from a pool indexed by a
hash of the shingle, so that a table gives ln a for any weight step; the least wins. Two texts agree in a
sample with a chance of their weighted Jaccard similarity. 21 bands of 3 samples find pairs of 0.8
with a chance above 0.9999, of 0.67 above 0.999.

Identical texts are one item, found by hash. Colliding items are clustered (clusters.py); a pair is a
link if its exact weighted Jaccard similarity is 0.8 or more.

Defined results: a null or wordless text is a class of its own. Repeated rows are in one class. Within
a class the row of least doc_id is kept, null ids last, ties by the row's place in the input. Very long texts are
sampled one at a time, as a whole. An empty table gives no rows; extra columns are ignored by classes() and kept by
keep_one(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bits, clusters, shared, words

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 21, 3
SAMPLES = BANDS * ROWS
#: Of SAMPLES bytes, so many agree for a pair of 0.8 with a chance above 0.9999.
AGREE = 36
CHUNK, DOCUMENTS = 2 << 20, 1 << 13
#: The share of texts below which a shingle is as rare as any, and how much more it weighs than one of all texts.
RARE, SPREAD = 1 / 256, 0.5
DEPTH = 2
#: Counters a row for each shingle of a mean text over RARE, and the least number of them.
ROOM, LEAST_WIDTH = 4, 1 << 16
SEGMENT = 1 << 16
STEPS = 16
LEVELS = 256
POOL = 1 << 14
_ODD = np.random.default_rng(11).integers(1, 2**62, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of at most DOCUMENTS texts, text by text: the text's index, 50-bit ids in
    ascending order, and counts."""
    starts, ends, first = words.spans(data, offsets, words.ALNUM)
    h = words.hashes(data, starts, ends)
    n = np.diff(first)
    keys = []
    for k in range(1, size):
        text = np.flatnonzero(n == k)
        if len(text):
            own = h[words.ragged(first[text], np.full(len(text), k))]
            keys.append(text.astype(np.uint64) << np.uint64(50) | words.windows(own, k)[::k] >> np.uint64(14))
    ok = np.flatnonzero(words.within(first, size))
    if len(ok):
        text = np.searchsorted(first, ok, "right") - 1
        keys.append(text.astype(np.uint64) << np.uint64(50) | words.windows(h, size)[ok] >> np.uint64(14))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.sort(np.concatenate(keys))
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return (key[at] >> np.uint64(50)).astype(np.int64), key[at] & np.uint64((1 << 50) - 1), np.diff(np.r_[at, len(key)])


def _bins(ids: np.ndarray, width: int) -> list[np.ndarray]:
    return [((ids * np.uint64(m) >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def sketch_width(texts: int, total_bytes: int) -> int:
    """Counters a row: by the words of a mean text (of some 4 bytes at least), not by how many texts there are."""
    mean = total_bytes / 4 / max(1, texts)
    return max(LEAST_WIDTH, -(-int(ROOM * mean / RARE) // SEGMENT) * SEGMENT)


def document_frequencies(docs: DataFrame, width: int = 1 << 20) -> np.ndarray:
    """The count-min sketch (DEPTH x width) of the number of documents that hold each shingle."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.zeros((DEPTH, width), np.int64)
        for batch in batches:
            data, offsets = words.flat(batch.column(0))
            for a, b in words.slices(offsets, CHUNK, DOCUMENTS):
                _, ids, _ = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                for row, at in zip(table, _bins(ids, width), strict=True):
                    row += np.bincount(at, minlength=width)
        yield _blocks(table.ravel(), TaskContext.get().partitionId() % 32)

    sums = docs.select("text").mapInArrow(shared.lean(tally), "block int, salt int, width int, counts binary")
    for key in (("block", "salt"), ("block",)):
        sums = sums.repartition(*key).sortWithinPartitions(*key).mapInArrow(_add(len(key)), "block int, salt int, width int, counts binary")
    table = np.zeros(DEPTH * width, np.int64)
    for r in sums.toLocalIterator():
        table[r["block"] * SEGMENT : (r["block"] + 1) * SEGMENT] += np.frombuffer(bytes(r["counts"]), f"<u{r['width']}").astype(np.int64)
    return table.reshape(DEPTH, width)


def _blocks(table: np.ndarray, salt: int, first: int = 0) -> pa.RecordBatch:
    """Blocks of counters, each in the narrowest type that holds them."""
    rows = []
    for k in range(0, len(table), SEGMENT):
        part = table[k : k + SEGMENT]
        width = next(w for w in (1, 2, 4, 8) if part.max(initial=0) < 256**w)
        rows.append((first + k // SEGMENT, salt, width, part.astype(f"<u{width}").tobytes()))
    return pa.record_batch([*(pa.array([r[k] for r in rows], pa.int32()) for k in range(3)), pa.array([r[3] for r in rows], pa.binary())], ["block", "salt", "width", "counts"])


def _add(keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for block, salt, width, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = (block, salt)[:keys]
                if at is not None and at != key:
                    yield _blocks(total, (*at, 0)[1], at[0])
                    total = None
                at, own = key, np.frombuffer(counts, f"<u{width}").astype(np.int64)
                total = own if total is None else total + own
        if at is not None:
            yield _blocks(total, (*at, 0)[1], at[0])

    return run


class Sampler:
    """Weights and consistent samples, given the sketch of document frequencies and their total."""

    def __init__(self, frequencies: np.ndarray, documents: int):
        share = frequencies / max(1, documents)
        #: ln of the inverse document frequency, in STEPS, of every counter
        rarity = np.clip(-np.log(np.clip(share, RARE, 1)) / -np.log(RARE), 0, 1)
        self.idf = (np.log1p(SPREAD * rarity) * STEPS).astype(np.float16)
        self.weights = np.exp(np.arange(LEVELS) / STEPS)

    def levels(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The weight step of each shingle: ln(tf idf) in quarters."""
        rarest = np.maximum(*(row[at] for row, at in zip(self.idf, _bins(ids, self.idf.shape[1]), strict=True))).astype(np.float64)
        return np.minimum(np.rint(np.log(counts) * STEPS + rarest), LEVELS - 1).astype(np.int64)

    def table(self) -> np.ndarray:
        """For each weight step and pool entry, ln a in an order-preserving 32-bit form."""
        if not hasattr(self, "_table"):
            rng = np.random.default_rng(5)
            r, c = (rng.gamma(2, 1, POOL) for _ in range(2))
            beta = rng.uniform(size=POOL)
            rows = []
            for level in range(LEVELS):
                y = r * (np.floor(level / STEPS / r + beta) - beta)
                rows.append((np.log(c) - y - r + 256).astype(np.float32).view(np.uint32))
            self._table = np.concatenate(rows)
        return self._table

    def sketch(self, text: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts that have shingles, and their samples (one row a text)."""
        first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]]) if len(text) else np.zeros(0, np.int64)
        base, table = (self.levels(ids, counts) * POOL).astype(np.int64), self.table()
        low = (ids ^ (ids >> np.uint64(18))) & np.uint64(0xFFFFFFFF)
        out = np.empty((len(first), SAMPLES), np.uint64)
        for k in range(SAMPLES if len(first) else 0):
            at = base + ((ids * _ODD[k]) >> np.uint64(50)).astype(np.int64)
            out[:, k] = np.minimum.reduceat(table[at].astype(np.uint64) << np.uint64(32) | low, first)
        return text[first], out


def bands(samples: np.ndarray) -> np.ndarray:
    out = np.empty((len(samples), BANDS), np.uint64)
    for j in range(BANDS):
        key = np.full(len(samples), j + 1, np.uint64)
        for k in range(j * ROWS, (j + 1) * ROWS):
            key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, k])
        out[:, j] = key
    return out.view(np.int64)


def _sketched(docs: DataFrame, sampler: Sampler) -> DataFrame:
    """row, doc_id, item (hash of the text; null if it has no words), bands, sig (a byte of each sample) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(sampler)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(3))
            for a, b in words.slices(offsets, CHUNK, DOCUMENTS):
                text, samples = sent.value.sketch(*shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                size = np.zeros(b - a, np.int64)
                size[text] = 1
                keys = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)] * BANDS, pa.int32()), pa.array(bands(samples).ravel()))
                sig = [None] * (b - a)
                for t, row in zip(text, (samples ^ (samples >> np.uint64(32))).astype(np.uint8), strict=True):
                    sig[t] = row.tobytes()
                item = pa.array(np.asarray(batch.column(2)[a:b]), mask=size == 0)
                yield pa.record_batch([batch.column(0)[a:b], batch.column(1)[a:b], item, keys, pa.array(sig, pa.binary())], ["row", "doc_id", "item", "bands", "sig"])

    whole = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("item"), "text")
    return shared.materialize(whole.mapInArrow(shared.lean(run), "row long, doc_id long, item long, bands array<long>, sig binary"), "sketches")


def _packed(docs: DataFrame, wanted: DataFrame, sampler: Sampler) -> DataFrame:
    """item, packed shingles of the wanted items (one column, item): a bit set lets few others through the
    scan, an exact join stops those."""
    texts = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("item"), "text")
    spark, ids = docs.sparkSession, bits.of(wanted)
    sent = spark.sparkContext.broadcast(sampler)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = np.asarray(batch.column(0), np.int64)
            once = np.zeros(len(item), bool)
            once[np.unique(item, return_index=True)[1]] = True
            batch = batch.filter(pa.array(once & bits.maybe(ids.value, item)))
            item = np.asarray(batch.column(0), np.int64)
            data, offsets = words.flat(batch.column(1))
            for a, b in words.slices(offsets, CHUNK, DOCUMENTS):
                text, sh, counts = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                level = sent.value.levels(sh, counts)
                cut = np.searchsorted(text, np.arange(b - a + 1))
                yield pa.record_batch([pa.array(item[a:b]), pa.array([clusters.Jaccard.pack(sh[x:y], level[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["item", "packed"])

    packed = texts.mapInArrow(shared.lean(run), "item long, packed binary")
    once = packed.groupBy("item").agg(F.first("packed").alias("packed"))
    return shared.materialize(once.join(wanted, "item", "left_semi"), "packed")


def _labelled(docs: DataFrame, similar: float) -> DataFrame:
    """row, doc_id, root of every row of docs (row, doc_id, text); rows of one root are one class."""
    n, size = docs.agg(F.count("text"), F.sum(F.octet_length("text"))).first()
    sampler = Sampler(document_frequencies(docs, sketch_width(n, size or 0)), n)
    sketches = _sketched(docs, sampler)
    texts = sketches.where("item is not null").select("item", "bands", "sig")
    distinct = texts.groupBy("item").agg(F.first("bands").alias("bands"))
    buckets = clusters.bucketed(distinct.select(F.explode(F.array_distinct("bands")).alias("band"), "item"))
    packed = _packed(docs, buckets.select("item").distinct(), sampler)
    signed = packed.join(texts.groupBy("item").agg(F.min("sig").alias("sig")), "item")
    labels = clusters.cluster(buckets, signed, clusters.Jaccard(sampler.weights, similar), AGREE)
    rows = sketches.select("row", "doc_id", "item")
    if labels is None:
        return rows.withColumn("root", F.col("item"))
    named = rows.join(labels.withColumnRenamed("node", "item"), "item", "left")
    return named.select("row", "doc_id", "item", F.coalesce("root", "item").alias("root"))


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """row, doc_id, class_id (the class's kept doc_id), class_size, kept of every document row."""
    docs = shared.carried(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    with shared.Scratch() as scratch:
        named = scratch.keep(shared.materialize(_labelled(docs, similar), "labelled"))
    heads = named.where("root is not null").groupBy("root").agg(F.min(_place()).alias("head"), F.count("*").alias("class_size"))
    whole = named.where("root is not null").join(heads, "root").select("row", "doc_id", F.col("head.doc_id").alias("class_id"), "class_size", (F.col("head.row") == F.col("row")).alias("kept"))
    alone = named.where("root is null").select("row", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    return whole.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(shared.read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """docs with one document of each class, all columns."""
    own, restored = shared.renamed(docs, "doc_id", "text")
    with shared.Scratch() as scratch:
        numbered = scratch.keep(shared.materialize(own.withColumn("row", F.monotonically_increasing_id()), "dedup"))
        named = shared.materialize(_labelled(numbered.select("row", "doc_id", "text"), similar).where("root is not null"), "named")
        first = named.groupBy("root").agg(F.min(_place()).alias("head"))
        gone = scratch.keep(shared.materialize(named.join(first, "root").where(F.col("row") != F.col("head.row")).select("row"), "gone"))
    return restored(numbered.join(shared.small(gone), "row", "left_anti"))
