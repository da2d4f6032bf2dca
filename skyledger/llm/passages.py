"""Substring dedup by paragraph MinHash: passages that repeat across documents, wherever they stand.

A passage may be pasted into the middle of a line, so paragraphs are cut by content: a word begins a
paragraph where the hash of it and its successor is least among REACH word pairs on either side. Cuts
depend on nearby words only, so a passage of 50 words has the same inner paragraphs (11 words on
average) in every document. A changed word costs five shingles, more than so short a paragraph can lose, so
each whole line is a paragraph as well.

Identical paragraphs are one item. Paragraphs of LEAST or more words have BANDS MinHash bands of ROWS rows
over their five-word shingles: a pair of Jaccard similarity 0.8 collides with a chance of 0.998 (shorter
paragraphs are only 0.8 similar if equal). Collisions are clustered and verified by exact Jaccard similarity
(clusters.py), and a component is a class.

A class repeats if its paragraphs are in two or more document rows. The row of least doc_id keeps it (null
ids last, ties by the row's place in the input). A run of adjacent repeating paragraphs of RUN or more words is
a passage. What runs of cut paragraphs and of lines cover is counted word by word, so runs of either kind that
meet are one passage, and of a line that goes, cut paragraphs stay that repeat elsewhere and are kept here.

Keys are deduplicated within a task and shuffled as blocks of numbers; only keys that two items share
become rows.

Defined results: a null or wordless text has no paragraphs. Repeated rows are documents of their own, so
all but the first lose their text. Repeats inside one document alone are left. Very long texts are held one
at a time. An empty table gives no rows; extra columns are ignored by find() and kept by remove(), whatever
their names. Paragraphs are told apart by 64-bit hashes.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bits, clusters, shared, words

SHINGLE = 5
SIMILAR = 0.8
REACH = 5
LEAST = 9
RUN = 16
BANDS, ROWS = 6, 2
#: Samples of a paragraph's signature, and how many of them two of 0.8 agree in with a chance above 0.9999.
SAMPLES, AGREE = 32, 16
CHUNK = 2 << 20
SHARD_BYTES = 8 << 20
FLUSH = 500_000
#: Paragraphs whose passages are worked out together.
TOGETHER = 1 << 18
_TOP = np.uint64(2**64 - 1)
#: The place of a null doc_id in the order of ids.
_LAST = np.int64(2**63 - 1)
_ODD = np.random.default_rng(23).integers(1, 2**62, BANDS * ROWS + SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Paragraphs:
    """The paragraphs of a slice of texts: word ranges [begin, end), text of each, and item hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends, self.first = words.spans(data, offsets, words.ALNUM)
        self.h = words.hashes(data, self.starts, self.ends)
        n = len(self.h)
        self.heads = self.first[:-1][np.diff(self.first) > 0]
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._whole = words.windows(self.h, SHINGLE)
        cut = np.zeros(n, bool)
        if n:
            pair = np.full(n, _TOP)
            pair[:-1] = words.mix(self.h[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.h[1:])
            pair[np.r_[self.heads[1:], n] - 1] = _TOP
            # the largest number stands between texts, so that a text's end never hides a cut
            gap = np.zeros(n, np.int64)
            gap[self.heads] = REACH
            at = np.arange(n) + np.cumsum(gap)
            wide = np.full(at[-1] + 1 + REACH, _TOP)
            wide[at] = pair
            low = np.full(len(wide), _TOP)
            after = low.copy()
            for d in range(1, REACH + 1):
                np.minimum(low[d:], wide[:-d], out=low[d:])
                np.minimum(after[:-d], wide[d:], out=after[:-d])
            cut = (pair < low[at]) & (pair <= after[at]) & (pair < _TOP)
            cut[self.heads] = True
        self._divide(cut)

    def lines(self) -> Paragraphs:
        """The same texts, cut at line breaks."""
        out, n = copy.copy(self), len(self.h)
        cut = np.zeros(n, bool)
        if n:
            after = np.searchsorted(self.starts, np.flatnonzero(self.data == 10))
            cut[after[after < n]] = True
            cut[self.heads] = True
        out._divide(cut)
        return out

    def _divide(self, cut: np.ndarray) -> None:
        n = len(cut)
        self.begin = np.flatnonzero(cut)
        self.end = np.r_[self.begin[1:], n] if len(self.begin) else self.begin
        self.text = self.owner[self.begin]
        self.size = self.end - self.begin
        place = (np.arange(n) - np.repeat(self.begin, self.size)).astype(np.uint64)
        self.item = words.mix(np.add.reduceat(words.mix(self.h + place * np.uint64(0xD6E8FEB86659FD93)), self.begin) + self.size.astype(np.uint64)) if n else np.zeros(0, np.uint64)

    def shingles(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingle hashes of some paragraphs of SHINGLE or more words end to end, and where each one's begin."""
        size = self.size[which] - SHINGLE + 1
        return self._whole[words.ragged(self.begin[which], size)], np.cumsum(size) - size

    def characters(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each paragraph in characters of its text."""
        char = np.r_[0, np.cumsum((self.data & 0xC0) != 0x80)]
        base = char[self.offsets[self.text]]
        return char[self.starts[self.begin]] - base, char[self.ends[self.end - 1]] - base


def _minima(shingles: np.ndarray, at: np.ndarray, odd: np.ndarray) -> list[np.ndarray]:
    """For each odd multiplier, the least product of each paragraph's shingle hashes."""
    return [np.minimum.reduceat(shingles * k, at) if len(at) else shingles for k in odd]


def _slices(column) -> Iterator[tuple[int, int, Paragraphs]]:
    data, offsets = words.flat(column)
    for a, b in words.slices(offsets, CHUNK):
        yield a, b, Paragraphs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def paragraphs(docs: DataFrame) -> DataFrame:
    """Of documents (row, doc_id, text): row, doc_id, n_cut, items, starts, ends (characters), sizes (words) of every document row, as a table in the
    shared folder. The first n_cut items are cut by content, the others are lines. Its facts have `bytes`, those of
    all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, p in _slices(batch.column(2)):
                kinds = (p, p.lines())
                order = np.argsort(np.concatenate([x.text for x in kinds]), kind="stable")
                n_cut, n_lines = (np.bincount(x.text, minlength=b - a) for x in kinds)
                at = pa.array(np.r_[0, np.cumsum(n_cut + n_lines)], pa.int32())
                columns = zip(*((x.item.view(np.int64), *(v.astype(np.int32) for v in (*x.characters(), x.size))) for x in kinds), strict=True)
                values = [np.concatenate(v)[order] for v in columns]
                yield pa.record_batch([batch.column(0)[a:b], batch.column(1)[a:b], pa.array(np.diff(p.offsets), pa.int64()), pa.array(n_cut, pa.int32()), *(pa.ListArray.from_arrays(at, pa.array(v)) for v in values)], ["row", "doc_id", "bytes", "n_cut", "items", "starts", "ends", "sizes"])

    docs = docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = docs.mapInArrow(shared.lean(run), "row long, doc_id long, bytes long, n_cut int, items array<long>, starts array<int>, ends array<int>, sizes array<int>")
    return shared.materialize(found, "paragraphs", F.sum("bytes").alias("bytes"))


def _once(*columns: np.ndarray) -> list[np.ndarray]:
    """Distinct tuples in ascending order."""
    order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0])
    columns = [c[order] for c in columns]
    keep = np.ones(len(order), bool)
    if len(order):
        keep[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return [c[keep] for c in columns]


def _sent(kind: int, shards: int, key: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows of ascending key as one block a shard: kind, shard, three columns of bytes."""
    cut = np.searchsorted(((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32), np.arange(shards + 1))
    some = np.flatnonzero(np.diff(cut))
    blocks = [pa.array([x[cut[s] : cut[s + 1]].tobytes() for s in some], pa.binary()) for x in (key, *columns)]
    blocks += [pa.nulls(len(some), pa.binary())] * (3 - len(blocks))
    return pa.record_batch([pa.array([kind] * len(some), pa.int32()), pa.array(some, pa.int32()), *blocks], _BLOCK)


_BLOCK = ["kind", "shard", "a", "b", "c"]
_BLOCKS = "kind int, shard int, a binary, b binary, c binary"


def places(table: DataFrame, shards: int) -> DataFrame:
    """Blocks (a: items, b: first places, c: last places) of all items of the table, in the shared folder. A place
    is a pair of numbers, the document's id and its row."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            item, doc, row = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return _sent(0, shards, *_ends(item, np.stack([doc, row], 1), np.stack([doc, row], 1)))

        for batch in batches:
            count = np.asarray(pc.list_value_length(batch.column(2)), np.int64)
            doc = np.asarray(pc.fill_null(batch.column(1), _LAST))
            held.append((np.asarray(batch.column(2).flatten()).view(np.uint64), np.repeat(doc, count), np.repeat(np.asarray(batch.column(0)), count)))
            if sum(len(h[0]) for h in held) > FLUSH:
                yield flush()
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, own in _grouped(batches):
            item = np.concatenate([np.frombuffer(x, np.uint64) for x in own[0]])
            first, last = (np.concatenate([np.frombuffer(x, np.int64) for x in c]).reshape(-1, 2) for c in own[1:])
            yield pa.record_batch([pa.array([0], pa.int32()), pa.array([shard], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in _ends(item, first, last))], _BLOCK)

    blocks = table.select("row", "doc_id", "items").mapInArrow(shared.lean(emit), _BLOCKS)
    met = shared.dealt(blocks, shards).sortWithinPartitions("shard").mapInArrow(shared.lean(meet), _BLOCKS)
    return shared.materialize(met, "places")


def _ends(item: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct items in ascending order with their first and last places."""
    if not len(item):
        return item, first, last
    order = np.lexsort((first[:, 1], first[:, 0], item))
    item, first, last = item[order], first[order], last[order]
    at = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    group = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(item)]))
    late = np.lexsort((last[:, 1], last[:, 0], group))
    return item[at], first[at], last[late][np.r_[at[1:], len(item)] - 1]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """The blocks of each shard, of rows that come shard by shard."""
    at, held = None, [[], [], []]
    for batch in batches:
        for shard, *blocks in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
            if at is not None and at != shard:
                yield at, held
                held = [[], [], []]
            at = shard
            for h, x in zip(held, blocks, strict=True):
                h.append(x)
    if at is not None:
        yield at, held


def collisions(docs: DataFrame, shards: int) -> DataFrame:
    """(band, item) of the band keys that two or more different items share."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, item = _once(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            return _sent(1, shards, key, item)

        for batch in batches:
            for _, _, p in _slices(batch.column(0)):
                for lines, kind in enumerate((p, p.lines())):
                    long = np.flatnonzero(kind.size >= LEAST)
                    long = long[np.unique(kind.item[long], return_index=True)[1]]
                    low, item = _minima(*kind.shingles(long), _ODD[: BANDS * ROWS]), kind.item[long]
                    for k in range(BANDS):
                        key = np.full(len(long), lines * BANDS + k, np.uint64)  # a line doesn't meet the paragraphs cut from it
                        for row in low[k * ROWS : (k + 1) * ROWS]:
                            key = words.mix(key * np.uint64(0x9E3779B97F4A7C15) + row)
                        held.append((key, item))
                if sum(len(k) for k, _ in held) > FLUSH:
                    yield flush()
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, own in _grouped(batches):
            key, item = _once(*(np.concatenate([np.frombuffer(x, np.uint64) for x in c]) for c in own[:2]))
            more = np.r_[key[1:] == key[:-1], False] if len(key) else np.zeros(0, bool)
            more[1:] |= more[:-1].copy()
            yield pa.record_batch([pa.array(key[more].view(np.int64)), pa.array(item[more].view(np.int64))], ["band", "item"])

    sent = docs.select("text").mapInArrow(shared.lean(emit), _BLOCKS)
    return shared.dealt(sent, shards).sortWithinPartitions("shard").mapInArrow(shared.lean(meet), "band long, item long")


def _shingled(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """item, packed (its distinct shingles), sig of the wanted items: a bit set lets few others through the
    scan, an exact join stops those."""
    sent = bits.of(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in (x for _, _, p in _slices(batch.column(0)) for x in (p, p.lines())):
                item = kind.item.view(np.int64)
                at = np.flatnonzero((kind.size >= LEAST) & bits.maybe(sent.value, item))
                at = at[np.unique(item[at], return_index=True)[1]]
                own, begin = kind.shingles(at)
                packed = [clusters.Jaccard.pack(x := np.unique(s), np.zeros(len(x))) for s in np.split(own, begin[1:])] if len(at) else []
                low = [(x >> np.uint64(56)).astype(np.uint8) for x in (words.mix(m) for m in _minima(own, begin, _ODD[BANDS * ROWS :]))] if len(at) else []
                sig = [x.tobytes() for x in np.stack(low, 1)] if len(at) else []
                yield pa.record_batch([pa.array(item[at]), pa.array(packed, pa.binary()), pa.array(sig, pa.binary())], ["item", "packed", "sig"])

    found = docs.select("text").mapInArrow(shared.lean(run), "item long, packed binary, sig binary")
    once = found.groupBy("item").agg(F.first("packed").alias("packed"), F.min("sig").alias("sig"))
    return shared.materialize(once.join(wanted, "item", "left_semi"), "shingled")


def _placed(blocks: DataFrame, several: bool = False, sent=None) -> DataFrame:
    """item, doc, row (the first place), again (it has another row) of blocks' items: of those in several rows,
    or those that may be in a bit set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                item = np.frombuffer(a, np.int64)
                first, last = (np.frombuffer(x, np.int64).reshape(-1, 2) for x in (b, c))
                again = first[:, 1] != last[:, 1]
                keep = again if several else bits.maybe(sent.value, item)
                yield pa.record_batch([pa.array(x[keep]) for x in (item, first[:, 0], first[:, 1], again)], ["item", "doc", "row", "again"])

    return blocks.select("a", "b", "c").mapInArrow(shared.lean(run), "item long, doc long, row long, again boolean")


def repeating(docs: DataFrame, table: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """item, root, first_row, first_doc of the items whose class is in two or more rows of the table."""
    shards = max(1, -(-(shared.noted(table)["bytes"] or 0) // SHARD_BYTES))
    buckets = clusters.bucketed(shared.materialize(collisions(docs, shards), "collisions"))
    shingled = _shingled(docs, buckets.select("item").distinct())
    labels = clusters.cluster(buckets, shingled, clusters.Jaccard(np.ones(1), similar), AGREE)
    blocks = places(table, shards)
    doc = lambda c: F.nullif(c, F.lit(int(_LAST)))
    alone = _placed(blocks, several=True).select("item", F.col("item").alias("root"), F.col("row").alias("first_row"), doc(F.col("doc")).alias("first_doc"))
    if labels is None:
        return alone
    nodes = labels.withColumnRenamed("node", "item")
    some = shared.materialize(_placed(blocks, sent=bits.of(nodes)).join(nodes, "item"), "classes")
    place = F.struct("doc", "row")
    heads = some.groupBy("root").agg(F.min(place).alias("head"), F.max(place).alias("last"), F.bool_or("again").alias("again"))
    heads = heads.where(F.col("again") | (F.col("head.row") != F.col("last.row")))
    named = some.join(heads.drop("again"), "root").select("item", "root", F.col("head.row").alias("first_row"), doc(F.col("head.doc")).alias("first_doc"))
    return alone.join(nodes, "item", "left_anti").unionByName(named)


_FOUND = ["row", "doc_id", "line", "k", "start", "end", "size", "word"]


def _marked(table: DataFrame, repeated: DataFrame) -> DataFrame:
    """The repeating paragraphs of each row, in order: row, doc_id, line, k (its number in the row), start, end, size,
    word (the place of its first word in the text), root, first_row, first_doc. A bit set leaves out most
    other paragraphs before the exact join."""
    sent = bits.of(repeated)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, start, end, size = (np.asarray(batch.column(c).flatten()) for c in range(3, 7))
            count, n_cut = np.asarray(pc.list_value_length(batch.column(3)), np.int64), np.asarray(batch.column(2), np.int64)
            k = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
            line = k >= np.repeat(n_cut, count)
            word = np.cumsum(size) - size
            head = np.repeat(np.cumsum(count) - count, count) + np.where(line, np.repeat(n_cut, count), 0)
            word = word - word[head] if len(item) else word
            at = np.flatnonzero(bits.maybe(sent.value, item)) if len(item) else np.zeros(0, np.int64)
            owner = pa.array(np.repeat(np.arange(len(count)), count)[at])
            yield pa.record_batch([batch.column(0).take(owner), batch.column(1).take(owner), *(pa.array(x[at]) for x in (line, k, start, end, size, word, item))], [*_FOUND, "item"])

    flat = table.select("row", "doc_id", "n_cut", "items", "starts", "ends", "sizes").mapInArrow(shared.lean(run), "row long, doc_id long, line boolean, k long, start int, end int, size int, word long, item long")
    return flat.join(repeated, "item").select(*_FOUND, "root", "first_row", "first_doc")


def _covered(length: int, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which of so many places lie in any of the ranges."""
    change = np.bincount(begin, minlength=length + 1) - np.bincount(stop, minlength=length + 1)
    return np.cumsum(change[:length]) > 0


def _passages(found: dict[str, np.ndarray], run_words: int) -> list[dict[str, np.ndarray]]:
    """Passages that go and passages that are kept, given whole rows' repeating paragraphs in order. Of each
    passage: at (a paragraph of its row), start, end, n_words, keeper (a paragraph that tells the keeper), and for
    each of its paragraphs its number (own) and index (which). Only whole text that some row keeps may go: of lines
    that go, cut paragraphs stay whose class this row keeps."""
    row, line, size = found["row"], found["line"], found["size"].astype(np.int64)
    kept = found["first_row"] == row
    change = np.r_[True, row[1:] != row[:-1]]
    first = np.flatnonzero(change)
    stop = found["word"] + size
    length = np.maximum.reduceat(stop, first) + 1  # a place between rows, so that no passage leaves its row
    base = np.repeat(np.cumsum(length) - length, np.diff(np.r_[first, len(row)]))
    begin, stop = found["word"] + base, stop + base
    total = int(length.sum())
    new = change.copy()
    new[1:] |= (line[1:] != line[:-1]) | (found["k"][1:] != found["k"][:-1] + 1) | (kept[1:] != kept[:-1])
    at = np.flatnonzero(new)
    long = np.add.reduceat(size, at) >= run_words
    last = np.r_[at[1:], len(row)] - 1
    runs = lambda which: _covered(total, begin[at[long & which]], stop[last[long & which]])
    mine = _covered(total, begin[~line & kept], stop[~line & kept])
    gone = runs(~line[at] & ~kept[at]) | (runs(line[at] & ~kept[at]) & ~mine)
    own_start, own_end = np.full(total + 1, -1), np.full(total + 1, -1)
    own_start[begin], own_end[stop] = found["start"], found["end"]
    starts, ends = np.where(own_start >= 0, own_start, own_end), np.where(own_end >= 0, own_end, own_start)
    out = []
    for state, cover in ((False, gone), (True, runs(kept[at]) & ~gone)):
        edge = np.diff(np.r_[0, cover.view(np.int8), 0])
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        a, b = a[b - a >= run_words], b[b - a >= run_words]
        parts = np.flatnonzero(kept == state)
        low, high = np.searchsorted(b, begin[parts], "right"), np.searchsorted(a, stop[parts], "left")
        n = np.maximum(high - low, 0)
        own, which = words.ragged(low, n), np.repeat(parts, n)
        order = np.lexsort((line[which], begin[which], own))
        own, which = own[order], which[order]
        lead = which[np.searchsorted(own, np.arange(len(a)))] if len(a) else a
        out.append({"at": lead, "start": starts[a], "end": ends[b], "n_words": b - a, "keeper": lead, "own": own, "which": which, "kept": np.full(len(a), state)})
    return out


def _runs(marked: DataFrame, run_words: int) -> DataFrame:
    """One row for each passage: row, doc_id, start, end, n_words, n_paragraphs, kept, keeper_doc_id, classes."""
    names = [*_FOUND, "root", "first_row", "first_doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = dict(zip(names, (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns), strict=True))
            found = {c: np.asarray(columns[c]) for c in names if c not in ("doc_id", "first_doc")}
            for x in _passages(found, run_words) if table.num_rows else []:
                own, root = _once(x["own"], found["root"][x["which"]])
                n = len(x["at"])
                classes = pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(n + 1)), pa.int32()), pa.array(root))
                at = pa.array(x["at"])
                yield pa.record_batch([pa.array(found["row"][x["at"]]), columns["doc_id"].take(at), pa.array(x["start"], pa.int32()), pa.array(x["end"], pa.int32()), pa.array(x["n_words"], pa.int64()), pa.array(np.bincount(x["own"], minlength=n), pa.int64()), pa.array(x["kept"]), columns["first_doc"].take(pa.array(x["keeper"])), classes], ["row", "doc_id", "start", "end", "n_words", "n_paragraphs", "kept", "keeper_doc_id", "classes"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= TOGETHER and batch.column(0)[-1] != held[0].column(0)[0]:
                table = pa.Table.from_batches(held)
                row = np.asarray(table.column(0).combine_chunks())
                cut = int(np.searchsorted(row, row[-1]))  # the last row may go on
                if cut:
                    yield from done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from done(pa.Table.from_batches(held))

    whole = marked.repartition("row").sortWithinPartitions("row", "line", "k")
    return whole.mapInArrow(shared.lean(run), "row long, doc_id long, start int, end int, n_words long, n_paragraphs long, kept boolean, keeper_doc_id long, classes array<long>")


def _found(docs: DataFrame, similar: float, run_words: int) -> DataFrame:
    """See find(), of documents (row, doc_id, text) whose rows are numbered."""
    with shared.Scratch() as scratch:
        table = scratch.keep(paragraphs(docs))
        repeated = scratch.keep(shared.materialize(repeating(docs, table, similar), "repeating"))
    return _runs(_marked(table, repeated), run_words)


def find(docs: DataFrame, similar: float = SIMILAR, run_words: int = RUN) -> DataFrame:
    """One row for each passage of a document that repeats in another: row, doc_id, start, end (characters),
    n_words, n_paragraphs (cut ones and lines), kept (this is the occurrence that stays), keeper_doc_id, classes."""
    docs = shared.carried(docs, "doc_id", "text")
    return _found(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), similar, run_words)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(shared.read(spark, sf_dir, "documents")).select("doc_id", "start", "end", "n_words", "kept", "keeper_doc_id")


def remove(docs: DataFrame, similar: float = SIMILAR, run_words: int = RUN) -> DataFrame:
    """docs with every occurrence but the kept one of each repeating passage cut out of the texts."""
    own, restored = shared.renamed(docs, "doc_id", "text")
    kept = shared.materialize(own.withColumn("row", F.monotonically_increasing_id()), "remove")
    gone = _found(kept.select("row", "doc_id", "text"), similar, run_words).where("not kept")
    spans = F.array_sort(F.collect_list(F.struct("start", "end")))
    ranges = gone.groupBy("row").agg(F.flatten(F.transform(spans, lambda x: F.array(x["start"].cast("long"), x["end"].cast("long")))).alias("ranges"))
    joined = kept.join(ranges, "row", "left")
    return restored(joined.withColumn("text", F.coalesce(shared.cut("text", "ranges"), "text")))
