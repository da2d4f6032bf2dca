"""Benchmark decontamination: a broadcast set of normalised test n-grams against every training window.

Words are maximal runs of ASCII letters (lower-cased), ASCII digits and non-ASCII characters. An
item of 13 or more words gives every window of 13 consecutive words; a shorter item (but not an
empty one) is one window. Window hashes are looked up in the broadcast set, then each hit is
verified word by word against the item's own bytes, so a hash collision never counts.

The set is built and broadcast as arrays, some 5 bytes for each byte of benchmark text, so MAX_SET_BYTES of text
bound what the driver and each worker hold. A larger benchmark is scanned in blocks of at most that size, one after another:
equal items count once, longer items than half a block are cut into parts that share all but one word of a window, and parts
are packed by size. Only a single window is never cut, so words of many megabytes can exceed the bound.

Defined results: a null or wordless text has n_words = n_hit = n_items = 0 and is clean. A null or
wordless item has no windows; an item without an id makes words hit but is not listed. Repeated
items count once by id. Extra columns are kept, of whatever names; one named like a finding is replaced. An
empty table gives no rows, an empty benchmark leaves all documents clean. Rows with equal or null doc_id each get
their own result. Very long texts are scanned one at a time, as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import shared, words

WINDOW = 13
#: Bytes of benchmark text that one broadcast set may hold; a larger benchmark is scanned in blocks.
MAX_SET_BYTES = 16 << 20
CHUNK = 2 << 20
SCHEMA = "n_words long, items array<string>, hit_words array<long>, hit_chars array<long>"
FOUND = ["n_words", "items", "hit_words", "hit_chars"]


@dataclass
class WindowSet:
    """Distinct windows sorted by hash; window w begins at word `at[w]` of the benchmark's words, and occurs in the
    items (places in `names`) item_of[item_at[w] : item_at[w + 1]]."""

    hash: np.ndarray
    size: np.ndarray
    at: np.ndarray
    item_at: np.ndarray
    item_of: np.ndarray
    names: list[str]
    starts: np.ndarray
    lengths: np.ndarray
    data: np.ndarray
    seen: np.ndarray


def _equal(x: tuple, y: tuple, at: np.ndarray, to: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which windows of `size` words from word `at` of x are the same as those from word `to` of y, each of folded
    bytes, words' starts and lengths."""
    ok = np.ones(len(at), bool)
    for k in range(int(size.max(initial=0))):
        i = np.flatnonzero(ok & (size > k))
        a, b = at[i] + k, to[i] + k
        same = x[2][a] == y[2][b]
        ok[i[~same]] = False
        i, a, b = i[same], a[same], b[same]
        n = x[2][a].astype(np.int64)
        for j, m in words.slices(np.r_[0, np.cumsum(n)], CHUNK):
            left, right = (side[0][words.ragged(side[1][w[j:m]].astype(np.int64), n[j:m])] for side, w in ((x, a), (y, b)))
            bad = np.add.reduceat(left != right, np.cumsum(n[j:m]) - n[j:m]) > 0
            ok[i[j:m][bad]] = False
    return ok


def window_set(ids: list[str | None], texts: pa.Array, window: int = WINDOW) -> WindowSet:
    """The windows of the items' texts, as arrays from end to end."""
    data, offsets = words.flat(texts)
    starts, ends, first = words.spans(data, offsets, words.ALNUM)
    h, data = words.hashes(data, starts, ends), words.FOLD[data]
    starts, lengths = starts.astype(np.int32), (ends - starts).astype(np.int32)
    n = np.diff(first)
    names = sorted({x for x in ids if x is not None})
    place = {x: k for k, x in enumerate(names)}
    own = np.array([place.get(x, -1) for x in ids], np.int32)
    whole = words.windows(h, window)
    at = [np.flatnonzero(words.within(first, window)).astype(np.int32)]
    value = [whole[at[0]]]
    size = [np.full(len(at[0]), window, np.uint8 if window < 256 else np.int32)]
    del whole
    for k in np.unique(n[(n > 0) & (n < window)]):
        at.append(first[:-1][n == k].astype(np.int32))
        value.append(words.windows(h[words.ragged(first[:-1][n == k], n[n == k])], int(k))[::k])
        size.append(np.full(len(at[-1]), k, size[0].dtype))
    at, value, size = np.concatenate(at), np.concatenate(value), np.concatenate(size)
    del h
    order = np.argsort(value, kind="stable")
    at, value, size = at[order], value[order], size[order]
    side, head = (data, starts, lengths), np.arange(len(value), dtype=np.int32)
    left = np.arange(len(value))
    while len(left):  # windows that are the same as the first of their hash; of the others, again
        new = np.r_[True, value[left[1:]] != value[left[:-1]]]
        lead = left[np.flatnonzero(new)[np.cumsum(new) - 1]]
        left, lead = left[~new], lead[~new]
        same = (size[left] == size[lead]) & _equal(side, side, at[left], at[lead], np.minimum(size[left], size[lead]).astype(np.int64))
        head[left[same]] = lead[same]
        left = left[~same]
    item = own[np.searchsorted(first, at, "right") - 1]
    keep = head == np.arange(len(head))
    entry = (np.cumsum(keep) - 1)[head]
    listed = np.unique(entry[item >= 0] * np.int64(max(1, len(names))) + item[item >= 0])
    item_at = np.searchsorted(listed // max(1, len(names)), np.arange(int(keep.sum()) + 1)).astype(np.int32)
    seen = np.zeros(1 << 20, bool)
    seen[value >> np.uint64(44)] = True
    return WindowSet(value[keep], size[keep], at[keep], item_at, (listed % max(1, len(names))).astype(np.int32), names, starts, lengths, data, seen)


def _scan(have: WindowSet, data: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
    """For each document: its words, the items whose windows occur, the hit ranges in words and characters."""
    starts, ends, first = words.spans(data, offsets, words.ALNUM)
    lengths, h = ends - starts, words.hashes(data, starts, ends)
    folded, docs = words.FOLD[data], len(offsets) - 1
    change = np.zeros(len(starts) + 1, np.int64)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for size in np.unique(have.size):
        size = int(size)
        values = words.windows(h, size)
        maybe = np.flatnonzero(have.seen[values >> np.uint64(44)] & words.within(first, size)) if len(values) else np.zeros(0, np.int64)
        lo, hi = (np.searchsorted(have.hash, values[maybe], side) for side in ("left", "right"))
        p, w = np.repeat(maybe, hi - lo), words.ragged(lo, hi - lo)
        ok = have.size[w] == size
        p, w = p[ok], w[ok]
        ok = _equal((folded, starts, lengths), (have.data, have.starts, have.lengths), p, have.at[w], np.full(len(p), size))
        p, w = p[ok], w[ok]
        np.add.at(change, p, 1)
        np.add.at(change, p + size, -1)
        pairs.append((np.searchsorted(first, p, "right") - 1, w))
    out = {"n_words": np.diff(first), "items": [[] for _ in range(docs)], "hit_words": [[] for _ in range(docs)], "hit_chars": [[] for _ in range(docs)]}
    if not any(len(p) for p, _ in pairs):
        return out
    doc, w = (np.concatenate(x) for x in zip(*pairs, strict=True))
    both = np.unique(doc * len(have.hash) + w)
    doc, w = both // len(have.hash), both % len(have.hash)
    n = (have.item_at[w + 1] - have.item_at[w]).astype(np.int64)
    named = np.unique(np.repeat(doc, n) * max(1, len(have.names)) + have.item_of[words.ragged(have.item_at[w].astype(np.int64), n)])
    for k in named:
        out["items"][k // len(have.names)].append(have.names[k % len(have.names)])
    hit = np.cumsum(change[:-1]) > 0
    edge = np.zeros(len(hit) + 1, bool)
    edge[first] = True
    begin = np.flatnonzero(hit & (~np.r_[False, hit[:-1]] | edge[:-1]))
    end = np.flatnonzero(hit & (~np.r_[hit[1:], False] | edge[1:])) + 1
    owner = np.searchsorted(first, begin, "right") - 1
    for d in np.unique(doc):
        a, b = np.searchsorted(owner, (d, d + 1))
        base = int(first[d])
        out["hit_words"][d] = np.stack([begin[a:b] - base, end[a:b] - base], 1).ravel().tolist()
        char = np.r_[0, np.cumsum((data[offsets[d] : offsets[d + 1]] & 0xC0) != 0x80)]
        out["hit_chars"][d] = np.stack([char[starts[begin[a:b]] - offsets[d]], char[ends[end[a:b] - 1] - offsets[d]]], 1).ravel().tolist()
    return out


def _one_pass(docs: DataFrame, items: DataFrame, window: int) -> tuple[DataFrame, Broadcast]:
    """docs with the findings of every row, and the broadcast that they need."""
    rows = items.select("item_id", "text").toArrow()
    sent, names = docs.sparkSession.sparkContext.broadcast(window_set(rows.column(0).to_pylist(), rows.column(1).combine_chunks(), window)), docs.columns
    kinds = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = sent.value
        for batch in batches:
            data, offsets = words.flat(batch.column(names.index("text")))
            for a, b in words.slices(offsets, CHUNK):
                found = _scan(have, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.record_batch([*batch.slice(a, b - a).columns, *(pa.array(found[c], kind) for c, kind in zip(FOUND, kinds, strict=True))], [*names, *FOUND])

    return docs.mapInArrow(shared.lean(scan), StructType([*docs.schema.fields, *StructType.fromDDL(SCHEMA).fields])), sent


def parts(items: DataFrame, window: int, most: int) -> DataFrame:
    """items (item_id, text), those of more than `most` bytes as several rows whose windows are together the item's."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, offsets = words.flat(pa.array([text.as_py()], pa.string()))
                starts, ends, _ = words.spans(data, offsets, words.ALNUM)
                a = 0
                while True:
                    last = int(np.searchsorted(ends, starts[a] + most, "right")) if len(starts) else 0
                    last = min(len(starts), max(last, a + window))  # at least one window
                    ids.append(item)
                    texts.append(data[starts[a] : ends[last - 1]].tobytes().decode() if last else "")
                    if last == len(starts):
                        break
                    a = last - window + 1
            yield pa.record_batch([pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["item_id", "text"])

    large = F.octet_length("text") > most
    return items.where(~large).unionByName(items.where(large).mapInArrow(shared.lean(split), "item_id string, text string"))


def packed(items: DataFrame, window: int, most: int) -> tuple[DataFrame, int]:
    """items (item_id, text, block), and how many blocks there are, from 0 on; a block has at most `most` bytes."""
    half = max(1, most // 2)
    cut = parts(items, window, half).withColumn("bytes", F.octet_length("text").cast("long"))
    total = cut.agg(F.sum("bytes")).first()[0] or 0
    dealt = cut.withColumn("bin", F.pmod(F.xxhash64("item_id", "text"), F.lit(-(-total // half) or 1)))
    before = F.sum("bytes").over(Window.partitionBy("bin").orderBy(F.xxhash64("text", "item_id"), "item_id", "text").rowsBetween(Window.unboundedPreceding, -1))
    groups = shared.materialize(dealt.withColumn("part", (F.coalesce(before, F.lit(0)) / half).cast("long")), "benchmark")
    sizes = groups.groupBy("bin", "part").agg(F.sum("bytes").alias("bytes")).orderBy("bin", "part").collect()  # some three for each block
    blocks, held, at = [], 0, -1
    for r in sizes:
        if at < 0 or held + r["bytes"] > most:
            at, held = at + 1, 0
        held += r["bytes"]
        blocks.append((r["bin"], r["part"], at))
    numbered = items.sparkSession.createDataFrame(blocks, "bin long, part long, block int")
    return groups.join(F.broadcast(numbered), ["bin", "part"]).select("item_id", "text", "block"), at + 1


def _in_blocks(docs: DataFrame, items: DataFrame, window: int, most: int) -> DataFrame:
    """docs with the findings of all blocks of the benchmark, which are broadcast one after another: a block's
    findings are written before the next one is sent."""
    whole = shared.materialize(docs.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    items, blocks = packed(items, window, most)
    passes = []
    for k in range(blocks):
        found, sent = _one_pass(whole.select("row", "text"), items.where(F.col("block") == k), window)
        passes.append(shared.materialize(found.drop("text") if not k else found.where(F.size("hit_words") > 0).drop("text"), "hits"))
        sent.destroy()
    hits = reduce(DataFrame.unionByName, passes)
    pieces = F.transform(F.sequence(F.lit(0), F.expr("size(hit_words) div 2 - 1").cast("int")), lambda k: F.struct(*(F.get(c, 2 * k + j).alias(f"{c}_{j}") for c in ("hit_words", "hit_chars") for j in (0, 1))))
    each = hits.where(F.size("hit_words") > 0).select("row", F.explode(pieces).alias("x")).select("row", "x.*")
    joined = shared.islands(each, "row", "hit_words_0", "hit_words_1", True, "hit_chars_0", "hit_chars_1")
    flat = lambda c: F.flatten(F.transform("ranges", lambda x: F.array(x[f"{c}_0"], x[f"{c}_1"]))).alias(c)
    ranges = joined.select("row", flat("hit_words"), flat("hit_chars"))
    ids = hits.select("row", F.explode("items").alias("item")).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    found = whole.join(passes[0].select("row", "n_words"), "row").join(ranges, "row", "left").join(ids, "row", "left")
    none = lambda c, kind: F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c)
    return found.select(*docs.columns, "n_words", none("items", "string"), none("hit_words", "bigint"), none("hit_chars", "bigint"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_set_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """docs (any columns besides text; of one name, the finding stays) with n_words, items (ids with occurring windows, sorted as text),
    hit_words and hit_chars (flat start, end pairs; ends exclusive), n_hit, n_items, contaminated.

    The benchmark's size, equal items counted once, is measured first. Within max_set_bytes it is broadcast whole; beyond it,
    hash blocks of about that size are broadcast one after another over the same documents and
    the findings of each row are merged, which gives the same rows.
    """
    docs = docs.drop(*FOUND, "n_hit", "n_items", "contaminated")
    names = docs.columns
    own, _ = shared.renamed(docs, "text")
    items = shared.carried(benchmark, "item_id", "text").where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = _one_pass(own, items, window)[0] if total <= max_set_bytes else _in_blocks(own, items, window, max_set_bytes)
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("hit_words") - 1), F.lit(0).cast("long"), lambda s, k: s + F.when(k % 2 == 1, F.get("hit_words", k)).otherwise(-F.get("hit_words", k)))
    found = found.withColumns({"n_hit": F.when(F.size("hit_words") > 0, n_hit).otherwise(F.lit(0).cast("long")), "n_items": F.size("items").cast("long")})
    found = found.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return found.toDF(*names, *FOUND, "n_hit", "n_items", "contaminated")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = scan(docs, shared.read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", window: int = WINDOW) -> DataFrame:
    """docs without contaminated documents, or (mode "spans") all documents with the hit words cut out
    of contaminated ones' texts. Keeps docs' columns; rows never leave their place."""
    if mode not in ("documents", "spans"):
        raise ValueError("mode is documents or spans")
    own = [f"__{k}" for k in range(len(docs.columns))]  # findings can't clash with the columns of docs
    at = docs.columns.index("text")
    found = scan(docs.toDF(*("text" if k == at else c for k, c in enumerate(own))), benchmark, window)
    text = F.col("text")
    if mode == "documents":
        found = found.where(~F.col("contaminated"))
    else:
        text = F.when(F.col("contaminated"), shared.cut("text", "hit_chars")).otherwise(text)
    return found.select(*((text if k == at else F.col(c)).alias(name) for k, (c, name) in enumerate(zip(own, docs.columns, strict=True))))
