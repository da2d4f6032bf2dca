"""Approximate nearest neighbours by multi-index hashing over learned binary codes.

A rotation learned on a bounded sample (the first SAMPLE distinct rows by a hash of id and vector; principal directions, then alternating sign and Procrustes
steps) turns each vector into a code of 64 bits. Codes are split into 8 substrings, and each block of
rows indexes all its rows by every substring. A code within Hamming radius r = 8 p + a of a query's
is within p of it in one of the first a + 1 substrings or within p - 1 in one of the others, so probing
the substring values at those distances retrieves every code in the radius. Those within it are
ranked by exact inner products of the original vectors, in double precision. r is the distance that
covers COVER of the true neighbours inside the sample, where neighbours are farther than in the whole
table. A query with fewer than k rows in a block's radius takes the block's k nearest codes instead.

For largest inner products, rows get one more component that gives all of them the greatest length;
queries get 0 there. Queries are broadcast in groups of QUERY_BYTES at most, one group after another, each against
all rows where they lie: rows are not shuffled, a task returns k rows a query, and these are cut to k in
two levels. A group's result is written to the shared folder and its broadcast destroyed before the next one.

Scores add products component by component, so equal vectors have equal scores wherever they lie.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do those of another length than the commonest (the shorter, on a tie), nor rows without a
vec_id. Rows that repeat a vec_id are candidates one by one, but none with the query's own vec_id; a
repeated query id is searched once, by its first vector in array order. Equal scores go by smaller
vec_id. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

K = 20
BITS, PARTS = 64, 8
SAMPLE = 4096
COVER = 0.985
BLOCK = 16_384
#: Bytes of query vectors that are broadcast at once, and groups of a query's partial results.
QUERY_BYTES = 32 << 20
LEVELS = 32
ROUNDS = 30
_ONES = np.array([bin(v).count("1") for v in range(256)])


@dataclass
class Coder:
    """Codes of vectors of d components; `longest` is the greatest length of any row."""

    rotation: np.ndarray
    longest: float
    radius: int

    def codes(self, x: np.ndarray, rows: bool) -> np.ndarray:
        """8 bytes for each vector, of a row of the table or of a query."""
        size = (x * x).sum(1)
        extra = np.sqrt(np.maximum(self.longest**2 - size, 0)) if rows else np.zeros(len(x))
        return np.packbits(np.column_stack([x, extra]) @ self.rotation > 0, axis=1)


def fit(sample: np.ndarray, longest: float, k: int = K, cover: float = COVER, seed: int = 3) -> Coder:
    """Learns the rotation and the radius from a sample of rows (n x d, double)."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([sample, np.sqrt(np.maximum(longest**2 - (sample * sample).sum(1), 0))])
    d = x.shape[1]
    axes = np.linalg.svd(x.T @ x)[0][:, :BITS] if d >= BITS else rng.normal(size=(d, BITS)) / np.sqrt(BITS)
    y = x @ axes
    turn = np.linalg.qr(rng.normal(size=(BITS, BITS)))[0]
    for _ in range(ROUNDS):
        u, _, v = np.linalg.svd(np.where(y @ turn > 0, 1.0, -1.0).T @ y)
        turn = (u @ v).T
    coder = Coder(axes @ turn, longest, BITS)
    asked = rng.choice(len(x), min(len(x), 512), replace=False)
    score = sample[asked] @ sample.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-score, axis=1)[:, : max(1, min(k, len(x) - 1))]
    rows, queries = coder.codes(sample, True), coder.codes(sample[asked], False)
    apart = _ONES[queries[:, None, :] ^ rows[near]].sum(2)
    coder.radius = int(np.ceil(np.quantile(apart, cover)))
    return coder


class Index:
    """Every row of a block, by the value of each substring of its code."""

    def __init__(self, coder: Coder, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.coder = ids, x, coder
        self.codes = coder.codes(x, True)
        self.whole = np.ascontiguousarray(self.codes).view(np.uint64).ravel()
        self.order = [np.argsort(self.codes[:, j], kind="stable") for j in range(PARTS)]
        self.begin = [np.searchsorted(self.codes[self.order[j], j], np.arange(257)) for j in range(PARTS)]
        whole, extra = divmod(coder.radius, PARTS)
        self.reach = [whole if j <= extra else whole - 1 for j in range(PARTS)]

    def within(self, code: np.ndarray) -> np.ndarray:
        """Rows whose code is within the radius: probe each substring, then count differing bits."""
        marked = np.zeros(len(self.ids), bool)
        for j in range(PARTS):
            for v in np.flatnonzero(_ONES[np.arange(256) ^ code[j]] <= self.reach[j]):
                a, b = self.begin[j][v], self.begin[j][v + 1]
                if b > a:
                    marked[self.order[j][a:b]] = True
        rows = np.flatnonzero(marked)
        return rows[np.bitwise_count(self.whole[rows] ^ code.view(np.uint64)) <= self.coder.radius]

    def search(self, own: int, q: np.ndarray, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of the block, but for those of the query's own id."""
        rows = self.within(code)
        rows = rows[self.ids[rows] != own]
        if len(rows) < k:
            rest = np.flatnonzero(self.ids != own)
            apart = np.bitwise_count(self.whole[rest] ^ code.view(np.uint64)).astype(np.int64)
            rows = rest[np.argsort(apart, kind="stable")[:k]]
        rough = self.x[rows] @ q
        if len(rows) > 4 * k:  # only what surely isn't among the best goes by the quick product
            slack = 1e-9 * (1 + self.coder.longest * float(np.sqrt(q @ q)))
            keep = rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack
            rows = rows[keep]
        return best(self.ids[rows], scores(self.x[rows], q), k)


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows x with q, added in the order of components: the same for equal rows, in any block."""
    out = np.zeros(len(x))
    for column, value in zip(x.T, q, strict=True):
        out += column * value
    return out


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _matrix(column) -> np.ndarray:
    return np.asarray(pc.list_flatten(column), np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and embedding (array<double>) of the rows that take part, and their number of components."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    limit = F.lit(float("inf"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)) & F.exists("embedding", lambda x: x != 0)
    v = v.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    sizes = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 0
    return v.where(F.size("embedding") == d), d


def search(vectors: DataFrame, asked: Column, k: int = K, sample: int = SAMPLE, cover: float = COVER) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows of each row for which `asked` holds."""
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    rows, d = usable(vectors)
    stats = rows.agg(F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))), F.count("*")).first()
    if not stats[1]:
        return spark.createDataFrame([], schema)
    taken = shared.drawn(rows, sample, "vec_id", "embedding").orderBy("place").select("embedding").toArrow()
    coder = fit(_matrix(taken.column(0).combine_chunks()), float(stats[0]), k, cover)
    queries = shared.materialize(rows.where(asked).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    groups = -(-shared.rows(queries) * d * 8 * 4 // (QUERY_BYTES * 3)) or 1
    found = []
    for g in range(groups):
        own = queries.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)) == g).toArrow()
        if own.num_rows:
            found.append(_pass(rows, coder, np.asarray(own.column(0).combine_chunks(), np.int64), _matrix(own.column(1).combine_chunks()), k))
    shared.remove(queries)
    if not found:
        return spark.createDataFrame([], schema)
    top = reduce(DataFrame.unionByName, found)
    each = top.select("query_id", F.posexplode("near").alias("at", "one"))
    return each.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.away")).alias("score"))


def _cut(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best of each group: near, an array of (away, vec_id)."""
    one = F.struct((-F.col("score")).alias("away"), "vec_id")
    return found.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(one)), 1, k).alias("near"))


def _pass(rows: DataFrame, coder: Coder, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """query_id, near (its k best, in order) of one group of queries, as a table."""
    sent = rows.sparkSession.sparkContext.broadcast((coder, ids, q, coder.codes(q, False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, ids, q, codes = sent.value
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> None:
            index = Index(coder, *(np.concatenate(x) for x in zip(*waiting, strict=True)))
            for i in range(len(ids)):
                near = index.search(ids[i], q[i], codes[i], k)
                held[i] = best(*(np.concatenate(x) for x in zip(held[i], near, strict=True)), k) if i in held else near

        for batch in batches:
            waiting.append((np.asarray(batch.column(0), np.int64), _matrix(batch.column(1))))
            if sum(len(w[0]) for w in waiting) >= BLOCK:
                block()
                waiting = []
        if waiting:
            block()
        part = TaskContext.get().partitionId() % LEVELS
        for a in range(0, len(ids), 1024):
            some = [held[i] for i in range(a, min(a + 1024, len(ids))) if i in held]
            if some:
                size = [len(s[0]) for s in some]
                yield pa.record_batch([pa.array(np.full(sum(size), part), pa.int32()), pa.array(np.repeat(ids[a : a + len(some)], size)), pa.array(np.concatenate([s[0] for s in some])), pa.array(np.concatenate([s[1] for s in some]))], ["part", "query_id", "vec_id", "score"])

    given = rows.mapInArrow(shared.lean(run), "part int, query_id long, vec_id long, score double")
    parts = _cut(given, k, "query_id", "part").select("query_id", F.explode("near").alias("one"))
    out = shared.materialize(_cut(parts.select("query_id", "one.vec_id", (-F.col("one.away")).alias("score")), k, "query_id"), "near")
    sent.destroy()
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(shared.read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
