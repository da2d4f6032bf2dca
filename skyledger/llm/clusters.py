"""Clusters of similar items from band collisions: stars first, then what stars leave open.

Buckets (items of one band) may be large, so pairs within a bucket are never all made. First
each bucket's most central item is its leader, every other item is paired with the leader, and the
pairs are verified. Verified links join components; pairs inside one need no look. What is left open, all
pairs of a bucket in different components, is closed in two steps, each block by block, with only such
pairs as rows that join something. First, components with items whose signatures agree in a good part
of their entries make families. Then the items of a family that aren't in its largest component are
compared exactly with all its items. So every pair that shares a band is connected, compared, or of
signatures that two similar sets have with a negligible chance; no size of group is treated otherwise.

Links and labels stay distributed; hot buckets are counted with partial sums, and joins on them are
left to skew handling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, words

BLOCK, BLOCK_SIGNATURES, BLOCK_BYTES = 512, 2048, 8 << 20
COLUMNS = 4096
LINKS = 1 << 20
#: Rows of small groups compared together, their pairs, and the set elements of those.
TOGETHER, PAIRS, ELEMENTS = 1 << 16, 1 << 18, 1 << 20
MOST_ROUNDS = 60


class Jaccard:
    """Whether two packed sets are `similar`, by the Jaccard similarity of their weights. A packed set is its ids
    in ascending order (8 bytes each), then for each its weight step (1 byte)."""

    def __init__(self, weights: np.ndarray, similar: float):
        self.weights, self.similar = np.asarray(weights, np.float64), similar

    @staticmethod
    def pack(ids: np.ndarray, steps: np.ndarray) -> bytes:
        return ids.astype("<u8").tobytes() + steps.astype(np.uint8).tobytes()

    @staticmethod
    def unpack(x: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = len(x) // 9
        return np.frombuffer(x, "<u8", n), np.frombuffer(x, np.uint8, n, n * 8)

    def pair(self, x: bytes, y: bytes) -> bool:
        (ia, sa), (ib, sb) = self.unpack(x), self.unpack(y)
        if not len(ia) or not len(ib):
            return False
        wa, wb = self.weights[sa], self.weights[sb]
        at = np.minimum(np.searchsorted(ib, ia), len(ib) - 1)
        same = ib[at] == ia
        low = np.minimum(wa[same], wb[at[same]]).sum()
        return bool(same.any() and self._enough(low, wa.sum() + wb.sum() - low))

    def pairs(self, packed: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """pair() of the sets numbered x and y, pair by pair."""
        parts = [self.unpack(p) for p in packed]
        size = np.array([len(i) for i, _ in parts], np.int64)
        ids, weight = np.concatenate([i for i, _ in parts]), self.weights[np.concatenate([s for _, s in parts])]
        place, (known, at) = np.cumsum(size) - size, np.unique(ids, return_inverse=True)
        key = np.repeat(np.arange(len(parts)), size) * len(known) + at  # ascending, as each set is
        whole = np.bincount(np.repeat(np.arange(len(parts)), size), weight, len(parts))
        x, y = np.where(size[x] <= size[y], x, y), np.where(size[x] <= size[y], y, x)
        out = np.zeros(len(x), bool)
        for a, b in words.slices(np.r_[0, np.cumsum(size[x])], ELEMENTS):
            one, two, n = x[a:b], y[a:b], size[x[a:b]]
            mine, own = words.ragged(place[one], n), np.repeat(np.arange(b - a), n)
            want = np.repeat(two, n) * len(known) + at[mine]
            found = np.minimum(np.searchsorted(key, want), max(0, len(key) - 1))
            same = key[found] == want
            low = np.bincount(own[same], np.minimum(weight[mine[same]], weight[found[same]]), b - a)
            out[a:b] = self._enough(low, whole[one] + whole[two] - low) & (low > 0)
        return out

    def _enough(self, shared_part, whole):
        return shared_part >= self.similar * whole - 1e-9

    def matrix(self, xs: list[bytes], ys: list[bytes]) -> np.ndarray:
        """pair() of all xs with all ys. The least of two weights is summed over weight steps: a column
        for each id and step that occurs, which a set of that id and a step as high has."""
        sides = []
        for packed in (xs, ys):
            parts = [self.unpack(p) for p in packed]
            size = np.array([len(p[0]) for p in parts])
            sides.append((np.repeat(np.arange(len(parts)), size), np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), size))
        weigh = [np.bincount(o, self.weights[s], len(n)) for o, _, s, n in sides]
        common = np.intersect1d(sides[0][1], sides[1][1])
        low = np.zeros((len(xs), len(ys)))
        for k in range(0, len(common), COLUMNS):
            ids, own = common[k : k + COLUMNS], []
            for owner, i, step, _ in sides:
                at = np.minimum(np.searchsorted(ids, i), len(ids) - 1)
                ok = ids[at] == i
                own.append((owner[ok], at[ok].astype(np.int64), step[ok].astype(np.int64)))
            columns = np.unique(np.concatenate([a * 256 + s for _, a, s in own]))
            first = np.searchsorted(columns, np.arange(len(ids)) * 256)
            value = self.weights[columns % 256]
            value[1:] -= np.where(columns[1:] // 256 == columns[:-1] // 256, self.weights[columns[:-1] % 256], 0)
            dense = []
            for (owner, a, s), n in zip(own, (len(xs), len(ys)), strict=True):
                last = np.searchsorted(columns, a * 256 + s)
                m = np.zeros((n, len(columns)), np.float32)
                m[np.repeat(owner, last - first[a] + 1), words.ragged(first[a], last - first[a] + 1)] = 1
                dense.append(m)
            low += (dense[0] * value.astype(np.float32)) @ dense[1].T
        return self._enough(low * (1 + 1e-6), weigh[0][:, None] + weigh[1][None, :] - low) & (low > 0)


def _forest_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of edges (a, b) that aren't the least of their component, and the least one for each."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    top = np.arange(len(nodes))
    while True:
        low, high = np.minimum(top[x], top[y]), np.maximum(top[x], top[y])
        apart = low < high
        if not apart.any():
            break
        np.minimum.at(top, high[apart], low[apart])
        while True:
            higher = top[top]
            if (higher == top).all():
                break
            top = higher
    below = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[below], nodes[top[below]]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (u, v) that a task holds as stars, LINKS at a time: components stay, paths get short."""
    held: list[pa.RecordBatch] = []

    def done() -> pa.RecordBatch:
        u, v = _forest_of(*(np.concatenate([np.asarray(x.column(k)) for x in held]) for k in (0, 1)))
        held.clear()
        return pa.record_batch([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= LINKS:
            yield done()
    if held:
        yield done()


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of every node in links (a, b): each task makes stars of
    the links it holds, then large and small stars alternate over all of them until nothing changes; each round is a
    table in the shared folder."""
    facts = (F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("digest"),)
    given = links.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = shared.materialize(given.mapInArrow(shared.lean(_contracted), "u long, v long").distinct(), "edges", *facts)
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = shared.materialize(small, "edges", *facts)
        shared.remove(edges)
        if shared.noted(new) == shared.noted(edges):
            return new.select(F.col("u").alias("node"), F.col("v").alias("root")).union(new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = new
    raise RuntimeError("components did not settle")


def _open(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(band, item, weight, root) of buckets that still hold items of several components."""
    if labels is None:
        return buckets.withColumn("root", F.col("item"))
    named = buckets.join(labels.select(F.col("node").alias("item"), F.col("root").alias("r")), "item", "left").select("band", "item", "weight", F.coalesce("r", "item").alias("root"))
    mixed = named.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("band")
    return named.join(mixed, "band", "left_semi")


def bucketed(flat: DataFrame) -> DataFrame:
    """(band, item, weight) of the bands that several items of flat (band, item; distinct) share; an
    item's weight is the sum of its buckets' sizes, and its centrality."""
    sizes = flat.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared_bands = flat.join(sizes, "band")
    weight = shared_bands.groupBy("item").agg(F.sum("n").alias("weight"))
    return shared.materialize(shared_bands.drop("n").join(weight, "item"), "buckets")


def cluster(buckets: DataFrame, packed: DataFrame, measure: Jaccard, agree: int) -> DataFrame | None:
    """node, root of all items with a link among buckets (band, item, weight), given packed (item, packed,
    sig): the packed set, see Jaccard, and a byte for each of its samples, of which `agree` are equal for
    similar sets. None if there are no links."""
    leads = buckets.groupBy("band").agg(F.max(F.struct("weight", F.bitwise_not("item").alias("i"))).alias("m")).select("band", F.bitwise_not("m.i").alias("lead"))
    pairs = buckets.join(leads, "band").where("item <> lead").select(F.least("item", "lead").alias("a"), F.greatest("item", "lead").alias("b")).distinct()
    links = shared.materialize(_verified(pairs, packed, measure), "links")
    labels = shared.materialize(components(links), "labels") if shared.rows(links) else None
    left = shared.materialize(_open(buckets, labels).select("band", "item", "root"), "open")
    kin = shared.materialize(_met(left, packed.select("item", F.col("sig").alias("packed")), Agreement(agree), BLOCK_SIGNATURES), "kin")
    if not shared.rows(kin):
        return labels
    families = components(kin).withColumnRenamed("root", "band").withColumnRenamed("node", "root")
    items = left.select("item", "root").distinct().join(families, "root").select("band", "item", "root")
    found = shared.materialize(_met(items, packed.select("item", "packed"), measure, BLOCK), "links")
    if shared.rows(found):
        labels = shared.materialize(components(links.unionByName(found)), "labels")
    return labels


def _verified(pairs: DataFrame, packed: DataFrame, measure: Jaccard) -> DataFrame:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [measure.pair(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(packed.select(F.col("item").alias("a"), F.col("packed").alias("pa")), "a")
    both = one.join(packed.select(F.col("item").alias("b"), F.col("packed").alias("pb")), "b")
    return both.select("a", "b", "pa", "pb").mapInArrow(shared.lean(compare), "a long, b long")


def _met(left: DataFrame, packed: DataFrame, measure: Jaccard | Agreement, block: int) -> DataFrame:
    """Links (a, b) of roots that join by the measure: of the items of each group `band` outside its largest
    component, in blocks i, and all its items, in blocks j. A block has about `block` items and BLOCK_BYTES
    bytes; a task holds two, or many small groups together."""
    sized = shared.materialize(left.join(packed.select("item", F.octet_length("packed").alias("size")), "item"), "sized")
    by_root = sized.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    sizes = by_root.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("top"), F.max_by(F.struct("n", "bytes"), F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / BLOCK_BYTES)).cast("int")
    sizes = sizes.where(F.col("n") > F.col("most.n")).select("band", "top", blocks(F.col("n"), F.col("bytes")).alias("all"), blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("others"))
    placed = sized.drop("size").join(sizes, "band").withColumn("at", F.xxhash64("item"))
    low = placed.where("root <> top").select("band", F.expr("cast(pmod(at, others) as int)").alias("i"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("j"), F.lit(0).alias("side"), "item", "root")
    high = placed.select("band", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("i"), F.expr("cast(pmod(at, all) as int)").alias("j"), F.lit(1).alias("side"), "item", "root")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: pa.Table) -> pa.RecordBatch:
            u, v = _joined(rows, measure)
            return pa.record_batch([pa.array(u), pa.array(v)], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= TOGETHER or sum(x.nbytes for x in held) >= BLOCK_BYTES:
                rows = pa.Table.from_batches(held)
                cut = int(_groups(rows)[-1])  # the last group may go on
                if cut:
                    yield done(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
        if held:
            yield done(pa.Table.from_batches(held))

    dealt = low.unionByName(high).join(packed, "item").select("band", "i", "j", "side", "root", "packed")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a given number isn't coalesced: rows are few for the work they make
    return dealt.repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j", "side").mapInArrow(shared.lean(compare), "a long, b long").distinct()


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return np.asarray(rows.column(name).combine_chunks())


def _groups(rows: pa.Table) -> np.ndarray:
    """The first row of each group (band, i, j)."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for c in ("band", "i", "j"):
        x = _column(rows, c)
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _joined(rows: pa.Table, measure: Jaccard | Agreement) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the roots that near pairs of low and high rows of a group join."""
    first, root, packed = _groups(rows), _column(rows, "root"), rows.column("packed").to_pylist()
    size = np.diff(np.r_[first, rows.num_rows])
    n_high = np.add.reduceat(_column(rows, "side").astype(np.int64), first) if len(first) else size
    n_low = size - n_high
    links: list[tuple[np.ndarray, np.ndarray]] = []

    def found(x: np.ndarray, y: np.ndarray) -> None:
        links.append(_forest_of(root[x], root[y]))

    large = n_low * n_high > PAIRS
    for g in np.flatnonzero(large):
        a, b, c = first[g], first[g] + n_low[g], first[g] + size[g]
        near = measure.matrix(packed[a:b], packed[b:c]) & (root[a:b, None] != root[None, b:c])
        x, y = np.nonzero(near)
        found(a + x, b + y)
    rest = np.flatnonzero(~large)
    for k, m in words.slices(np.r_[0, np.cumsum((n_low * n_high)[rest])], PAIRS):
        g = rest[k:m]
        x = np.repeat(words.ragged(first[g], n_low[g]), np.repeat(n_high[g], n_low[g]))
        y = words.ragged(np.repeat(first[g] + n_low[g], n_low[g]), np.repeat(n_high[g], n_low[g]))
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        if len(x):
            used, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            near = measure.pairs([packed[i] for i in used], at[: len(x)], at[len(x) :])
            found(x[near], y[near])
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _forest_of(*(np.concatenate(x) for x in zip(*links, strict=True)))


class Agreement:
    """Whether two signatures (bytes of equal length) agree in `agree` places."""

    def __init__(self, agree: int):
        self.agree = agree

    @staticmethod
    def _stacked(packed: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)

    def matrix(self, xs: list[bytes], ys: list[bytes]) -> np.ndarray:
        a, b = self._stacked(xs), self._stacked(ys)
        same = np.zeros((len(a), len(b)), np.uint8)
        for k in range(a.shape[1]):
            same += a[:, k, None] == b[None, :, k]
        return same >= self.agree

    def pairs(self, packed: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        a, same = self._stacked(packed), np.zeros(len(x), np.uint8)
        for column in np.ascontiguousarray(a.T):
            same += column[x] == column[y]
        return same >= self.agree
