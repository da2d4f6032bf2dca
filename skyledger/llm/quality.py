"""Quality classification by positive-unlabelled learning.

Trusted positives are documents labelled as good; everything else is unlabelled web text, good and bad.
With the share of good documents (the class prior) known, the risk of a classifier on the bad ones is
its risk on unlabelled text less the good documents' part of that; as the estimate from a sample can't be below zero in
truth, steps that push it there are taken back (non-negative unbiased risk). Labels of bad documents
are never used.

The prior comes from all documents: a first classifier tells positives from unlabelled text, its scores of every
document and of every trusted positive that it wasn't fitted to are counted in bins, and the prior is the least
ratio of the two shares above a score, where the bound on its error is least.

A text's features are the square roots of its bytes' frequencies and of its byte pairs' in hashed buckets, and its shape: classes of
bytes, lengths, repeated words and distinct windows of words. All of the text counts.

Fitting takes at most POSITIVES trusted positives and UNLABELLED unlabelled documents (parameters), chosen by a hash
of doc_id and text among rows that are not held out; equal rows count as one.

Defined results: a null text counts as empty, and empty texts get a score by their features as any other. A null doc_id is neither held
out nor learnt from. Without trusted positives or text to learn from every score is 0.5. Labels that repeat a doc_id make it a
positive if any of them does; null labels don't. Repeated rows get equal scores. Very long texts are read whole, in blocks. An empty
table gives no rows; extra columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from . import shared, words

PARTS, HELD = 5, 0
THRESHOLD = 0.3
POSITIVES, UNLABELLED = 4000, 8000
BUCKETS = 1024
#: Bytes and documents whose features are worked out together.
CHUNK, DOCUMENTS = 1 << 20, 256
WINDOWS = (1, 2, 4)
CLASSES = ("upper", "lower", "digit", "blank", "line", "other", "wide")
SHAPES = 256 + len(CLASSES) + len(WINDOWS) + 5
#: Steps of each loss, how far below zero the risk on bad text may be before a step is taken back, rows of a step of either kind,
#: greatest rate, and decay for each trusted positive.
PHASES = {"logistic": (640, 0.05), "sigmoid": (960, 0.01)}
BATCH, RATE, DECAY = 256, 0.01, 6.0
BINS = 1000
#: Of the bound on the prior's error: weight and chance of being wrong.
WEIGHT, WRONG = 0.01, 0.1

_CLASS = np.full(256, CLASSES.index("other"), np.uint8)
for _name, _first, _last in (("upper", 65, 90), ("lower", 97, 122), ("digit", 48, 57), ("line", 10, 13), ("wide", 128, 255)):
    _CLASS[_first : _last + 1] = CLASSES.index(_name)
_CLASS[[9, 32]] = CLASSES.index("blank")
_CLASSES = np.eye(len(CLASSES))[_CLASS]
_AS_IS = np.arange(256, dtype=np.uint8)


def _shares(found: np.ndarray, of: np.ndarray) -> np.ndarray:
    return found / np.maximum(of, 1)


def _distinct(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many different values each of n documents has."""
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return np.bincount(doc[first], minlength=n)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of features for each text, given as bytes and offsets."""
    n, size = len(offsets) - 1, np.diff(offsets)
    pairs, single = np.zeros(n * BUCKETS), np.zeros(n * 256)
    for a in range(0, len(data), CHUNK):
        block = data[a : a + CHUNK + 1]  # one byte more, for the pair that spans two blocks
        doc = np.searchsorted(offsets, np.arange(a, a + len(block)), "right") - 1
        code = (block[:-1].astype(np.uint32) << np.uint32(8)) | block[1:]
        bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        inside = doc[:-1] == doc[1:]
        pairs += np.bincount((doc[:-1] * BUCKETS + bucket)[inside], minlength=n * BUCKETS)
        own = slice(0, min(CHUNK, len(data) - a))
        single += np.bincount(doc[own] * 256 + block[own], minlength=n * 256)
    pairs, single = pairs.reshape(n, -1), single.reshape(n, -1)
    starts, ends, first = words.spans(data, offsets, words.UNSPACED)
    h, count = words.hashes(data, starts, ends, _AS_IS), np.diff(first)
    doc = np.repeat(np.arange(n), count)
    shape = [np.sqrt(_shares(single, size[:, None])), _shares(single @ _CLASSES, size[:, None])]
    for length in WINDOWS:
        inside = words.within(first, length)
        held = words.windows(h, length)[inside] if length > 1 else h
        shape.append(1 - _shares(_distinct(held, doc[: len(inside)][inside], n), np.bincount(doc[: len(inside)][inside], minlength=n))[:, None])
    again = np.zeros(n) if len(h) < 2 else np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    shape.append(np.stack([_shares(again, count), np.log1p(count), np.log1p(size), np.log1p(_shares(np.bincount(doc, ends - starts, n), count)), count == 0], 1))
    return np.concatenate([np.sqrt(_shares(pairs, pairs.sum(1, keepdims=True))), *shape], 1).astype(np.float32)


@dataclass
class Model:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.middle) / self.spread, -8, 8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.standard(x) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -50, 50)))


def _drawn(rng: np.random.Generator, rows: int, steps: int) -> np.ndarray:
    """Rows of each of so many steps: all in turn, in a new order each time."""
    return np.concatenate([rng.permutation(rows) for _ in range(-(-steps * BATCH // rows))])[: steps * BATCH].reshape(steps, BATCH)


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 11) -> Model:
    """A linear model by Adam. With a prior it minimises the non-negative unbiased risk, first by logistic loss, which has no bad
    minima, then by sigmoid loss, whose bound keeps single rows from deciding; without one it tells positives from unlabelled text
    by logistic loss, both counting half. The weights are means over the second half of the steps."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-3, np.zeros(both.shape[1], np.float32), 0.0)
    p, u, x = model.standard(positive), model.standard(unlabelled), np.zeros(both.shape[1] + 1)

    def risk(rows: np.ndarray, sign: int, kind: str) -> tuple[float, np.ndarray]:
        """Mean loss of calling the rows positive (sign 1) or not (-1), and its gradient."""
        z = sign * (rows @ x[:-1] + x[-1])
        wrong = 1 / (1 + np.exp(np.clip(z, -50, 50)))
        loss, slope = (np.logaddexp(0, -z), -wrong) if kind == "logistic" else (wrong, -wrong * (1 - wrong))
        slope = sign * slope / len(rows)
        return float(loss.mean()), np.r_[rows.T @ slope, slope.sum()]

    for kind, (steps, slack) in PHASES.items():
        if kind != "logistic" and prior is None:
            break
        first, second, total = np.zeros_like(x), np.zeros_like(x), np.zeros_like(x)
        for k, (a, b) in enumerate(zip(_drawn(rng, len(p), steps), _drawn(rng, len(u), steps), strict=True)):
            (_, good), (loss_p, bad_p), (loss_u, bad_u) = risk(p[a], 1, kind), risk(p[a], -1, kind), risk(u[b], -1, kind)
            if prior is None:
                grad = (good + bad_u) / 2
            elif loss_u - prior * loss_p >= -slack:
                grad = prior * good + bad_u - prior * bad_p
            else:  # the risk on bad text is below zero: fitted too far
                grad = prior * bad_p - bad_u
            grad[:-1] += DECAY / len(p) * x[:-1]
            first += 0.1 * (grad - first)
            second += 0.001 * (grad**2 - second)
            x = x - RATE * (1.02 - k / steps) * (first / (1 - 0.9 ** (k + 1))) / (np.sqrt(second / (1 - 0.999 ** (k + 1))) + 1e-8)
            total += x * (k >= steps // 2)
        x = total / (steps - steps // 2)
    model.weights, model.bias = x[:-1].astype(np.float32), float(x[-1])
    return model


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in unlabelled text, from counts of both by rising score: the least ratio of the shares above a score,
    taken where that ratio and the bound on its error are least together."""
    n_p, n_u = positive.sum(), unlabelled.sum()
    if not n_p or not n_u:
        return 0.5
    above_p, above_u = (np.cumsum(c[::-1])[::-1] / c.sum() for c in (positive, unlabelled))
    some = above_p > 0
    slack = (1 + WEIGHT) * (np.sqrt(np.log(4 / WRONG) / 2 / n_u) + np.sqrt(np.log(4 / WRONG) / 2 / n_p))
    bound = (above_u[some] + slack) / above_p[some]
    return float(np.clip((above_u[some] / above_p[some])[bound.argmin()], 0.01, 0.99))


def _arrow(docs: DataFrame, name: str, kind: object, make) -> DataFrame:
    """docs' other columns and make(features) of their last one, a text."""
    keep = docs.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(len(keep)))
            for a, b in words.slices(offsets, CHUNK, DOCUMENTS):
                yield pa.record_batch([*(c[a:b] for c in batch.columns[: len(keep)]), make(features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))], [*keep, name])

    return docs.mapInArrow(shared.lean(run), StructType([*docs.schema.fields[:-1], StructField(name, kind)]))


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """`keep` columns and score of every document row."""
    if model is None:
        return docs.select(*(F.col(f"`{c}`") for c in keep), F.lit(0.5).alias("score"))
    return _arrow(docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").alias("own_text")), "score", DoubleType(), lambda x: pa.array(model.scores(x)))


def _fold(column: str) -> Column:
    return F.xxhash64(column, F.lit("fold")) % 2 != 0


def sample(docs: DataFrame, trusted: DataFrame, positives: int, unlabelled: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of trusted positives, the fold of each, and features of unlabelled documents."""
    place = F.xxhash64("doc_id", "text")
    usable = docs.where(F.col("doc_id").isNotNull() & ~shared.held_out("doc_id", PARTS, HELD)).withColumn("place", place)
    known = usable.select("doc_id", "place").distinct()
    good = known.join(trusted, "doc_id", "left_semi").orderBy(F.xxhash64("place", F.lit("positive")), "doc_id").limit(positives).withColumn("good", F.lit(True))
    some = known.orderBy("place", "doc_id").limit(unlabelled).withColumn("good", F.lit(False))
    chosen = shared.materialize(good.unionByName(some), "quality-sample")
    taken = usable.join(F.broadcast(chosen), ["doc_id", "place"]).select("doc_id", "place", "good", "text").dropDuplicates(["doc_id", "place", "good"])
    rows = taken.select("place", "doc_id", "good", _fold("doc_id").alias("fold"), "text")
    found = _arrow(rows, "features", BinaryType(), lambda x: pa.array([r.tobytes() for r in x], pa.binary())).collect()
    shared.remove(chosen)
    found.sort(key=lambda r: (r["place"], r["doc_id"]))
    matrix = lambda rs: np.frombuffer(b"".join(bytes(r["features"]) for r in rs), np.float32).reshape(-1, BUCKETS + SHAPES)
    p = [r for r in found if r["good"]]
    return matrix(p), np.array([r["fold"] for r in p], bool), matrix([r for r in found if not r["good"]])


def estimate_prior(docs: DataFrame, trusted: DataFrame, model: Model) -> float:
    """From all documents, and all trusted positives of the fold that the model wasn't fitted to."""
    binned = predict(docs, model, "doc_id").select("doc_id", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
    # counts before the join, so that an id of very many rows is a few of them
    counted = binned.groupBy("doc_id", "bin").agg(F.count(F.lit(1)).alias("n")).join(trusted.where(_fold("doc_id")).withColumn("good", F.lit(True)), "doc_id", "left")
    out = np.zeros((2, BINS))
    for bin_, good, n in counted.groupBy("bin", F.col("good").isNotNull().alias("good")).agg(F.sum("n")).collect():
        out[0, bin_] += n
        out[1, bin_] += n * good
    return prior_of(out[1], out[0])


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """A model from documents (doc_id, text) and labels (doc_id, quality); None if there is nothing to learn from."""
    docs = shared.carried(docs, "doc_id", "text")
    trusted = shared.carried(labels, "doc_id", "quality").where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~shared.held_out("doc_id", PARTS, HELD)).select("doc_id").distinct()
    p, fold, u = sample(docs, trusted, positives, unlabelled)
    if not len(p) or not len(u):
        return None
    fitted = p[~fold] if 0 < fold.sum() < len(fold) else p
    return train(p, u, estimate_prior(docs, trusted, train(fitted, u, None)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = predict(docs, fit(docs, shared.read(spark, sf_dir, "labels")), "doc_id")
    return found.select("doc_id", shared.held_out("doc_id", PARTS, HELD).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
