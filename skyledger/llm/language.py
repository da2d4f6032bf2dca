"""Language identification: a byte convolutional network trained in numpy, over fixed-length windows.

Bytes are embedded; filters of several widths slide over each window; the maximum of each filter
over the window feeds a softmax. A document is cut into windows from end to end, and its languages'
probabilities are the means over its windows, weighted by their bytes. Nothing but the text's bytes
enters a prediction.

Training takes at most SAMPLE_ROWS documents a language and SAMPLE_TOTAL in all, chosen by a hash of
doc_id and text among labelled rows that are not held out, and SAMPLE_WINDOWS windows of each; the bounds are
parameters, and prediction covers whole texts. Equal labelled rows count as one. All labels are learnt; only where there are
more labels than SAMPLE_TOTAL, so that a sample can't hold one document of each, the rarest are left out.

Defined results: `und` with score 0 where the text is null or has no letter, and everywhere if there
are no labelled rows to learn from; keep_known() then keeps every document with a letter. A null doc_id is neither
held out nor learnt from. Rows are independent, so repeated rows give repeated results; equal probabilities go to the
first language in order; a very long text is cut into windows from end to end. An empty table gives no rows; extra columns
are ignored by predict() and kept by keep_known(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared, words

LENGTH = 128
WIDTHS = {2: 8, 3: 12, 4: 12}
DIMENSIONS = 6
SAMPLE_ROWS = 1500
SAMPLE_TOTAL = 20_000
SAMPLE_WINDOWS = 4
EPOCHS = 8
BATCH = 256
BLOCK = 512
CHUNK = 1 << 20
PARTS, HELD = 3, 1
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strongest response of each filter in each window, and all responses."""
        n, length = windows.shape
        d, wide = self.embed.shape[1], max(WIDTHS)
        x = self.embed[windows]
        a, b, c = x.strides
        columns = np.lib.stride_tricks.as_strided(x, (n, length - wide + 1, wide * d), (a, b, c)).reshape(-1, wide * d)
        y = (columns @ self.filters).reshape(n, length - wide + 1, -1)
        return y.max(1), y

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for k in range(0, len(windows), BLOCK):
            top, _ = self.pooled(windows[k : k + BLOCK])
            z = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            parts.append(z / z.sum(1, keepdims=True))
        return np.concatenate(parts)


def cut(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (rows of bytes, zero-padded), the bytes in each, and each text's first window (n+1 entries)."""
    size = np.diff(offsets)
    count = np.maximum(1, -(-size // length))
    first = np.r_[0, np.cumsum(count)]
    out = np.zeros(first[-1] * length, np.uint8)
    for k in range(len(size)):
        at = first[k] * length
        out[at : at + size[k]] = data[offsets[k] : offsets[k + 1]]
    filled = np.minimum(length, np.repeat(size, count) - (np.arange(first[-1]) - np.repeat(first[:-1], count)) * length)
    return out.reshape(-1, length), filled, first


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of windows x with labels y; only the place of a filter's maximum learns."""
    top, responses = net.pooled(x)
    place = responses.argmax(1)
    hidden = np.maximum(top + net.bias, 0)
    z = hidden @ net.out + net.out_bias
    z = np.exp(z - z.max(1, keepdims=True))
    z /= z.sum(1, keepdims=True)
    z[np.arange(len(y)), y] -= 1
    z /= len(y)
    back = (z @ net.out.T) * (hidden > 0)
    taken = x[np.arange(len(x))[:, None, None], place[:, :, None] + np.arange(max(WIDTHS))]
    inputs = net.embed[taken].reshape(len(x), len(net.bias), -1)
    out = {"out": hidden.T @ z, "out_bias": z.sum(0), "bias": back.sum(0), "filters": np.einsum("nfk,nf->kf", inputs, back), "embed": np.zeros_like(net.embed)}
    np.add.at(out["embed"], taken.ravel(), (back[:, :, None] * net.filters.T[None]).reshape(-1, net.embed.shape[1]))
    return out


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """Softmax cross-entropy by Adam; each filter learns from the place of its maximum."""
    rng = np.random.default_rng(seed)
    wide, total = max(WIDTHS), sum(WIDTHS.values())
    shape = np.zeros((wide * DIMENSIONS, total), np.float32)
    at = 0
    for width, n in WIDTHS.items():
        shape[: width * DIMENSIONS, at : at + n] = 1
        at += n
    net = Network(languages, rng.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32), (rng.normal(0, 0.3, shape.shape) * shape).astype(np.float32), np.zeros(total, np.float32), rng.normal(0, 0.2, (total, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    names = ["embed", "filters", "bias", "out", "out_bias"]
    first, second = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for k in range(0, len(order), BATCH):
            grad = gradients(net, windows[order[k : k + BATCH]], labels[order[k : k + BATCH]])
            grad["filters"] *= shape
            step += 1
            for name in names:
                first[name] += 0.1 * (grad[name] - first[name])
                second[name] += 0.001 * (grad[name] ** 2 - second[name])
                getattr(net, name)[...] -= rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return net


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, total: int = SAMPLE_TOTAL, windows: int = SAMPLE_WINDOWS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Training windows, their labels, and the languages; bounded by the parameters, the same on every run."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~shared.held_out("doc_id", PARTS, HELD))
    usable = usable.withColumn("place", F.xxhash64("doc_id", "text"))
    counts = {r[0]: r[1] for r in usable.select("lang", "place").distinct().groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(total).collect()}
    if not counts:
        return np.zeros((0, LENGTH), np.uint8), np.zeros(0, np.int64), []
    most = max(1, min(rows, total // len(counts)))
    shares = docs.sparkSession.createDataFrame([(lang, 1.3 * most / n + 30 / n) for lang, n in counts.items()], "lang string, share double")
    chosen = usable.join(F.broadcast(shares), "lang").where((F.shiftrightunsigned("place", 11) / float(1 << 53)) < F.col("share"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(2))
            cuts = []
            for k in range(len(offsets) - 1):
                text, n = data[offsets[k] : offsets[k + 1]], offsets[k + 1] - offsets[k]
                starts = np.unique(np.linspace(0, max(0, n - LENGTH), windows).astype(int))
                cuts.append([np.r_[text[s : s + LENGTH], np.zeros(max(0, LENGTH - n), np.uint8)].tobytes() for s in starts])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cuts, pa.list_(pa.binary()))], ["place", "lang", "cuts"])

    windowed = chosen.select("place", "lang", "text").mapInArrow(shared.lean(take), "place long, lang string, cuts array<binary>")
    found = windowed.dropDuplicates(["place", "lang"]).collect()
    taken = dict.fromkeys(counts, 0)
    languages = sorted({r["lang"] for r in found})
    number = {lang: k for k, lang in enumerate(languages)}
    x, y = [], []
    for r in sorted(found, key=lambda r: (r["place"], r["lang"])):
        if taken[r["lang"]] < most:
            taken[r["lang"]] += 1
            x += map(bytes, r["cuts"])
            y += [number[r["lang"]]] * len(r["cuts"])
    return np.frombuffer(b"".join(x), np.uint8).reshape(-1, LENGTH), np.array(y), languages


def fit(docs: DataFrame, **bounds: int) -> Network | None:
    """A network that knows the languages of the labelled rows; None if there are none."""
    x, y, languages = sample(shared.carried(docs, "doc_id", "text", "lang"), **bounds)
    if not languages:
        return None
    share = np.bincount(y, minlength=len(languages))
    again = np.concatenate([np.resize(np.flatnonzero(y == k), min(share.max(), 4 * share[k])) for k in range(len(languages)) if share[k]])
    return train(x[again], y[again], languages)


def predict(docs: DataFrame, net: Network | None, *keep: str) -> DataFrame:
    """`keep` columns, lang_pred and score of every document row."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kept = [docs.schema[c] for c in keep]
    docs = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text").alias("own_text"), letters.alias("own_letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(len(keep)))
            for a, b in words.slices(offsets, CHUNK):
                x, filled, first = cut(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                weight = np.maximum(filled, 1)
                p = np.add.reduceat(net.probabilities(x).astype(np.float64) * weight[:, None], first[:-1]) / np.add.reduceat(weight, first[:-1])[:, None]
                known = np.asarray(batch.column(len(keep) + 1)[a:b])
                best = p.argmax(1)
                named = [net.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
                score = np.where(known, np.minimum(p.max(1), 1.0), 0.0)
                yield pa.record_batch([*(c[a:b] for c in batch.columns[: len(keep)]), pa.array(named, pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    return docs.mapInArrow(shared.lean(run), StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    found = predict(docs, fit(docs), "doc_id")
    return found.select("doc_id", shared.held_out("doc_id", PARTS, HELD).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """docs without those whose language stays unknown (no letters) or scores below `least`; all columns stay."""
    net = fit(docs)
    if net is None:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    own, restored = shared.renamed(docs, "text")
    found = predict(own, net, *own.columns)
    return restored(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))
