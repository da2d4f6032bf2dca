"""Positive-unlabelled quality classification: features against plain Python, the prior, held-out accuracy, edges."""

import collections
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import quality, shared, words

SPACE = " \t\n\v\f\r"


@pytest.fixture
def quick(monkeypatch):
    """Few steps, where it isn't about how well the model is fitted."""
    monkeypatch.setattr(quality, "PHASES", {"logistic": (20, 0.05), "sigmoid": (20, 0.01)})


def slow(text):
    """The features of one text, byte by byte and word by word."""
    data = text.encode()
    pairs = np.zeros(quality.BUCKETS)
    for a, b in zip(data, data[1:]):
        pairs[((a << 8 | b) * 0x9E3779B1 % 2**32) >> (33 - quality.BUCKETS.bit_length())] += 1
    single = np.bincount(list(data), minlength=256) if data else np.zeros(256)
    kinds = collections.Counter("upper" if 65 <= c <= 90 else "lower" if 97 <= c <= 122 else "digit" if 48 <= c <= 57 else "blank" if c in (9, 32) else "line" if 10 <= c <= 13 else "wide" if c >= 128 else "other" for c in data)
    found = "".join(c if c not in SPACE else " " for c in text).split(" ")
    found = [w for w in found if w]
    n, size = max(1, len(found)), max(1, len(data))
    repeated = []
    for k in quality.WINDOWS:
        w = [tuple(found[i : i + k]) for i in range(len(found) - k + 1)]
        repeated.append(1 - len(set(w)) / max(1, len(w)))
    again = sum(a == b for a, b in zip(found, found[1:]))
    mean = sum(len(w.encode()) for w in found) / n
    return np.concatenate([np.sqrt(pairs / max(1, pairs.sum())), np.sqrt(single / size), [kinds[c] / size for c in quality.CLASSES], repeated, [again / n, np.log1p(len(found)), np.log1p(len(data)), np.log1p(mean), not found]])


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_features_equal_plain_python(chunk, monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", chunk)
    texts = ["", " ", "a", "a a a b A9", "Zwei  drei\nzwei drei zwei drei ### ü𝄞 x\x00", "it it is is it is " * 20, "ünï " * 9]
    data, offsets = words.flat(pa.array(texts, pa.string()))
    got = quality.features(data, offsets)
    assert got.shape == (len(texts), quality.BUCKETS + quality.SHAPES)
    np.testing.assert_allclose(got, np.stack([slow(t) for t in texts]), atol=1e-6)


def test_prior_of_a_mixture():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.7, 0.9):
        good, bad = rng.beta(5, 2, 20_000), rng.beta(2, 8, 20_000)
        mixed = np.r_[good[: int(20_000 * share)], bad[int(20_000 * share) :]]
        p, u = (np.bincount(np.minimum((x * quality.BINS).astype(int), quality.BINS - 1), minlength=quality.BINS) for x in (rng.beta(5, 2, 20_000), mixed))
        assert abs(quality.prior_of(p, u) - share) < 0.05
    assert quality.prior_of(np.zeros(quality.BINS), np.ones(quality.BINS)) == 0.5


def prose(rng):
    return " ".join(rng.choice(["the", "river", "of", "stone", "and", "light", "falls", "over", "green", "hills"]) + str(rng.randrange(30)) for _ in range(40))


def corpus(n, seed=5):
    """Documents of which a fifth is bad, and labels of half of them."""
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        good = rng.random() < 0.8
        docs.append((k, prose(rng) if good else rng.choice([prose(rng).upper() + "!!", "buy now " * 30, prose(rng).replace(" ", " | ")])))
        if rng.random() < 0.5:
            labels.append((k, int(good)))
    return docs, labels


def test_held_out_accuracy_without_bad_labels(table):
    docs, labels = corpus(1500)
    want = dict(labels)
    positives = [x for x in labels if x[1] == 1]  # labels of bad documents aren't needed at all
    frame = table([(d, t, d) for d, t in docs], "doc_id long, text string, score long")
    out = quality.predict(frame, quality.fit(frame, table(positives, "doc_id long, quality int")), "doc_id").collect()
    held = [(r["score"] >= quality.THRESHOLD) == want[r["doc_id"]] for r in out if r["doc_id"] in want]
    assert len(out) == 1500 and np.mean(held) > 0.95 and all(0 <= r["score"] <= 1 for r in out)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.query(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    both = out.join(shared.read(spark, sf, "labels"), "doc_id").where("held_out and quality is not null").collect()
    assert out.count() == 1000 and np.mean([r["predicted"] == r["quality"] for r in both]) >= 0.9


def test_labels_of_held_out_rows_and_bad_labels_change_nothing(table, quick):
    docs, labels = corpus(400)
    frame = table(docs, "doc_id long, text string")
    held = {r[0] for r in frame.where(shared.held_out("doc_id", quality.PARTS, quality.HELD)).select("doc_id").collect()}
    models = [quality.fit(frame, table(x, "doc_id long, quality int"), 200, 300) for x in (labels, [(d, 1 - q if d in held else q) for d, q in labels], [x for x in labels if x[1]])]
    assert all(np.array_equal(models[0].weights, m.weights) for m in models)


def test_edges(spark, table, quick):
    docs, labels = corpus(300)
    rows = [(d, t, "s", 1.0) for d, t in docs] + [(None, "no id", None, None), (900, None, None, None), (901, "", None, None), (901, "", None, None), (902, "word " * 100_000, None, None)]
    frame = table(rows, "doc_id long, text string, place string, score double")
    marks = table([*((d, q, "x") for d, q in labels), (3, 1, "x"), (3, 0, "x"), (None, 1, "x"), (7, None, "x")], "doc_id long, quality int, text string")
    out = quality.predict(frame, quality.fit(frame, marks), "doc_id").collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    empty = [r["score"] for r in out if r["doc_id"] in (900, 901)]
    assert len(set(empty)) == 1
    for d, m in ((frame, marks.limit(0)), (frame.limit(0), marks), (frame.where("doc_id is null"), marks)):
        assert {r["score"] for r in quality.predict(d, quality.fit(d, m), "doc_id").collect()} <= {0.5}


@pytest.mark.parametrize("doc_id", [0, 1, 2, 5])
def test_many_equal_rows_are_one(spark, doc_id, quick):
    docs = spark.range(20_000).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    p, fold, u = quality.sample(docs, spark.createDataFrame([(doc_id,)], "doc_id long"), 50, 50)
    assert len(p) <= 1 and len(u) <= 1 and len(fold) == len(p)
    labels = spark.createDataFrame([(doc_id, 1)], "doc_id long, quality int")
    assert quality.predict(docs, quality.fit(docs, labels), "doc_id").count() == 20_000
