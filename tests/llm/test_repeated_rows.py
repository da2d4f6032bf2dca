"""Operators that sample or collect, on tables of very many equal rows and few distinct ids."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import decontaminate, language, neighbours, shared

from .test_text_operators import WORD, low


@pytest.mark.parametrize("vec_id", [0, 20, 40, 7])
def test_neighbours_of_equal_rows(spark, vec_id):
    rows = spark.range(20_000).select(F.lit(vec_id).cast("long").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    assert neighbours.search(rows, F.col("vec_id") % 20 == 0).collect() == []  # no row but the query's own


def test_neighbours_with_few_distinct_ids(spark, monkeypatch):
    rows = spark.range(6000).select((F.col("id") % 3 * 20).alias("vec_id"), F.array(F.sin("id"), F.cos("id"), F.sin(F.col("id") * 2)).alias("embedding"))
    seen = []
    fit = neighbours.fit
    monkeypatch.setattr(neighbours, "fit", lambda x, *more: seen.append(len(x)) or fit(x, *more))
    got = neighbours.search(rows, F.col("vec_id") % 20 == 0, sample=256).collect()
    assert seen == [256] and len(got) == 60
    table = np.array([(r["vec_id"], *r["embedding"]) for r in rows.collect()])
    for r in got:
        assert r["vec_id"] != r["query_id"]
        near = table[(table[:, 0] == r["vec_id"])][:, 1:] @ min([tuple(x[1:]) for x in table if x[0] == r["query_id"]])
        assert np.isclose(near, r["score"]).any()


def test_drawn_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("a"), F.lit("same").alias("b"), "id")
    assert shared.drawn(rows, 5, "a", "b").count() == 5 and shared.drawn(rows, 50, "a", "b").count() == 7
    assert shared.drawn(rows.limit(0), 5, "a", "b").count() == 0


@pytest.mark.parametrize("doc_id", [0, 1, 2, 3])
def test_language_of_equal_rows(spark, doc_id, monkeypatch):
    docs = spark.range(30_000).select(F.lit(doc_id).cast("long").alias("doc_id"), F.lit("words of one language").alias("text"), F.lit("en").alias("lang"))
    x, y, languages = language.sample(docs)
    assert len(x) <= language.SAMPLE_WINDOWS and set(languages) <= {"en"}
    held = docs.select(shared.held_out("doc_id", language.PARTS, language.HELD)).first()[0]
    got = language.predict(docs, language.fit(docs), "doc_id").groupBy("lang_pred").count().collect()
    assert [tuple(r) for r in got] == [("und" if held else "en", 30_000)]


def test_all_labels_are_learnt(spark):
    docs = spark.range(2400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit("w"), F.col("id") % 1200)] * 8).alias("text"), F.concat(F.lit("l"), F.col("id") % 1200).alias("lang"))
    known = docs.where(~shared.held_out("doc_id", language.PARTS, language.HELD)).select("lang").distinct().count()
    assert known > 1000 and len(language.sample(docs)[2]) == known  # more labels than any fixed number
    assert len(language.sample(docs, total=50)[2]) <= 50  # one document of each at most


def found(docs, items, window=13):
    """n_words, hit words and items of each document, word by word."""
    sets = []
    for item, text in items:
        w = WORD.findall(low(text or ""))
        n = min(window, len(w))
        if n:
            sets.append((item, n, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}))
    out = {}
    for doc, text in docs:
        w, hit, own = WORD.findall(low(text or "")), set(), set()
        for item, n, windows in sets:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    own.add(item)
        out[doc] = (len(w), len(hit), sorted(x for x in own if x is not None))
    return out


@pytest.mark.parametrize("bound", [3000, 1 << 20])
def test_repeated_and_long_items_stay_below_the_bound(spark, table, bound, monkeypatch):
    long = " ".join(f"w{k}" for k in range(1000))
    items = [("a", "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron")] * 300
    items += [("long", long), ("long", long), (None, "one two three four"), ("short", "one two three four"), ("none", "!!"), ("null", None)]
    items += [(f"i{k}", " ".join(f"x{k}y{j}" for j in range(20))) for k in range(20)]
    docs = [(0, long), (1, " ".join(long.split()[700:730])), (2, "so one TWO three, four"), (3, items[0][1]), (4, None), (5, "clean text"), (6, items[-1][1] + " tail " + items[-9][1])]
    sizes = []
    own = decontaminate.window_set
    monkeypatch.setattr(decontaminate, "window_set", lambda ids, texts, window: sizes.append(sum(len(t.as_py() or "") for t in texts)) or own(ids, texts, window))
    frame, bench = table(docs, "doc_id long, text string"), table(items, "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.scan(frame, bench, max_set_bytes=bound).collect()}
    assert got == found(docs, items)
    assert 0 < max(sizes) <= bound and min(sizes) > 0 and sum(sizes) < 2 * (len(long) + 20 * 180 + 200)
