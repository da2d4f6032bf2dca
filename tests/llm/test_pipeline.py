"""The pipeline's stages on a small corpus, against what each is to do."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import bpe, queries, shared

from .conftest import DOCS
from .test_duplicates import corpus, weighted_classes
from .test_text_operators import base_spans, contaminated

KIT = Tokenizer.from_file(bpe.find(bpe.TOKENIZER))


@pytest.fixture
def folder(spark, tmp_path):
    texts = [t for t in corpus() if t is not None]
    items = [(k, " ".join(texts[k].split()[:15])) for k in range(8) if len(texts[k].split()) > 15]
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in enumerate(texts)]
    rows += [(900 + k, "unlike all the others, text number %d says token = abcdef12345678 and more %s" % (k, "word%d " % k * 9), "en", "s", 1) for k in range(5)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    return f"file://{tmp_path}", rows, items


def test_run_equals_brute_force(spark, folder):
    at, rows, items = folder
    kept = [r for r in rows if any(c.isalpha() for c in r[1])]
    classes = weighted_classes([r[1] for r in kept])
    kept = [r for k, r in enumerate(kept) if classes[k] == k]
    kept = [r for r, c in zip(kept, contaminated([(r[0], r[1]) for r in kept], items), strict=True) if not c[-1]]
    want = {}
    for i, text, *_ in kept:
        out, p = "", 0
        for a, _, b in base_spans(text):
            if a >= p:
                out += text[p:a] + "[SECRET]"
            p = max(p, b)
        want[i] = out + text[p:]
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, at).collect()}
    assert got.keys() == want.keys() and any("[SECRET]" in t for t in want.values())
    for i, text in want.items():
        ids = KIT.encode(text, add_special_tokens=False).ids
        assert bytes(got[i]["ids"]) == np.array(ids, "<u4").tobytes()
        assert got[i]["decoded_sha256"] == hashlib.sha256(KIT.decode(ids).encode()).hexdigest()


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).columns == docs.columns


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


WORDS = {"en": "the and ing tion of to was is er th", "fr": "le de et que les une ment eau qui aux", "de": "der und ung ich sch ein ver heit das ge"}


def spoken(rnd, lang, n):
    return " ".join("".join(rnd.choice(WORDS[lang].split()) for _ in range(3)) for _ in range(n))


def test_edges_of_the_pipeline(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(k, spoken(rnd, lang, rnd.randint(30, 90)), lang, f"s{k % 5}", 1) for k, lang in enumerate(["en", "fr", "de"] * 60)]
    long = spoken(rnd, "fr", 60_000)
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (502, "123 !!", "en", "s", 0), (503, long, "fr", "s", 0), (504, long + " fin", None, None, None), (None, spoken(rnd, "de", 50), None, None, 0)]
    rows += [rows[7], rows[7], (7000, rows[7][1], "fr", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", *(f"{k} as {c}" for k, c in enumerate(("row", "lang_pred", "score", "items", "n_hit", "spans", "ids", "root", "__row"))))
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[0][1]), (2, None)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    at = f"file://{tmp_path}"
    kept = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = shared.materialize(stage(spark, kept, at), "edges")
        assert kept.columns == docs.columns
    assert all([r[c] for c in docs.columns[5:]] == [*range(9)] for r in kept.collect())
    got = corpus_pipeline.run(spark, at).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted([*(str(k) for k in range(1, 180)), "503", "None"])
    assert {r["doc_id"]: r["n_tokens"] for r in got}[503] == len(KIT.encode(long, add_special_tokens=False).ids)


def test_pipeline_of_empty_tables(spark, tmp_path):
    at = f"file://{tmp_path}"
    spark.createDataFrame([], DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    assert corpus_pipeline.run(spark, at).count() == 0
