"""Near copies, passages, neighbours and token counts against plain Python."""

import collections
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skyledger.llm import bits, bpe, clusters, near_copies, neighbours, passages, shared, token_counts

from .conftest import DOCS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text):
    w = WORD.findall((text or "").lower())
    n = min(5, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()


def plain_classes(texts):
    """Least index of the class of each text: equal, or linked by similarity 0.8."""
    sets, parent = [shingle_set(t) for t in texts], list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and (texts[a] == texts[b] or sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return [top(k) for k in range(len(texts))]


def corpus(seed=5):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(800)]
    some = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    texts = [" ".join(some(rnd.randint(1, 120))) for _ in range(120)]
    for size, edits in ((40, 1), (25, 6), (60, 12)):  # groups of copies, the last ones hardly similar
        base = some(150)
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            texts.append(" ".join(w))
    return texts + [texts[3]] * 70 + ["", "", None, None, "!!", "one", "one", "One", "two words"]


def test_near_copies_equal_brute_force(table):
    texts = corpus()
    docs = table([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS).withColumn("item", F.lit(1))
    got = {r["doc_id"]: r for r in near_copies.classes(docs).collect()}
    want = weighted_classes(texts)
    differing = [k for k, c in enumerate(want) if got[k]["class_id"] != c]
    assert not differing, differing[:10]
    assert all(got[k]["kept"] == (c == k) for k, c in enumerate(want))
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(want)


def test_near_copies_of_odd_ids(table):
    text = "a b c d e f g h"
    docs = table([(None, text, "en", "s", 0), (5, text, "en", "s", 0), (5, text, "en", "s", 1), (None, None, "en", "s", 0)], DOCS)
    rows = near_copies.classes(docs).collect()
    assert sum(r["kept"] for r in rows) == 2 and {r["class_id"] for r in rows if r["class_size"] == 3} == {5}
    assert near_copies.keep_one(docs).count() == 2
    assert near_copies.classes(table([], DOCS)).count() == 0


def test_jaccard_matrix_equals_pairs():
    rng = np.random.default_rng(1)
    weights = np.exp(np.arange(10) / 4)
    sets = [clusters.Jaccard.pack(np.sort(rng.choice(40, n, replace=False)), rng.integers(0, 4, n)) for n in rng.integers(1, 40, 60)]
    for similar in (0.3, 0.5, 0.8):
        m = clusters.Jaccard(weights, similar)
        near = m.matrix(sets[:30], sets[30:])
        assert (near == np.array([[m.pair(x, y) for y in sets[30:]] for x in sets[:30]])).all()
        x, y = (k.ravel() for k in np.meshgrid(np.arange(60), np.arange(60)))
        assert (m.pairs(sets, x, y) == [m.pair(sets[a], sets[b]) for a, b in zip(x, y, strict=True)]).all()


def test_components(spark):
    rnd = random.Random(9)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(1000 + k, 1001 + k) for k in range(40)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r["node"]: r["root"] for r in clusters.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in linked}


def weighted_classes(texts, similar=0.8):
    """Least index of the class of each text: equal, or linked by weighted similarity, weights from exact frequencies."""
    counts = [collections.Counter() for _ in texts]
    for c, t in zip(counts, texts, strict=True):
        w = WORD.findall((t or "").lower())
        n = min(5, len(w))
        c.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1) if n)
    held = collections.Counter(s for c in counts for s in c)
    total = sum(t is not None for t in texts)

    def weight(shingle, n):
        rarity = min(1, math.log(total / held[shingle]) / math.log(256))
        return math.exp(round((math.log(n) + math.log(1 + near_copies.SPREAD * rarity)) * near_copies.STEPS) / near_copies.STEPS)

    sets, parent = [{s: weight(s, n) for s, n in c.items()} for c in counts], list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def near(x, y):
        low = sum(min(w, y[s]) for s, w in x.items() if s in y)
        return low and low >= similar * (sum(x.values()) + sum(y.values()) - low)

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and (texts[a] == texts[b] or near(sets[a], sets[b])):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return [top(k) for k in range(len(texts))]


def test_near_copies_by_weight_equal_brute_force(table):
    rnd = random.Random(21)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = []
    for group in range(25):  # common boilerplate and rare words, repeated lines, edits near the limit
        base = [rnd.choice(vocabulary) for _ in range(40)]
        boiler = [f"common{k}" for k in range(rnd.choice((0, 60, 120)))]
        for _ in range(5):
            own = list(base)
            for _ in range(rnd.randint(0, 3)):
                own[rnd.randrange(40)] = rnd.choice(vocabulary)
            texts.append(" ".join(boiler + own * rnd.choice((1, 1, 2))))
    want = weighted_classes(texts)
    got = {r["doc_id"]: r["class_id"] for r in near_copies.classes(table([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS)).collect()}
    assert [got[k] for k in range(len(texts))] == want
    assert len(set(want)) > 10 and want != plain_classes(texts)


def test_weights_follow_the_share_of_texts(table):
    def steps(copies, width):
        rows = [f"common words in all of these {k} x{k} y{k} z{k}" for k in range(50 * copies)] + ["half of all texts hold this line here"] * 50 * copies
        docs = table([(k, t, "en", "s", 0) for k, t in enumerate(rows)], DOCS)
        f = near_copies.document_frequencies(docs, width)
        assert f.sum() == near_copies.DEPTH * sum(len(shingle_set(t)) for t in rows)
        ask = lambda t: near_copies.shingles(*near_copies.words.flat(pa.array([t])))[1]
        return [near_copies.Sampler(f, len(rows)).levels(ask(t), np.ones(len(ask(t)))).tolist() for t in ("common words in all of", "half of all texts hold", "never seen words in here")]

    small, large = steps(1, 1 << 16), steps(8, 1 << 16)
    assert small == large and small[0] < small[2]  # eight times the corpus, the same weights
    assert near_copies.sketch_width(10, 10_000) == near_copies.sketch_width(10**9, 10**12)


def test_passages(spark, table):
    rnd = random.Random(3)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(4000)]
    some = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    long, short, rows = [some(51 + k) for k in range(30)], [some(12) for _ in range(5)], []
    for k in range(240):
        w = some(rnd.randint(30, 200))
        at = rnd.randint(0, len(w))
        rows.append((k, " ".join(w[:at] + (long[k % 30] if k < 120 else short[k % 5] if k < 180 else []) + w[at:]), "en", "s", 0))
    rows += [(500, None, "en", "s", 0), (501, "", "en", "s", 0), (502, " ".join(some(40) * 3), "en", "s", 0), (None, "x y z", "en", "s", 0)]
    docs = table(rows, DOCS).withColumn("item", F.lit(1))
    found = passages.find(docs).collect()
    assert {r["doc_id"] for r in found} == set(range(120))
    by_id = {i: t for i, t, *_ in rows}
    for r in found:
        found_words = by_id[r["doc_id"]][r["start"] : r["end"]].split()  # a similar paragraph may begin or end a few words off
        assert len(found_words) == r["n_words"] >= passages.RUN
        assert sum(w in set(long[r["doc_id"] % 30]) for w in found_words) >= 0.8 * r["n_words"]
    keeper = collections.Counter(r["doc_id"] % 30 for r in found if r["kept"])
    assert len(keeper) == 30
    out = passages.remove(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert passages.find(out).count() == 0
    assert passages.find(table([], DOCS)).count() == 0


def test_passages_with_small_differences(table):
    rnd = random.Random(6)
    some = lambda n: ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]
    shared_part = some(400)
    other = [w if k % 60 else w + "x" for k, w in enumerate(shared_part)]
    docs = table([(1, " ".join(some(30) + shared_part), "en", "s", 0), (2, " ".join(some(30) + other), "en", "s", 0)], DOCS)
    assert sum(r["n_words"] for r in passages.find(docs).collect() if r["doc_id"] == 2) > 200


def test_lines_with_a_changed_word(table):
    rnd = random.Random(12)
    some = lambda n: ["".join(rnd.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]
    rows, lines = [], []
    for k in range(60):
        line = some(52 + k % 40)
        other = [*line[: len(line) // 2], "changed", *line[len(line) // 2 + 1 :]]
        lines.append(other)
        for doc, own in ((k, line), (k + 100, other)):
            rows.append((doc, "\n".join(" ".join(x) for x in (some(30), own, some(30))), "en", "s", 0))
    docs = table(rows, DOCS)
    found = [r for r in passages.find(docs).collect() if not r["kept"]]
    lost = collections.Counter()
    for r in found:
        lost[r["doc_id"]] += r["n_words"]
    # a cut paragraph that differs from another by a word at its end may take that word along
    assert all(len(line) <= lost[k + 100] <= len(line) + 2 for k, line in enumerate(lines)), lost
    left = {r["doc_id"]: r["text"] for r in passages.remove(docs).collect()}
    assert all(left[k] == t for k, t, *_ in rows if k < 100) and all(58 <= len(left[k + 100].split()) <= 60 for k in range(60))


def test_text_kept_for_others_stays_in_a_line_that_goes():
    part = lambda line, k, word, size, first: {"row": 7, "line": line, "k": k, "start": word * 2, "end": (word + size) * 2 - 1, "size": size, "word": word, "root": k, "first_row": first}
    found = [part(False, 2, 20, 11, 1), part(False, 3, 31, 11, 7), part(True, 9, 0, 60, 1)]
    gone, kept = passages._passages({c: np.array([f[c] for f in found]) for c in found[0]}, 16)
    assert [(int(a), int(b), int(n)) for a, b, n in zip(gone["start"], gone["end"], gone["n_words"], strict=True)] == [(0, 61, 31), (83, 119, 18)]
    assert not len(kept["at"])


def nearest(rows, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and len(v) == 8]
    out = {}
    for i, q in good:
        if i % 20 == 0:
            out[i] = sorted(((-float(q @ x), j) for j, x in good if j != i))[:k]
    return out


def test_neighbours(table):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in np.float32(rng.normal(size=8) * rng.uniform(0.5, 2))]) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(300, 340)]  # ties
    rows += [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [float("nan")] * 8), (1080, [None] * 8), (1100, [1.0] * 5), (None, [1.0] * 8), (1120, [float("inf")] * 8)]
    vectors = table(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    got = collections.defaultdict(list)
    for r in neighbours.search(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    want = nearest(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert found == sorted(found) and all(abs(s + np.dot(np.array(rows[q][1]), np.array(rows[j][1]))) < 1e-12 for s, j in found)


@pytest.mark.parametrize("size", [8, 33, 64, 130])
def test_equal_vectors_have_equal_scores(size):
    rng = np.random.default_rng(size)
    distinct = rng.normal(size=(60, size))
    x = distinct[rng.integers(0, 60, 3000)]
    ids = rng.permutation(len(x)).astype(np.int64)
    coder = neighbours.fit(x[:500], float(np.sqrt((x * x).sum(1).max())))
    for block in (slice(0, 3000), slice(3, 1801)):
        index = neighbours.Index(coder, ids[block], x[block])
        for q in x[:100]:
            got, score = index.search(-1, q, coder.codes(q[None], False)[0], 20)
            order = sorted(zip(-score, got, strict=True))
            assert [i for _, i in order] == got.tolist()
            by_vector = {}
            for i, s in zip(got, score, strict=True):
                by_vector.setdefault(x[np.flatnonzero(ids == i)[0]].tobytes(), set()).add(float(s))
            assert all(len(s) == 1 for s in by_vector.values())


def test_neighbours_among_hundreds_of_equal_vectors_in_groups(spark, table, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BYTES", 1 << 11)  # several groups, one after another
    rng = np.random.default_rng(6)
    distinct = rng.normal(size=(12, 16))
    rows = [(k, [float(v) for v in distinct[k % 12]]) for k in range(700)]
    got = collections.defaultdict(list)
    for r in neighbours.search(table(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    x = np.array([v for _, v in rows])
    for q in range(0, 700, 20):
        s = neighbours.scores(x, x[q])
        want = sorted((-s[j], j) for j in range(700) if j != q)[:20]
        assert got[q] == [(k + 1, j, -away) for k, (away, j) in enumerate(want)]


def test_neighbours_of_few(table):
    vectors = table([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r["rank"], r["vec_id"], r["score"]) for r in neighbours.search(vectors, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, 2, 1.0), (2, 1, 0.0)]
    assert neighbours.search(table([], "vec_id long, embedding array<double>"), F.lit(True)).count() == 0


def test_pigeonhole_finds_all_codes_in_the_radius():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 16))
    coder = neighbours.fit(x[:500], float(np.sqrt((x * x).sum(1).max())))
    index = neighbours.Index(coder, np.arange(2000), x)
    for code in coder.codes(x[:20], False):
        apart = neighbours._ONES[index.codes ^ code].sum(1)
        assert (index.within(code) == np.flatnonzero(apart <= coder.radius)).all()


def test_rollup(spark, table):
    r = token_counts.Rollup(spark, shared.fresh(spark, "rollup"))
    rows = lambda *x: table([(*v,) for v in x], token_counts.CHANGES)
    totals = lambda: {(t["source"], t["lang"], t["tokenizer"]): (t["docs"], t["tokens"]) for t in r.totals().collect()}
    first = rows((1, "a", "en", "t1", "insert", 10, 0), (2, "a", "en", "t1", "insert", 5, 0), (2, "b", "en", "t1", "insert", 7, 1), (None, "a", None, "t1", "insert", None, 0), (3, None, "en", None, "insert", 4, 0))
    assert r.commit("one", first) is True and r.commit("one", first) is False
    assert totals() == {("a", "en", "t1"): (1, 10), ("b", "en", "t1"): (1, 7), ("a", None, "t1"): (1, 0), (None, "en", None): (1, 4)}
    assert r.commit("two", rows((1, "c", "fr", "t1", "revise", 12, 0), (2, None, None, "t1", "delete", None, 9), (9, "z", "z", "t1", "delete", 1, 0), (3, "q", "en", None, "revise", 6, 0), (None, "a", None, "t1", "delete", 3, 0)))
    assert totals() == {("c", "fr", "t1"): (1, 12), ("a", None, "t1"): (1, 0), ("q", "en", None): (1, 6)}
    assert r.commit("none", rows()) is True and r.batches() == ["one", "two", "none"]
    assert r.ledger().where("doc_id = 1").first()["tokens"] == 12


def test_overlapping_commits_add_up(spark, table):
    r = token_counts.Rollup(spark, shared.fresh(spark, "rollup"), buckets=3)
    rows = lambda *x: table([(*v,) for v in x], token_counts.CHANGES)
    totals = lambda: {t["source"]: (t["docs"], t["tokens"]) for t in r.totals().collect()}
    assert r.commit("load", rows(*((k, "a", "en", "t", "insert", 10, 0) for k in range(20))))
    other, write, waiting = token_counts.Rollup(spark, r.folder, 3), r._write, ["b", "c"]

    def overtaken(signed, stage):
        write(signed, stage)
        if waiting:  # another writer commits between this one's computing and its rename
            name = waiting.pop()
            assert other.commit(f"other-{name}", rows((1, name, "en", "t", "revise", 7, 1), (2, name, "en", "t", "delete", 0, 0)))

    r._write = overtaken
    assert r.commit("mine", rows((1, "d", "en", "t", "revise", 5, 2), (3, "d", "en", "t", "revise", 6, 2)))
    assert totals() == {"a": (17, 170), "d": (2, 11)}
    assert r.batches() == ["load", "other-c", "other-b", "mine"] and r.commit("mine", rows()) is False
    before = sorted(map(str, r.ledger().collect()))
    assert r.compact() == 4 and sorted(map(str, r.ledger().collect())) == before
    r.vacuum()
    assert totals() == {"a": (17, 170), "d": (2, 11)} and r.commit("other-b", rows()) is False
    assert r.commit("late", rows((1, None, None, "t", "delete", 0, 3))) and totals() == {"a": (17, 170), "d": (1, 6)}


def test_token_counts_of_the_tables_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    kit = Tokenizer.from_file(bpe.find(bpe.TOKENIZER))
    marks = collections.defaultdict(lambda: [0, 1])
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        marks[r["doc_id"]] = [max(marks[r["doc_id"]][0], r["toxic"]), min(marks[r["doc_id"]][1], r["quality"])]
    want = collections.Counter(), collections.Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        toxic, quality = marks.get(r["doc_id"], (0, 1))
        if not toxic:
            split = r"[ \t\n\x0b\f\r-]+" if quality == 0 else r"[ \t\n\x0b\f\r]+"
            for name, n in (("words-1", len([w for w in re.split(split, r["text"] or "") if w])), (bpe.TOKENIZER, len(kit.encode(r["text"] or "", add_special_tokens=False).ids))):
                want[0][r["source"], r["lang"], name] += 1
                want[1][r["source"], r["lang"], name] += n
    got = token_counts.query(spark, sf).collect()
    assert {(r["source"], r["lang"], r["tokenizer"]): (r["docs"], r["tokens"]) for r in got} == {k: (n, want[1][k]) for k, n in want[0].items()}


def test_very_long_text_and_clashing_names_are_counted(table):
    docs = table([(1, "a-b c " * 100_000, "en", "s", 0)], DOCS).withColumn("n_tokens", F.lit(5)).withColumn("version", F.lit(9)).withColumn("op", F.lit("x"))
    for name, n in (("words-1", 200_000), ("words-2", 300_000), (bpe.TOKENIZER, 400_000)):
        got = token_counts.changes(token_counts.counted(docs, name), name).collect()
        assert [(r["n_tokens"], r["op"], r["version"]) for r in got] == [(n, "insert", 0)]


def test_counted_by_vocabulary(table):
    docs = table([(1, "Hello, world!", "en", "s", 0), (2, None, "en", "s", 0)], DOCS)
    assert [r["n_tokens"] for r in token_counts.counted(docs, "word_bpe_49k.json").orderBy("doc_id").collect()] == [4, 0]
    assert [r["n_tokens"] for r in token_counts.counted(docs, "words-1").orderBy("doc_id").collect()] == [2, 0]


def test_bit_set_misses_nothing(spark):
    rng = np.random.default_rng(4)
    held = rng.integers(-(2**63), 2**63 - 1, 5000)
    sent = bits.of(spark.createDataFrame([(int(x),) for x in held], "item long")).value
    assert bits.maybe(sent, held).all()
    assert bits.maybe(sent, rng.integers(-(2**63), 2**63 - 1, 50_000)).mean() < 0.01
    assert not bits.maybe(bits.of(spark.createDataFrame([], "item long")).value, held).any()


def test_scratch_removes_what_is_not_kept(spark):
    with shared.Scratch() as scratch:
        gone = shared.materialize(spark.range(3), "a")
        kept = scratch.keep(shared.materialize(spark.range(4), "b"))
    assert kept.count() == 4
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(gone._skyledger_path)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_very_long_copies(table):
    rnd = random.Random(4)
    long = " ".join(f"w{rnd.randrange(9000)}" for _ in range(150_000))
    docs = table([(1, long, "en", "s", 0), (2, long + " one more", "en", "s", 0), (3, "short", "en", "s", 0)], DOCS)
    assert {r["doc_id"]: r["class_id"] for r in near_copies.classes(docs).collect()} == {1: 1, 2: 1, 3: 3}
    found = [r for r in passages.find(docs).collect() if not r["kept"]]
    assert {r["doc_id"] for r in found} == {2} and 149_900 <= sum(r["n_words"] for r in found) <= 150_002


def test_columns_of_any_name_are_kept(table):
    text = " ".join(f"w{k}" for k in range(60))
    docs = table([(2, text, "en", "s", 0), (1, text + " end", "en", "s", 0), (3, None, None, None, None)], DOCS)
    clash = docs.select("*", *(F.lit(k).alias(c) for k, c in enumerate(("row", "__row", "root", "own_0", "ranges", "__cut", "item"))))
    kept = near_copies.keep_one(clash)
    assert kept.columns == clash.columns and sorted((r["doc_id"], *r[5:]) for r in kept.collect()) == [(1, *range(7)), (3, *range(7))]
    out = {r["doc_id"]: r for r in passages.remove(clash).collect()}
    assert passages.remove(clash).columns == clash.columns and all(tuple(r[5:]) == (*range(7),) for r in out.values())
    assert out[1]["text"] == text + " end" and len(out[2]["text"].split()) < 12 and out[3]["text"] is None  # the least doc_id keeps it


def paragraph_classes(texts):
    """Brute force of the paragraph classes: all pairs of lines and all pairs of cut paragraphs."""
    every = []
    for t, text in enumerate(texts):
        data, offsets = passages.words.flat(pa.array([text]))
        p = passages.Paragraphs(data, offsets)
        for kind, x in enumerate((p, p.lines())):
            folded = [low.decode() for low in (bytes(passages.words.FOLD[data[a:b]]) for a, b in zip(x.starts, x.ends, strict=True))]
            every += [(kind, t, tuple(folded[a:b])) for a, b in zip(x.begin, x.end, strict=True)]
    names = sorted({w for _, _, w in every})
    parent = {w: w for w in names}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {w: {w[k : k + 5] for k in range(len(w) - 4)} for w in names}
    for kind in (0, 1):
        own = sorted({w for k, _, w in every if k == kind and len(w) >= passages.LEAST})
        for i, a in enumerate(own):
            for b in own[:i]:
                if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                    parent[top(a)] = top(b)
    rows = collections.defaultdict(set)
    for _, t, w in every:
        rows[top(w)].add(t)
    return {w: (top(w), min(rows[top(w)])) for w in names if len(rows[top(w)]) > 1}


def test_repeating_paragraphs_equal_brute_force(spark, table):
    rnd = random.Random(31)
    some = lambda n: [f"v{rnd.randrange(5000)}" for _ in range(n)]
    lines, texts = [some(rnd.randint(9, 70)) for _ in range(12)], []
    for _ in range(50):
        own = [some(rnd.randint(3, 40))]
        for _ in range(rnd.randint(0, 3)):
            line = list(rnd.choice(lines))
            if rnd.random() < 0.6:
                line[rnd.randrange(len(line))] = "changed"
            own.insert(rnd.randint(0, len(own)), line)
        texts.append("\n".join(" ".join(x) for x in own))
    docs = table([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS).select(F.col("doc_id").alias("row"), "doc_id", "text")
    with shared.Scratch():
        found = {r["item"]: (r["root"], r["first_row"], r["first_doc"]) for r in passages.repeating(docs, passages.paragraphs(docs)).collect()}

    def item(w):
        return int(passages.Paragraphs(*passages.words.flat(pa.array([" ".join(w)]))).lines().item.view(np.int64)[0])

    want = paragraph_classes(texts)
    assert found.keys() == {item(w) for w in want} and len(want) > 30
    assert all(found[item(w)][1:] == (first, first) for w, (_, first) in want.items())
    groups = collections.defaultdict(set), collections.defaultdict(set)
    for w, (root, _) in want.items():
        groups[0][root].add(item(w))
        groups[1][found[item(w)][0]].add(item(w))
    assert sorted(map(sorted, groups[0].values())) == sorted(map(sorted, groups[1].values()))


def test_shuffle_files_go_when_a_table_is_written(spark):
    held = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = set(re.findall(r"shuffle_\d+", held()))
    out = shared.materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        left = set(re.findall(r"shuffle_\d+", held())) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and shared.rows(out) == out.count() == 7
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "false")
    shared.materialize(spark.range(3), "a")
    assert spark.conf.get(key) == "false"
    spark.conf.unset(key)
