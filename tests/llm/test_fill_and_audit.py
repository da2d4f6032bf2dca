"""Fill-in-middle and filter audit against brute force on small, awkward tables."""

import hashlib
import re
from itertools import permutations

import pytest

from skyledger.llm import fill_middle, filter_audit

from .conftest import DOCS

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "\t\n ", "a", " a", "a ", "a  b c d", "x <P> y z", "end <", "S> <M", "ünï cödé 𝄞 𝄞𝄞 end.\r\n", "é a\x00b c", "P> a <S b <M c", "one two three\vfour\ffive", "w " * 40_000 + "last"]


def brute(doc_id, text, rate=50):
    text = text or ""
    units = UNITS.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("rate", [50, 100])
def test_fill_middle_against_brute_force(spark, table, rate):
    rows = [(k * len(TEXTS) + j, t, "en", "s", 1) for k in range(6) for j, t in enumerate(TEXTS)] + [(None, "no id at all", None, None, None)] * 2
    docs = table([(*r, f"x{r[0]}") for r in rows], f"{DOCS}, own_form string")
    out = fill_middle.rearranged(docs, rate=rate).withColumn("again", fill_middle.restored())
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "own_form", "form", "n", "prefix_chars", "middle_chars", "output", "again"]
    got = sorted(((r["doc_id"] or -1, r["own_form"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["again"]) for r in out.collect()), key=repr)
    want = sorted(((d or -1, f"x{d}", *brute(d, t, rate), t or "") for d, t, *_ in rows), key=repr)
    assert got == want
    assert {"plain", "spm", "psm"} == {r[3] for r in got}


def test_fill_middle_of_nothing(spark, table):
    out = fill_middle.rearranged(table([], DOCS))
    assert out.collect() == [] and "output" in out.columns


def test_fill_middle_replaces_clashing_columns(spark, table):
    docs = table([(3, "a b c", 7, "old")], "doc_id long, text string, n int, output string")
    assert fill_middle.rearranged(docs).first().asDict().keys() == {"doc_id", "text", "form", "n", "prefix_chars", "middle_chars", "output"}


def audit(docs, labels):
    """The audit, document by document."""
    least, out = {}, {}
    for d, t, s in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    for d, t, s in docs:
        text = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {x for x, bad in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), re.search(r"[#$%&*|]", text), d is not None and d > least[text]), strict=True) if bad}
        for order in map("".join, permutations("ABCDE")):
            first = next((k for k, x in enumerate(order) if x in fails), 5)
            for k, x in enumerate(order):
                row = out.setdefault((s or "", order, k + 1), [0] * 6)
                here = first == k
                for j, yes in enumerate((first > k, here, first < k and x in fails, fails == {x}, here and d in good, here and d in toxic)):
                    row[j] += bool(yes)
    shares = {}
    for (s, order, k), row in out.items():
        shares[s, order[k - 1]] = shares.get((s, order[k - 1]), 0) + row[1]
    return {(*key, *row, shares[key[0], key[1][key[2] - 1]]) for key, row in out.items()}


LONG = " ".join(f"w{k}" for k in range(200))


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_filter_audit_against_brute_force(spark, table, hot, monkeypatch):
    monkeypatch.setattr(filter_audit.looked_up, "__defaults__", (hot,))
    texts = [None, "", LONG, LONG + " X", LONG.upper(), LONG + " #", "same " * 300, "a\x0bb c", LONG + " " + "é" * 50_000]
    docs = [(k, texts[k % len(texts)], f"s{k % 2}" if k % 5 else None) for k in range(40)]
    docs += [(None, LONG, ""), (7, LONG, "s1"), (7, LONG, "s1")] + [(50, "copy", "s0")] * 30
    labels = [(k, int(k % 3 > 0), int(k % 4 == 0)) for k in range(0, 40, 2)] + [(7, 0, None), (7, 1, 1), (50, None, 1), (None, 1, 1)]
    frame = table([(*d, "extra", 1) for d in docs], "doc_id long, text string, source string, flags string, part int")
    marks = table([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string")
    out = filter_audit.replay(filter_audit.flagged(frame, marks))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = [tuple(r[n] for n in names) for r in out.collect()]
    assert len(rows) == len(set(rows)) == 3 * 600
    assert set(rows) == audit(docs, labels)


def test_filter_audit_of_nothing(spark, table):
    empty = table([], "doc_id long, text string, source string"), table([], "doc_id long, quality int, toxic int")
    assert filter_audit.replay(filter_audit.flagged(*empty)).collect() == []
