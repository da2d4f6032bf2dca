"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of all distinct new words of a batch lie in one flat array. In each round every word
merges its lowest-rank pair, at all its places from left to right; ranks are found by binary search
over the sorted pair keys, and only pairs beside a merge are looked up again. This equals merging
one pair at a time because a merged symbol only takes part in pairs of higher rank, which is checked
when the file is loaded. Words over LONG bytes, which would need too many rounds, go through a
priority queue with the same result. Words are told apart by a 64-bit hash.

Defined results: null encodes as empty; an empty or all-blank text has no ids and decodes to "".
The strings of special tokens in a text become their ids. Rows are independent, so repeated rows
give repeated results, and a very long text is encoded as a whole; an empty table gives no rows; extra columns are
kept by encode() and decode(), and round_trip() keeps those asked for. One named like a result is replaced by it.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from . import shared, words

TOKENIZER = "word_bpe_49k.json"
CHUNK = 1 << 20
LONG = 512
CACHE = 1 << 19
NONE = np.int64(1 << 40)
#: Code points with the White_Space property below U+10000.
BLANK = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Blocks whose characters neither compose with others nor have changed class since early Unicode.
PLAIN = [(0, 0x250), (0x370, 0x483), (0x48A, 0x530), (0x2000, 0x2070), (0x20A0, 0x20B0), (0x2190, 0x2200), (0x2500, 0x2600), (0x3000, 0x3040), (0x3041, 0x3099), (0x30A0, 0x3100), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4)]


def find(name: str) -> str:
    """A tokenizer file by path, or by name among the installed public ones."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For code points below 65536: lower case, class (0 blank, 1 letter, 2 number, 3 other), handled here."""
    lower, kind, plain = np.arange(65536, dtype=np.uint32), np.full(65536, 3, np.uint8), np.zeros(65536, bool)
    old = unicodedata.ucd_3_2_0.category
    for a, b in PLAIN:
        for c in range(a, b):
            x, category = chr(c), unicodedata.category(chr(c))
            kind[c] = {"L": 1, "N": 2}.get(category[0], 3)
            small = x.lower()
            plain[c] = len(small) == 1 and not unicodedata.combining(x) and unicodedata.normalize("NFC", x) == x and category != "Cn" and old(x)[0] == category[0] and unicodedata.category(small)[0] == category[0]
            lower[c] = ord(small[0])
    kind[BLANK] = 0
    return lower, kind, plain


def _alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    table = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class BPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        size = 1 + max(max(vocab.values()), max(t["id"] for t in spec["added_tokens"]))
        tokens = [""] * size
        for token, i in vocab.items():
            tokens[i] = token
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.large_string())
        self.alphabet = _alphabet()
        self.byte = {c: b for b, c in enumerate(self.alphabet)}
        self.inner = np.array([vocab[c] for c in self.alphabet], np.int64)
        self.final = np.array([vocab[c + end] for c in self.alphabet], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        a, b = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[x + y] for x, y in pairs], np.int64)
        rank = np.arange(len(pairs), dtype=np.int64)
        born = np.full(size, -1, np.int64)
        np.maximum.at(born, made, rank)
        if (born[a] >= rank).any() or (born[b] >= rank).any():
            raise ValueError("merge rounds need parts that are made before the pairs they take part in")
        keys = a << 32 | b
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], rank[order], made[np.argsort(rank)]
        self.split = re.compile("|".join(map(re.escape, self.special)))
        self._library = path, None
        self._forget()

    def _forget(self) -> None:
        self._known, self._at, self._size, self._pool = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.rank[at], NONE)

    def merge(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[starts : starts + lengths], end to end, and how many each has."""
        symbols = self.inner[data[words.ragged(starts, lengths)]]
        last = np.cumsum(lengths) - 1
        symbols[last] = self.final[data[starts + lengths - 1]]
        counts, done = np.zeros(len(starts), np.int64), []
        large = np.flatnonzero(lengths > LONG)
        for w in large:
            ids = self._queue(symbols[last[w] + 1 - lengths[w] : last[w] + 1].tolist())
            counts[w] = len(ids)
            done.append((np.full(len(ids), w), np.array(ids, np.int64)))
        owner = np.repeat(np.arange(len(starts)), lengths)
        if len(large):
            keep = lengths[owner] <= LONG
            owner, symbols = owner[keep], symbols[keep]
        ranks = np.full(len(symbols), NONE)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        ranks[inner] = self._ranks(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(owner)])
            best = np.minimum.reduceat(ranks, first)
            over = best == NONE
            if over.any():
                out = np.repeat(over, size)
                counts[owner[first[over]]] = size[over]
                done.append((owner[out], symbols[out]))
                owner, symbols, ranks = owner[~out], symbols[~out], ranks[~out]
                best, size = best[~over], size[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == np.repeat(best, size))
            run = at - np.arange(len(at))
            begin = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            place = np.arange(len(at)) - np.repeat(begin, np.diff(np.r_[begin, len(at)]))
            at = at[place % 2 == 0]
            symbols[at] = self.made[ranks[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))
            owner, symbols, ranks = owner[stay], symbols[stay], ranks[stay]
            near = np.union1d(at, at[at > 0] - 1)
            ranks[near] = NONE
            near = near[near < len(symbols) - 1]
            near = near[owner[near] == owner[near + 1]]
            ranks[near] = self._ranks(symbols[near], symbols[near + 1])
        if not done:
            return np.zeros(0, np.int64), counts
        owners, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        return ids[np.argsort(owners, kind="stable")], counts

    def _queue(self, symbols: list[int]) -> list[int]:
        left, right = np.array(symbols[:-1], np.int64), np.array(symbols[1:], np.int64)
        heap = [(int(r), i) for i, r in enumerate(self._ranks(left, right)) if r < NONE]
        heapq.heapify(heap)
        table = self._table()
        before, after, alive = [*range(-1, len(symbols) - 1)], [*range(1, len(symbols) + 1)], [True] * len(symbols)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= len(symbols) or table.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i], alive[j], after[i] = int(self.made[rank]), False, after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(symbols)
                if b < len(symbols) and (r := table.get((symbols[a], symbols[b]))) is not None:
                    heapq.heappush(heap, (r, a))
        return [s for s, ok in zip(symbols, alive, strict=True) if ok]

    def _table(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_pairs"):
            self._pairs = {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(r) for k, r in zip(self.keys, self.rank, strict=True)}
        return self._pairs

    def library(self):
        """The library's own tokenizer: normalises and splits texts with characters outside PLAIN."""
        if self._library[1] is None:
            from tokenizers import Tokenizer

            self._library = self._library[0], Tokenizer.from_file(self._library[0])
        return self._library[1]

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Normalises and splits texts free of special tokens: bytes, starts, ends of words, first word of each text."""
        text = data.tobytes().decode("utf-8", "surrogatepass")
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lower, kind, plain = _characters()
        lead = (data & 0xC0) != 0x80
        bound = np.r_[0, np.cumsum(lead)][offsets]
        low = np.minimum(code, 65535).astype(np.uint16)
        odd = (code > 65535) | ~plain[low]
        if odd.any():
            return self._mixed(text, bound, odd)
        code = lower[low]
        kinds = kind[code]
        n = len(code)
        edge = np.zeros(n + 1, bool)
        edge[bound] = True
        new = edge[:-1].copy()
        new[1:] |= (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
        quote = np.flatnonzero((code == 0x27) & new)
        if len(quote):
            self._contractions(code, edge, new, quote)
        start = np.flatnonzero(new & (kinds > 0))
        close = np.flatnonzero(new)
        end = np.r_[close, n][np.searchsorted(close, start, "right")]
        if len(data) == n:
            return code.astype(np.uint8), start, end, np.searchsorted(start, bound)
        wide = np.r_[0, np.cumsum(1 + (code > 0x7F) + (code > 0x7FF).astype(np.int64))]
        out = np.frombuffer(code.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        return out, wide[start], wide[end], np.searchsorted(start, bound)

    @staticmethod
    def _contractions(code, edge, new, quote) -> None:
        """A quote that begins a word and is followed by s, t, re, ve, m, ll or d makes a word with it."""
        n = len(code)
        padded = np.r_[code, 0, 0]
        inside = ~np.r_[edge[1:], True, True]
        a, b = padded[quote + 1] * inside[quote], padded[quote + 2] * (inside[quote] & inside[quote + 1])
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        for at, size in ((quote[one], 2), (quote[two], 3)):
            new[at + 1] = False
            new[at[at + size < n] + size] = True

    def _mixed(self, text: str, bound: np.ndarray, odd: np.ndarray):
        """Texts with other characters are normalised and split by the library, their neighbours as usual."""
        kit, parts = self.library(), []
        bad = np.add.reduceat(np.r_[odd, False].astype(np.int64), np.minimum(bound[:-1], len(odd))) if len(bound) > 1 else []
        for k in range(len(bound) - 1):
            own = text[bound[k] : bound[k + 1]]
            if own and bad[k]:
                split = [w for w, _ in kit.pre_tokenizer.pre_tokenize_str(kit.normalizer.normalize_str(own))]
                raw = [bytes(self.byte[c] for c in w) for w in split]
                size = np.array([len(r) for r in raw], np.int64)
                end = np.cumsum(size)
                parts.append((np.frombuffer(b"".join(raw), np.uint8), end - size, end))
            else:
                raw = np.frombuffer(own.encode("utf-8", "surrogatepass"), np.uint8)
                parts.append(self.pieces(raw, np.array([0, len(raw)]))[:3])
        base = np.cumsum([0, *(len(p[0]) for p in parts)])
        first = np.cumsum([0, *(len(p[1]) for p in parts)])
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] + b for p, b in zip(parts, base, strict=False)]), np.concatenate([p[2] + b for p, b in zip(parts, base, strict=False)]), first

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts data[offsets[i] : offsets[i + 1]], end to end, and n+1 offsets of ids."""
        if len(offsets) > 1 and b"<|" in (raw := data.tobytes()) and any(s.encode() in raw for s in self.special):
            return self._with_special(raw, offsets)
        data, starts, ends, first = self.pieces(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        h = words.hashes(data, starts, ends, np.arange(256))
        distinct, index, which = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self._known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self._known):
            new = self._known[np.minimum(at, len(self._known) - 1)] != distinct
        if new.any():
            if len(self._known) + new.sum() > CACHE:
                self._forget()
                new[:], at = True, np.zeros(len(distinct), np.int64)
            w = index[new]
            ids, counts = self.learn(data, starts[w], ends[w] - starts[w])
            begin = len(self._pool) + np.cumsum(counts) - counts
            self._pool = np.r_[self._pool, ids]
            self._at, self._size = np.insert(self._at, at[new], begin), np.insert(self._size, at[new], counts)
            self._known = np.insert(self._known, at[new], distinct[new])
            at = np.searchsorted(self._known, distinct)
        size = self._size[at][which]
        out = self._pool[words.ragged(self._at[at][which], size)]
        return out, np.r_[0, np.cumsum(size)][first]

    def learn(self, data, starts, lengths):
        return self.merge(data, starts, lengths)

    def _with_special(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts, marks = [], []
        for k in range(len(offsets) - 1):
            own, p = raw[offsets[k] : offsets[k + 1]].decode("utf-8", "surrogatepass"), 0
            for m in self.split.finditer(own):
                texts.append(own[p : m.start()].encode("utf-8", "surrogatepass"))
                marks.append(self.special[m[0]])
                p = m.end()
            texts.append(own[p:].encode("utf-8", "surrogatepass"))
            marks.append(-1)
        bound = np.cumsum([0, *map(len, texts)])
        clean = np.frombuffer(b"".join(texts), np.uint8)
        if any(s.encode() in clean.tobytes() for s in self.special):  # parts that only join across a cut
            parts = [self._plain(t) for t in texts]
        else:
            ids, at = self.encode(clean, bound)
            parts = [ids[at[k] : at[k + 1]] for k in range(len(texts))]
        out, ends, n = [], [0], 0
        for part, mark in zip(parts, marks, strict=True):
            out += [part, np.array([mark], np.int64)] if mark >= 0 else [part]
            n += len(part) + (mark >= 0)
            if mark < 0:
                ends.append(n)
        return np.concatenate(out), np.array(ends)

    def _plain(self, text: bytes) -> np.ndarray:
        return self.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]

    def decode(self, ids: pa.Array, offsets: np.ndarray) -> pa.Array:
        """Tokens of each row's ids joined by one space, special ones included."""
        rows = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), self.tokens.take(ids))
        return pc.binary_join(rows, pa.scalar(" ", pa.large_string()))


@lru_cache(2)
def load(name: str) -> BPE:
    return BPE(find(name))


def chunks(kit: BPE, column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Encodes a column of texts in slices of bounded size: rows from, to, ids, n+1 offsets of ids."""
    data, offsets = words.flat(column)
    for a, b in words.slices(offsets, CHUNK):
        yield a, b, *kit.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def encode(df: DataFrame, column: str = "text", out: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """df with a column of token ids (array<int>); a column of that name is replaced."""
    df = df.drop(out)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = load(tokenizer)
        for batch in batches:
            for a, b, ids, at in chunks(kit, batch.column(names.index(column))):
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch([*batch.slice(a, b - a).columns, lists], [*names, out])

    return df.mapInArrow(shared.lean(run), StructType([*(f for f in df.schema.fields), *StructType().add(out, ArrayType(IntegerType())).fields]))


def decode(df: DataFrame, column: str = "ids", out: str = "decoded", tokenizer: str = TOKENIZER) -> DataFrame:
    """df with a column of the decoded text of its ids; null ids decode to "". A column of
    that name is replaced."""
    df = df.drop(out)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = load(tokenizer)
        for batch in batches:
            lists = batch.column(names.index(column)).cast(pa.large_list(pa.int64()))
            size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            text = kit.decode(pc.list_flatten(lists), np.r_[0, np.cumsum(size)])
            yield pa.record_batch([*batch.columns, text.cast(pa.string())], [*names, out])

    return df.mapInArrow(shared.lean(run), StructType([*(f for f in df.schema.fields), *StructType().add(out, StringType()).fields]))


def lengths(df: DataFrame, column: str = "text", out: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """df with the number of token ids in place of the texts."""
    own = [c for c in df.columns if c not in (column, out)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = load(tokenizer)
        for batch in batches:
            for a, b, _, at in chunks(kit, batch.column(len(own))):
                yield pa.record_batch([*batch.slice(a, b - a).columns[:-1], pa.array(np.diff(at), pa.int64())], [*own, out])

    given = df.select(*(F.col(f"`{c}`") for c in own), F.col(f"`{column}`"))
    return given.mapInArrow(shared.lean(run), StructType([*given.schema.fields[:-1], *StructType.fromDDL(f"{out} long").fields]))


def round_trip(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), tokenizer: str = TOKENIZER) -> DataFrame:
    """One pass over texts: the columns to keep, n_tokens, ids (little-endian unsigned 32-bit), decoded."""
    keep = tuple(c for c in keep if c not in ("n_tokens", "ids", "decoded"))
    docs = docs.select(*(F.col(f"`{c}`") for c in keep), F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = load(tokenizer)
        for batch in batches:
            for a, b, ids, at in chunks(kit, batch.column(len(keep))):
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer((at * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                text = kit.decode(pa.array(ids), at)
                yield pa.record_batch([*batch.slice(a, b - a).columns[:-1], pa.array(np.diff(at), pa.int64()), packed.cast(pa.binary()), text.cast(pa.string())], [*keep, "n_tokens", "ids", "decoded"])

    return docs.mapInArrow(shared.lean(run), StructType([*docs.schema.fields[:-1], *StructType.fromDDL("n_tokens long, ids binary, decoded string").fields]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = round_trip(docs)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
