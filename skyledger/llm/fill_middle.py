"""Fill-in-middle: a text cut in three at unit boundaries and its pieces dealt in another order.

Each text becomes an array of UTF-32 code points. A unit is white space and the run of other
characters after it (or white space that ends the text), so it ends where a character that isn't white space
meets one that is: neighbouring classes are compared, flatnonzero gives the boundaries of a whole batch, the
drawn ranks index them, and the pieces are slices that are encoded again. Draws are the groups of a SHA-256 of seed and id.

Defined results: a null text counts as empty; an empty text, one that holds a mark, and those not drawn stay as they are (`plain`).
A null id is drawn as the seed and colon alone. Rows are independent, so repeated rows give repeated results, and there are no
ties. Very long texts are cut whole, in about ten times their size of memory. An empty table gives no rows; further columns are
kept by rearranged(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import shared, words

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of a hundred texts, those that are rearranged; of a hundred of these, those whose suffix comes first.
RATE, SUFFIX_FIRST = 50, 80
#: Bytes of texts that become one array of code points.
CHUNK = 1 << 20


def draws(doc_id: str, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers for each id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def form(text: Column, whether: Column, which: Column, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> Column:
    """plain, spm (suffix, prefix, middle) or psm (prefix, suffix, middle)."""
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    stays = (text == "") | marked | (whether % 100 >= rate)
    return F.when(stays, "plain").when(which % 100 < suffix_first, "spm").otherwise("psm")


def boundaries(points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units end in the code points of several texts, given each text's first (n+1 entries), and each text's
    first entry in that list (n+1 entries)."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(len(first), np.int64)
    space = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    ends = np.empty(len(points), bool)
    ends[:-1] = ~space[:-1] & space[1:]
    last = first[1:][np.diff(first) > 0] - 1
    ends[last] = True
    found = np.flatnonzero(ends) + 1
    return found, np.searchsorted(found, first, "right")


def _places(found: np.ndarray, at: np.ndarray, first: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The code point at which a text's first `rank` units end."""
    return np.where(rank > 0, found[np.minimum(at[:-1] + np.maximum(rank, 1) - 1, len(found) - 1)] if len(found) else 0, first[:-1])


def _text(points: np.ndarray) -> str:
    return points.tobytes().decode("utf-32-le")


def dealt(data: np.ndarray, offsets: np.ndarray, forms: list[str], h1: np.ndarray, h2: np.ndarray) -> tuple[list, ...]:
    """Units, prefix and middle lengths (None if plain) and outputs of texts given as bytes and offsets."""
    whole = data.tobytes().decode("utf-8")
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    first = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
    found, at = boundaries(points, first)
    n = np.diff(at)
    ranks = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), 0)
    x, y = (_places(found, at, first, r) for r in ranks)
    prefix_chars, middle_chars, outputs = [], [], []
    for k, kind in enumerate(forms):
        a, b = first[k], first[k + 1]
        if kind == "plain":
            prefix_chars.append(None)
            middle_chars.append(None)
            outputs.append(whole[a:b])
            continue
        prefix, middle, suffix = (_text(points[i:j]) for i, j in ((a, x[k]), (x[k], y[k]), (y[k], b)))
        prefix_chars.append(int(x[k] - a))
        middle_chars.append(int(y[k] - x[k]))
        parts = (SUFFIX, suffix, PREFIX, prefix) if kind == "spm" else (PREFIX, prefix, SUFFIX, suffix)
        outputs.append("".join((*parts, MIDDLE, middle)))
    return n.tolist(), prefix_chars, middle_chars, outputs


ADDED = [StructField("n", LongType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("output", StringType())]


def rearranged(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """docs with the columns form, n (units), prefix_chars, middle_chars and output. Columns of these names are replaced."""
    clashing = {"form", *(f.name for f in ADDED)}
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in clashing))
    own, restored = shared.renamed(docs, "doc_id", "text")
    h = draws("doc_id", seed)
    text = F.coalesce("text", F.lit(""))
    own = own.withColumns({"own_form": form(text, h[2], h[3], rate, suffix_first), "own_h1": h[0], "own_h2": h[1]})
    names = own.columns[:-2]
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.flat(batch.column(place))
            for a, b in words.slices(offsets, CHUNK):
                part = batch.slice(a, b - a)
                forms, h1, h2 = part.column(len(names) - 1).to_pylist(), *(np.asarray(part.column(len(names) + k)) for k in (0, 1))
                made = dealt(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], forms, h1, h2)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.record_batch([*part.columns[: len(names)], *(pa.array(v, k) for v, k in zip(made, kinds, strict=True))], [*names, *(f.name for f in ADDED)])

    out = own.mapInArrow(shared.lean(run), StructType([*own.select(*names).schema.fields, *ADDED]))
    added = ["own_form", *(f.name for f in ADDED)]
    back = restored(out).columns
    return out.toDF(*back, "form", *added[1:])


def restored(output: str | Column = "output", kind: str | Column = "form") -> Column:
    """The text that an output was made from. Pieces hold no marks, and a mark can't begin in one and end in the next."""
    out, kind = (F.col(c) if isinstance(c, str) else c for c in (output, kind))
    bare, middle = F.substr(out, F.lit(len(PREFIX) + 1)), F.substring_index(out, MIDDLE, -1)

    def pieces(second: str) -> tuple[Column, Column]:
        return F.substring_index(bare, second, 1), F.substring_index(F.substring_index(out, second, -1), MIDDLE, 1)

    suffix_first, prefix_first = pieces(PREFIX), pieces(SUFFIX)
    return (
        F.when(kind == "spm", F.concat(suffix_first[1], middle, suffix_first[0]))
        .when(kind == "psm", F.concat(prefix_first[0], middle, prefix_first[1]))
        .otherwise(out)
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rearranged(docs).select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"))
