"""A broadcast bit set of hashed ids: which rows of a large table may belong to a set, before an exact join.

Its size is fixed, so it can be broadcast however large the set is; a fuller set of bits only lets more
rows through to the join. Bits are gathered as one 64-bit word for each place, at most WORDS of them."""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 21


def of(ids: DataFrame, column: str = "item") -> Broadcast:
    """The bit set of a column of 64-bit hashes."""
    place = F.shiftrightunsigned(column, 64 - 27)
    words = ids.select((place.bitwiseAND(F.lit(63))).cast("int").alias("bit"), F.shiftright(place, 6).alias("word")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    found = words.toArrow().combine_chunks()
    out = np.zeros(WORDS, np.int64)
    if found.num_rows:
        out[np.asarray(found.column("word").combine_chunks())] = np.asarray(found.column("bits").combine_chunks())
    return ids.sparkSession.sparkContext.broadcast(out.view(np.uint64))


def maybe(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the set."""
    place = ids.view(np.uint64) >> np.uint64(64 - 27)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) > 0
