"""Filter interaction audit: what each filter removes in every order in which the filters could be applied.

Every document is reduced to the set of filters it fails (one bit each) and replayed against all
orders: its flags meet the broadcast table of orders, the steps of an order are exploded, the first failure
decides where the document goes, and conditional counts are combined before they are shuffled. Only
numbers take part: texts are read once, and left out after the flags.

Equal texts are told by their SHA-256. Keys that many rows share (a text copied into a third of all rows, one id
in most rows) are looked up in a broadcast table: at most 1,000 keys can have one in 1,000 of all rows. Others are joined by a shuffle.

Defined results: a null text counts as empty, a null source as the empty string. A null doc_id has no labels, is no smaller id, and
nothing is smaller than it. Equal doc_ids aren't smaller than each other, so repeated rows of one id are no duplicates. Labels
that repeat a doc_id mark it good (toxic) if any of them does; missing and null labels mark nothing. An empty table gives no rows.
Very long texts are judged whole. Extra columns of either table are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators.skew import looked_up

from . import shared

LETTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
#: The filters' limits.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2


def text_flags(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides."""
    words = F.array_remove(F.split(text, SPACES), "")
    capitals = F.char_length(text) - F.char_length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < LEAST_DISTINCT * F.size(words).cast("long"),
        "C": 100 * capitals.cast("long") > MOST_CAPITALS * F.char_length(text).cast("long"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, flags (bits of the filters that a document fails), good and toxic of every document; written, as it is read twice."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(failed, bit(letter)).otherwise(0) for letter, failed in text_flags(text).items()]
    narrow = shared.carried(docs, "doc_id", "text", "source").select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), sum(bits[1:], bits[0]).alias("own")
    )
    narrow = shared.materialize(narrow, "audit-flags")
    total = shared.rows(narrow)
    first = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where("n > 1").drop("n")
    marks = {c: F.max(F.col(name) == 1) for c, name in (("good", "quality"), ("toxic", "toxic"))}
    marked = shared.carried(labels, "doc_id", "quality", "toxic").groupBy("doc_id").agg(*(v.alias(c) for c, v in marks.items()))
    known = looked_up(looked_up(narrow, first, "digest", total), marked, "doc_id", total)
    copied = F.when(F.col("doc_id") > F.col("least"), bit("E")).otherwise(0)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return known.select("part", (F.col("own") + copied).alias("flags"), yes("good"), yes("toxic"))


def orders(spark: SparkSession) -> DataFrame:
    """All orders of the filters: filter_order, and the bit of each step's filter (b1, b2, ..)."""
    names = F.array(*(F.lit("".join(p)) for p in permutations(LETTERS)))
    place = lambda k: F.expr(f"shiftleft(1, instr('{LETTERS}', substring(filter_order, {k}, 1)) - 1)").alias(f"b{k}")
    return spark.range(1).select(F.explode(names).alias("filter_order")).select("filter_order", *(place(k) for k in range(1, len(LETTERS) + 1)))


def replay(rows: DataFrame) -> DataFrame:
    """The audit of documents given by part, flags, good and toxic."""
    steps = range(1, len(LETTERS) + 1)
    first = F.coalesce(*(F.when(F.col("flags").bitwiseAND(F.col(f"b{k}")) != 0, k) for k in steps), F.lit(len(LETTERS) + 1))
    met = rows.crossJoin(F.broadcast(orders(rows.sparkSession))).withColumn("first", first)
    each = met.select("part", "filter_order", "flags", "good", "toxic", "first", F.explode(F.array(*(F.struct(F.lit(k).alias("step"), F.col(f"b{k}").alias("bit")) for k in steps))).alias("at"))
    each = each.select("*", "at.step", "at.bit", (F.col("first") == F.col("at.step")).alias("here"))
    counts = {
        "kept": F.col("first") > F.col("step"),
        "removed": F.col("here"),
        "redundant": (F.col("first") < F.col("step")) & (F.col("flags").bitwiseAND(F.col("bit")) != 0),
        "unique_fails": F.col("flags") == F.col("bit"),
        "good_lost": F.col("here") & F.col("good"),
        "toxic_lost": F.col("here") & F.col("toxic"),
    }
    found = each.groupBy("part", "filter_order", "step").agg(*(F.count_if(v).alias(c) for c, v in counts.items()))
    of_filter = Window.partitionBy("part", F.substring("filter_order", F.col("step"), F.lit(1)))
    return found.withColumn("shapley", F.sum("removed").over(of_filter))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long"))
    return replay(flagged(docs, shared.read(spark, sf_dir, "labels")))
