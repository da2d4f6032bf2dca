"""Token counts by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes (insert, revise, delete) is turned into signed rows: the current count of each
changed (doc_id, tokenizer) with a minus sign, and the new one with a plus sign. The signed rows join
the ledger, and their sums by (source, lang, tokenizer) join the totals. Totals are additive, so reading
them sums small tables and never touches documents. Partial sums come before every shuffle, so a source
with a third of all rows is one row a task.

A batch is computed against one version of the ledger and committed as the next version, by one rename: it is
there as a whole or not at all. If another batch took that version meanwhile, the signed rows are computed again
against what it left, so that two batches never subtract the same count. Committing an id again, by a retry or
a second writer, changes nothing. The ledger is bucketed by document, a commit reads only the buckets of its
documents, and compact() sums all versions into one base that later reads begin with.

Defined results: insert and revise both set a document's count, delete of an unknown document does
nothing. Rows of one doc_id and tokenizer are one document: of several changes to it in a batch the one of greatest
`version` counts, then delete before the others, then the greatest count. A change without doc_id can't be
addressed later: as an insert it only adds, otherwise it does nothing. Null source, lang or tokenizer are groups of
their own. A null text has 0 tokens, a very long one is counted as a whole. Groups whose documents are all gone leave
the totals. An empty batch is committed like any other; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, shared

CHANGES = "doc_id long, source string, lang string, tokenizer string, op string, n_tokens long, version long"
GROUP = ("source", "lang", "tokenizer")
LEDGER = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"
BUCKETS, MOST_TRIES = 64, 50
#: Fixed patterns of the tokenizer versions that need no vocabulary.
PATTERNS = {
    "words-1": r"[^ \t\n\x0B\f\r]+",
    "words-2": r"[^ \t\n\x0B\f\r-]+",
    "pieces-1": r"[A-Za-z]+|[0-9]|[^ \t\n\x0B\f\rA-Za-z0-9]+",
}


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs with n_tokens in place of text: by a pattern, or by the vocabulary file of that name."""
    if tokenizer in PATTERNS:
        return docs.withColumn("n_tokens", F.coalesce(F.regexp_count("text", F.lit(PATTERNS[tokenizer])).cast("long"), F.lit(0).cast("long"))).drop("text")
    return bpe.lengths(docs, "text", "n_tokens", tokenizer)


def changes(docs: DataFrame, tokenizer: str, op: str = "insert", version: int = 0, n_tokens: Column | None = None, name: str | None = None) -> DataFrame:
    """The change rows of documents that have n_tokens (deletes need none)."""
    n = n_tokens if n_tokens is not None else F.col("n_tokens") if "n_tokens" in docs.columns else F.lit(0)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit(name or tokenizer).alias("tokenizer"), F.lit(op).alias("op"), n.cast("long").alias("n_tokens"), F.lit(version).cast("long").alias("version"))


class Rollup:
    """Totals and their ledger in one folder of the shared storage: versions/<n> with the n-th batch, base/<n> with
    the sum of all up to it."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        for name in ("versions", "base"):
            self._fs.mkdirs(self._path(name))

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def _numbers(self, of: str) -> list[int]:
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(self._path(of)) if s.getPath().getName().isdigit())

    def version(self) -> int:
        """The number of the last committed batch, 0 before the first."""
        return max(self._numbers("versions"), default=0)

    def batches(self) -> list[str]:
        """The ids of all committed batches, in the order of their versions."""
        return [s.getPath().getName()[3:] for n in self._numbers("versions") for s in self._fs.listStatus(self._path(f"versions/{n:09d}")) if s.getPath().getName().startswith("id=")]

    def _read(self, what: str, schema: str, version: int) -> DataFrame:
        base = max((n for n in self._numbers("base") if n <= version), default=0)
        paths = [f"{self.folder}/base/{base:09d}/{what}"] * (base > 0) + [f"{self.folder}/versions/{n:09d}/{what}" for n in range(base + 1, version + 1)]
        # one read a folder: partitioned folders can't be read together, and compact() keeps them few
        return reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(p) for p in paths]) if paths else self.spark.createDataFrame([], schema)

    def _ledger(self, version: int) -> DataFrame:
        return self._read("ledger", f"{LEDGER}, bucket int", version)

    def ledger(self) -> DataFrame:
        """doc_id, source, lang, tokenizer, docs, tokens: what each document counts for now."""
        return _summed(self._ledger(self.version()), "doc_id", *GROUP).where("docs <> 0")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens."""
        return _summed(self._read("totals", TOTALS, self.version()), *GROUP).where("docs <> 0")

    def _write(self, signed: DataFrame, stage: str) -> None:
        """The rows by bucket, and their sums."""
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int")
        place = F.pmod(F.xxhash64(*signed.columns, F.lit(7)), F.lit(8))  # a bucket is written by several tasks
        placed = signed.withColumns({"bucket": F.coalesce(bucket, F.lit(0)), "place": place}).repartition("bucket", "place").drop("place")
        placed.write.partitionBy("bucket").parquet(f"{self.folder}/{stage}/ledger")
        written = self.spark.read.schema(f"{LEDGER}, bucket int").parquet(f"{self.folder}/{stage}/ledger")
        _summed(written, *GROUP).where("docs <> 0 or tokens <> 0").write.parquet(f"{self.folder}/{stage}/totals")

    def _publish(self, stage: str, target: str) -> bool:
        """Whether the finished folder became the target; not if another writer was first."""
        inside = self._path(f"{target}/{stage.split('/')[1]}")
        if not self._fs.exists(self._path(target)) and self._fs.rename(self._path(stage), self._path(target)) and not self._fs.exists(inside):
            return True
        for left in (self._path(stage), inside):  # a rename onto a folder fails or lands inside it
            self._fs.delete(left, True)
        return False

    def _signed(self, rows: DataFrame, version: int) -> DataFrame:
        """The new counts of changed documents, and what they count for in that version, with a minus sign."""
        known = rows.where("doc_id is not null").groupBy("doc_id", "tokenizer").agg(F.max(F.struct("version", (F.col("op") == "delete").alias("gone"), "n_tokens", "source", "lang")).alias("m"))
        known = known.select("doc_id", "tokenizer", "m.*")
        plus = known.where("not gone").select("doc_id", "source", "lang", "tokenizer", F.lit(1).cast("long").alias("docs"), "n_tokens")
        plus = plus.unionByName(rows.where("doc_id is null and op = 'insert'").select("doc_id", "source", "lang", "tokenizer", F.lit(1).cast("long").alias("docs"), "n_tokens"))
        plus = plus.select("doc_id", "source", "lang", "tokenizer", "docs", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("tokens"))
        if not version:
            return plus
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int")
        asked = [r[0] for r in known.select(bucket.alias("b")).distinct().collect()]  # at most as many as there are buckets
        keys = known.select(F.col("doc_id").alias("d"), F.col("tokenizer").alias("t"))
        now = self._ledger(version).where(F.col("bucket").isin(asked) & F.col("doc_id").isNotNull())
        now = _summed(now.join(keys, (F.col("d") == F.col("doc_id")) & F.col("tokenizer").eqNullSafe(F.col("t")), "left_semi"), "doc_id", *GROUP).where("docs <> 0")
        return plus.unionByName(now.select("doc_id", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")))

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Adds a batch of changes; False if the id has been committed before."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError("a batch id has letters, digits, '_', '.' and '-' only")
        if batch in self.batches():
            return False
        rows = shared.materialize(shared.carried(rows, *(c.split()[0] for c in CHANGES.split(", "))), "changes")  # counted once, however often it is tried
        try:
            for _ in range(MOST_TRIES):
                version, stage = self.version(), f"staging/{uuid.uuid4().hex}"
                if batch in self.batches():
                    return False
                self._write(self._signed(rows, version), stage)
                self._fs.create(self._path(f"{stage}/id={batch}")).close()
                if self._publish(stage, f"versions/{version + 1:09d}"):
                    return True
            raise RuntimeError(f"{MOST_TRIES} other batches were committed while {batch} was")
        finally:
            shared.remove(rows)

    def compact(self) -> int:
        """Sums all versions up to the last into one base; its number. What is read now stays readable."""
        version, stage = self.version(), f"staging/{uuid.uuid4().hex}"
        if version and version not in self._numbers("base"):
            self._write(_summed(self._ledger(version).drop("bucket"), "doc_id", *GROUP).where("docs <> 0 or tokens <> 0"), stage)
            self._publish(stage, f"base/{version:09d}")
        return version

    def vacuum(self) -> None:
        """Removes the data of versions below the last base, and older bases; ids of batches stay. For times without readers."""
        bases = self._numbers("base")
        for n in self._numbers("versions"):
            if bases and n <= bases[-1]:
                for what in ("ledger", "totals"):
                    self._fs.delete(self._path(f"versions/{n:09d}/{what}"), True)
        for n in bases[:-1]:
            self._fs.delete(self._path(f"base/{n:09d}"), True)


def _summed(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are loaded under two tokenizer versions, a pattern's and a vocabulary's; documents labelled toxic
    are taken down; those labelled of low quality are recounted; the ledger is compacted half-way; then every batch
    is sent a second time."""
    docs = shared.read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    labels = shared.read(spark, sf_dir, "labels")
    marked = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    toxic = docs.drop("text").join(marked.where("toxic = 1"), "doc_id", "left_semi")
    recounted = counted(docs, "words-2")  # counted before the join, so that no text is shuffled
    poor = recounted.join(marked.where("quality = 0 and toxic = 0"), "doc_id", "left_semi")
    rollup = Rollup(spark, shared.fresh(spark, "token-counts"))
    down = changes(toxic, "words-1", "delete").unionByName(changes(toxic, bpe.TOKENIZER, "delete"))
    sent = {
        "load-words": changes(counted(docs, "words-1"), "words-1"),
        "load-bpe": changes(counted(docs, bpe.TOKENIZER), bpe.TOKENIZER),
        "takedown": down,
        "recount": changes(poor, "words-1", "revise", version=1),
    }
    for batch, rows in sent.items():
        rollup.commit(batch, rows)
        if batch == "takedown":
            rollup.compact()
    for batch, rows in sent.items():
        rollup.commit(batch, rows)
    return rollup.totals()
