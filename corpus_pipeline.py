"""From raw documents to token ids: language, near copies, benchmark passages, secrets, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept; its result is
written as Parquet and read again as the next one's docs.

Defined results: documents with a null text, an empty one or one without letters go in the first stage. Very long texts
go through every stage whole. Rows that repeat a document, or are near copies of it, leave one: that of least doc_id, null ids
last, ties by place. A null doc_id, lang or source is kept as it is. An empty table gives no rows. Further columns of
documents are kept up to the last stage, whatever their names; that one returns its own. Without labels to
learn from, every document with a letter passes the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import bpe, decontaminate, language, near_copies, secrets, shared


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no likely language, go."""
    return language.keep_known(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_copies.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.clean(docs, shared.read(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    found = bpe.round_trip(docs, ("doc_id", "lang", "source"))
    return found.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_each),
    ("decontamination", uncontaminated),
    ("secrets", without_secrets),
    ("encoding", encoded),
]

#: A trained network, consistent samples and a tokenizer are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
