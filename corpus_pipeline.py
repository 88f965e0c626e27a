"""From documents to tokens: the stages of a training corpus, each on all that is left.

A stage takes the session, its documents and the folder of the tables, and returns the
columns of its documents; the last one returns tokens. Between stages the documents are
written as Parquet and read again, so no stage is computed twice and a lost executor costs
one stage's tasks.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, ngrams, quality, substrings
from tidemark.llm.common import table
from tidemark.session import scratch_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score is high enough."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model, score="_quality")
    return scored.filter(F.col("_quality") >= quality.ACCEPT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of similar ones."""
    return ngrams.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that occur before; others keep their very text."""
    done = substrings.repeated_words(docs)
    changed = F.col("n_removed") > 0
    new = {
        "text": F.when(changed, F.col("kept")).otherwise(F.col("text")),
        "n_chars": F.when(changed, F.char_length("kept")).otherwise(F.col("n_chars")).cast("long"),
    }
    return done.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and the text that they decode to."""
    words = bpe.vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), words)
    decoded = bpe.decode(encoded.drop("text"), words)
    return decoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", keep_good),
    ("near copies", drop_near_copies),
    ("repeated passages", cut_repeats),
    ("benchmark", drop_benchmark),
    ("tokens", to_tokens),
]

# Compression and merging of tokens can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
