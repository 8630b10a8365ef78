"""From raw documents to packed training sequences, in stages that each work on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again for
the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listenlake.llm import queries
from listenlake.llm.columns import table
from listenlake.llm.exact import drop_exact
from listenlake.llm.jaccard import drop_near
from listenlake.llm.mixing import mixed
from listenlake.llm.packing import packed
from listenlake.llm.toxicity import drop_toxic
from listenlake.operators.durable import materialise

REMEMBERED = 100_000  # words with their ids in packing


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; the others go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without their white space, the one that ``op1`` keeps."""
    return drop_exact(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id."""
    return drop_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say, and once at least: scarce domains are repeated until the mix is met."""
    known = queries.labelled_domains(docs, table(spark, sf_dir, "labels"))
    return mixed(docs, known, queries.MIX, least=1.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    # executors still hold what the stages before have grown to: time is left here, memory isn't
    return packed(docs, remembered=REMEMBERED)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

# The first stage is a trained classifier and the last a genetic search: no SQL says what they return.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
