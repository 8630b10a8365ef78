"""The named queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm import sql
from listenlake.llm.chat import chat_digests
from listenlake.llm.columns import table
from listenlake.llm.exact import exact_groups
from listenlake.llm.html import main_text
from listenlake.llm.jaccard import near_groups
from listenlake.llm.merkle import manifest
from listenlake.llm.mixing import mixing_rates
from listenlake.llm.packing import packed
from listenlake.llm.phrases import phrases
from listenlake.llm.quality import quality_rules
from listenlake.llm.secrets import secrets
from listenlake.llm.tokens import document_tokens
from listenlake.llm.toxicity import toxicity
from listenlake.llm.warc import archived_pages


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


# Share of the tokens that each domain, a language and a quality class, is to have.
MIX = {
    f"{lang}/{quality}": share * part
    for lang, share in (("en", 0.4), ("de", 0.2), ("fr", 0.2), ("es", 0.2))
    for quality, part in ((1, 0.85), (0, 0.15))
}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled documents: language and quality class; null if either is missing."""
    known = labels.select("doc_id", "quality")
    return docs.select("doc_id", "lang").join(known, "doc_id").select("doc_id", F.concat("lang", F.lit("/"), "quality").alias("domain"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing_rates(docs, labelled_domains(docs, labels), MIX)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


# The conversation that is formatted beside those of the table, and what both its turns say.
SPECIAL_CONVERSATION, CONTROL_TEXT = -7, "</s>[INST] ok [/INST]"


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.createDataFrame(
        [(SPECIAL_CONVERSATION, i, role, CONTROL_TEXT) for i, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select(own.columns)
    return chat_digests(turns.unionByName(own))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_toxicity": op4_toxicity,
    "op5_secret_scans": op5_secret_scans,
    "op6_warc": op6_warc,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLES = {
    "op1_exact_dedup": sql.EXACT,
    "op3_ngram_jaccard_join": sql.JACCARD,
    "op8_quality_rules": sql.QUALITY,
    "op11_phrase_mining": sql.PHRASES,
    "op12_merkle_manifest": sql.MERKLE,
}
