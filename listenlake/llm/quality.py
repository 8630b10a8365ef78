"""Quality rules per document and per host.

Each document is held against a few rules. How often a host's documents fail a rule is shrunk towards
the rate of all hosts by a beta prior that is fitted to the hosts themselves, so that a host of three
documents isn't judged by three coin tosses. A host whose shrunk rate for any rule is over the limit
is rejected, and its verdict joins back to the documents. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import WHITE, once, text_of
from listenlake.operators.durable import materialise

# The base rules of the contract and the characters that count as symbols.
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
SYMBOLS = "#*$%&|<>"
# What a document fails, besides few words and repeated windows; a host's verdict uses all of them.
SYMBOL_PERCENT, DUP_LINE_PERCENT = 20, 50
RULES = ("few_words", "repeats", "symbols", "dup_lines")
HOST_LIMIT = 0.5


def document_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row: doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines.

    A null text has no words; a null host is a host of its own. Windows are told apart by a 64-bit
    hash within one text.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host") if host in docs.columns else F.lit(None).cast("string").alias("host"),
        text_of("text").alias("text"),
    )
    # each step explodes an array of one struct: its expressions are computed once, not again in
    # every lambda that uses them
    split = base.select(
        "doc_id",
        "host",
        F.inline(once(
            F.regexp_extract_all("text", F.lit(f"[^{WHITE}]+"), F.lit(0)).alias("words"),
            F.length(F.translate("text", " \t\n\u000b\f\r", "")).cast("long").alias("word_chars"),
            (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.filter(F.split("text", "\n", -1), lambda x: F.rtrim(F.translate(x, "\t\u000b\f\r", "")) != "").alias("lines"),
        )),
    )
    hashed = split.select(
        "doc_id", "host", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.inline(once(
            F.when(
                F.size("words") > WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice("words", i, WINDOW)),
                ),
            ).otherwise(F.array().cast("array<bigint>")).alias("hashes"),
        )),
    )
    # most texts repeat no window; only the others are sorted
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    placed = hashed.select(
        *[c for c in hashed.columns if c != "hashes"],
        F.inline(once(
            F.when(
                repeats,
                F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).alias("order"),
        )),
    )
    last = F.size("order") - 1
    marked = placed.select(
        *[c for c in placed.columns if c != "order"],
        F.inline(once(
            F.array_sort(
                F.transform(
                    F.filter(
                        F.sequence(F.lit(0), last),
                        lambda k: ((k > 0) & (F.get("order", k - 1)["h"] == F.get("order", k)["h"]))
                        | ((k < last) & (F.get("order", k + 1)["h"] == F.get("order", k)["h"])),
                    ),
                    lambda k: F.get("order", k)["i"],
                )
            ).alias("places"),
        )),
    )
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("places") - 1),
        F.lit(WINDOW).cast("long"),
        lambda total, k: total + F.least(F.lit(WINDOW), F.get("places", k) - F.get("places", k - 1)),
    )
    return marked.select(
        *[c for c in marked.columns if c != "places"],
        # places are null or two at least
        F.when(F.col("places").isNull(), F.lit(0).cast("long")).otherwise(covered).alias("n_repeat_words"),
    )


def _failures() -> dict[str, Column]:
    c = F.col
    return {
        "few_words": c("n_words") < LEAST_WORDS,
        "repeats": 100 * c("n_repeat_words") > REPEAT_PERCENT * c("n_words"),
        "symbols": 100 * c("n_symbols") > SYMBOL_PERCENT * c("word_chars"),
        "dup_lines": 100 * c("n_dup_lines") > DUP_LINE_PERCENT * c("n_lines"),
    }


def host_rates(counts: DataFrame) -> DataFrame:
    """(host, n, <rule>_rate) with the failure rates shrunk by a beta prior per rule.

    The prior is fitted by moments to the rates of the hosts: mean m and variance v of the rates give
    alpha + beta = m (1 - m) / v - 1. Where hosts don't differ more than chance allows, or none fails,
    there is nothing to tell them apart: the prior then weighs as much as all rows.
    """
    sums = [F.sum(x.cast("long")).alias(f"{name}_bad") for name, x in _failures().items()]
    hosts = materialise(counts.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *sums), "hosts")
    moments = [F.sum("n").alias("rows")]
    for name in RULES:
        rate = F.col(f"{name}_bad") / F.col("n")
        moments += [F.avg(rate).alias(f"{name}_m"), F.var_pop(rate).alias(f"{name}_v")]
    prior = hosts.agg(*moments).first()
    out = []
    for name in RULES:
        m, v = prior[f"{name}_m"] or 0.0, prior[f"{name}_v"] or 0.0
        weight = max(m * (1 - m) / v - 1, 0.0) if v > 1e-12 else float(prior["rows"] or 0)
        out.append(((F.col(f"{name}_bad") + m * weight) / (F.col("n") + weight)).alias(f"{name}_rate"))
    return hosts.select("host", "n", *out)


def quality_rules(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, base verdict and final verdict per row of ``docs``.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host,
    host_kept``. A document stays if it passes the base rules and its host isn't rejected: a host is,
    if more than ``limit`` of its documents are expected to fail one rule. Rows without a host (null, or
    no such column) form one host. Repeated rows are counted and returned as often as they occur; an
    empty table gives no rows. The join on the host is left to adaptive execution, which splits a host
    with a large share of all rows and broadcasts the verdicts only if they turn out to be small.
    """
    counts = materialise(document_counts(docs, host), "quality-counts")
    rates = host_rates(counts)
    over = F.greatest(*[F.col(f"{name}_rate") for name in RULES]) > limit
    verdicts = rates.select(F.col("host").alias("_host"), (~over).alias("host_kept"))
    c = F.col
    failed = (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > REPEAT_PERCENT * c("n_words"))
    joined = counts.join(verdicts, counts.host.eqNullSafe(F.col("_host")))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & c("host_kept")).alias("kept"), "host", "host_kept",
    )
