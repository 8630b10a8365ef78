"""Mixing documents to target weights with soft domain membership.

A classifier trained on a labelled table gives every document a posterior over domains. Rates then
say how often each document is to be taken: nonnegative numbers r such that the expected tokens of
each domain, the sum of r * tokens * posterior, match targets in the sense of least squares. They are
found by projected gradient. One step needs one pass that adds up a total per domain; the rate of a
document then follows from its own posterior. With errors weighted by the inverse of
G = sum of tokens * p p' over the rows whose rate can move, and rates by tokens, few steps reach the targets.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import tagged, text_of
from listenlake.llm.memory import give_back, let_go
from listenlake.operators.durable import materialise

TRIGRAMS, SHAPES = 2048, 6
MOST_DOMAINS = 64
STEPS, SLACK = 200, 1e-9


@dataclass(frozen=True)
class Classifier:
    domains: tuple[str, ...]
    weights: bytes = b""


def features(text: str | None) -> tuple[np.ndarray, int]:
    """Shares of hashed letter trigrams, and the shape of the text; and its number of words."""
    data = (text or "").encode("utf-8", "replace").lower()
    words = data.split()
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    out = np.zeros(TRIGRAMS + SHAPES, np.float32)
    if len(b) > 2:
        grams = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(21)
        out[:TRIGRAMS] = np.sqrt(np.bincount(grams, minlength=TRIGRAMS) / len(grams))
    n = len(words)
    if n:
        symbols = ((b > 32) & (b < 48) | (b > 57) & (b < 65) | (b > 90) & (b < 97) | (b > 122) & (b < 128)).sum()
        digits = ((b > 47) & (b < 58)).sum()
        lines = data.split(b"\n")
        out[TRIGRAMS:] = (
            np.log1p(n) / 10, len(b) / n / 10, symbols / len(b), digits / len(b), len(set(words)) / n, len(set(lines)) / len(lines)
        )
    return out, n


def fit(texts: list[str], domains: list[str], steps: int = 150) -> Classifier:
    """Softmax regression, by gradient steps with momentum and step sizes of their own (Adam)."""
    names = tuple(sorted(set(domains)))
    if len(names) > MOST_DOMAINS:
        raise ValueError(f"{len(names)} domains; at most {MOST_DOMAINS} can be mixed")
    if len(names) < 2:
        return Classifier(names or ("all",))
    x = np.stack([np.append(features(t)[0], np.float32(1)) for t in texts])
    y = np.eye(len(names), dtype=np.float32)[[names.index(d) for d in domains]]
    w = np.zeros((x.shape[1], len(names)), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (p - y) / len(x) + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.2 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
    return Classifier(names, w.astype(np.float32).tobytes())


@lru_cache(maxsize=2)
def _weights(model: Classifier) -> np.ndarray:
    return np.frombuffer(model.weights, np.float32).reshape(-1, len(model.domains))


def posteriors(texts: list[str | None], model: Classifier) -> tuple[np.ndarray, list[int]]:
    found = [features(t) for t in texts]
    counts = [n for _, n in found]
    if not model.weights:
        return np.ones((len(texts), 1)), counts
    z = np.stack([np.append(f, np.float32(1)) for f, _ in found]) @ _weights(model) if found else np.zeros((0, len(model.domains)))
    p = np.exp((z - z.max(1, keepdims=True)).astype(float)) if len(z) else z
    return p / p.sum(1, keepdims=True) if len(z) else p, counts


def train(docs: DataFrame, labelled: DataFrame, most: int = 4000, longest: int = 100_000) -> Classifier:
    """Fit on at most ``most`` rows of ``labelled`` (doc_id, domain), drawn by a hash of the id.

    Rows without id or domain are skipped, as are texts of over ``longest`` code points; of several
    domains for one id the first in order counts.
    """
    known = labelled.select(F.col("doc_id").cast("long").alias("_id"), F.col("domain").cast("string").alias("_domain"))
    known = known.where("_id IS NOT NULL AND _domain IS NOT NULL").groupBy("_id").agg(F.min("_domain").alias("_domain"))
    drawn = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    plain = docs.select(F.col("doc_id").cast("long").alias("_id"), text_of("text").alias("_text"))
    texts = plain.where(F.length("_text") <= longest).join(F.broadcast(drawn), "_id")  # of a fixed number of rows
    rows = texts.dropDuplicates(["_id"]).select("_id", "_text", "_domain").toArrow().sort_by("_id")
    model = fit(rows["_text"].to_pylist(), rows["_domain"].to_pylist())
    del rows
    give_back()
    return model


def weighed(text: Column, model: Classifier) -> Column:
    """Tokens of a text and its posterior of each domain, from the whole text alone, which is all that goes to Python."""

    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        let_go()
        found = []
        for i in range(0, len(texts), 200):
            p, counts = posteriors(texts.slice(i, 200).to_pylist(), model)
            found += np.column_stack([counts, p]).tolist()
        return pa.array(found, pa.list_(pa.float64()))

    # a filter on the result would else be moved below it with a call of its own: twice the work, by a second
    # worker for each task, and workers and what they remember live on through the stages to come
    return run.asNondeterministic()(text)


def with_posteriors(docs: DataFrame, text: Column, model: Classifier) -> DataFrame:
    """``docs`` with ``_tokens``, and one posterior column ``_p0``, ``_p1`` … per domain."""
    found = docs.withColumn("_found", weighed(text, model))
    posterior = [F.get("_found", F.lit(i + 1)).alias(f"_p{i}") for i in range(len(model.domains))]
    return found.select(*docs.columns, F.get("_found", F.lit(0)).cast("long").alias("_tokens"), *posterior)


def _raw(pull: list[float]) -> Column:
    """The rate before it is held at its floor."""
    return F.lit(1.0) - sum((F.col(f"_p{i}") * F.lit(float(x)) for i, x in enumerate(pull)), F.lit(0.0))


@dataclass(frozen=True)
class Fit:
    """``rate = max(least, 1 - pull * posterior)``; and targets and totals by domain."""

    pull: list[float]
    target: list[float]
    totals: list[float]
    met: bool
    passes: int


def fitted(
    scored: DataFrame, model: Classifier, targets: dict[str, float] | None, tokens: float | None, least: float, tolerance: float = 1e-4
) -> Fit:
    """Of all rates that meet the targets those that are nearest to 1, in squares weighed by tokens.

    ``targets`` weighs the domains, alike if not given; a domain that isn't named gets nothing. ``tokens`` is the
    sum of the targets, by default that of the documents. With a floor and no ``tokens``, the sum grows as far as it must for
    rates above the floor to meet the weights, and a domain that isn't named keeps what it has. Only numbers per
    domain reach the driver. Steps end when the targets are met or no step leads nearer to them, of which a
    warning tells; if neither is so after ``STEPS`` passes, an error is raised.
    """
    k = len(model.domains)
    sums = scored.agg(F.sum("_tokens"), *[F.sum(F.col("_tokens") * F.col(f"_p{i}")) for i in range(k)]).first()
    total, own = sums[0], np.array(sums[1:], float)
    if not total:
        return Fit([0.0] * k, [0.0] * k, [0.0] * k, True, 0)
    share = np.array([1.0 if targets is None else float(targets.get(d, 0.0)) for d in model.domains])
    if share.sum() <= 0 or (share < 0).any():
        raise ValueError("targets need a positive sum over the domains and no negative weight")
    share, named = share / share.sum(), np.flatnonzero(share)
    if least and tokens is None:
        # errors count across the direction of the weights only, so that the sum is free
        across = np.zeros((k, len(named) - 1))
        across[named] = np.linalg.svd(share[named][None])[2][1:].T
        found = _descended(scored, total, np.zeros(k), across, least, tolerance) if len(named) > 1 else Fit([0.0] * k, [], own.tolist(), True, 0)
        if found.met:
            totals = np.array(found.totals)
            return replace(found, target=np.where(share > 0, share * totals[named].sum(), totals).tolist())
        tokens = max(total, least * (own[named] / share[named]).max())
    target = float(tokens or total) / total * share
    found = _descended(scored, total, target, np.eye(k), least, tolerance)
    if not found.met:
        listed = ", ".join(f"{d} {x:.0f} of {y:.0f}" for d, x, y in zip(model.domains, found.totals, found.target))
        warnings.warn(f"no rates of at least {least:g} meet the targets; tokens by domain: {listed}", stacklevel=2)
    return found


def _descended(scored: DataFrame, total: float, target: np.ndarray, basis: np.ndarray, least: float, tolerance: float) -> Fit:
    """Projected gradient with steps added up before they are projected, so a rate stays one expression.

    ``target`` is in units of ``total``, and the errors that count are those along the columns of ``basis``. A step's
    metric is G over the rows that are not held at the floor. It is shortened until the objective falls as
    it should, which makes the descent end.
    """
    k = len(target)
    p, unit = [F.col(f"_p{i}") for i in range(k)], F.col("_tokens") / F.lit(float(total))

    def at(y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        free, rate = F.col("_raw") >= least, F.greatest(F.lit(float(least)), F.col("_raw"))
        cost = F.when(free, F.col("_raw") * F.col("_raw") / 2).otherwise(F.col("_raw") * least - least * least / 2)
        rows = scored.withColumn("_raw", _raw((basis @ y).tolist()))
        rows = rows.select(*p, (unit * cost).alias("_cost"), (unit * rate).alias("_taken"), F.when(free, unit).otherwise(0.0).alias("_free"))
        moments = [F.sum(F.col("_free") * p[i] * p[j]) for i in range(k) for j in range(i, k)]
        value, *sums = rows.agg(F.sum("_cost"), *[F.sum(F.col("_taken") * x) for x in p], *moments).first()
        totals, gram = np.array(sums[:k], float), np.zeros((k, k))
        gram[np.triu_indices(k)] = sums[k:]
        return value, totals, basis.T @ np.maximum(gram, gram.T) @ basis, basis.T @ (totals - target)

    y, passes = np.zeros(basis.shape[1]), 1
    value, totals, gram, error = at(y)
    slack = SLACK * gram  # at the start all rows are free
    while True:
        met = np.abs(error).sum() <= tolerance * totals.sum()
        gradient = slack @ y - error
        step = -np.linalg.pinv(gram + slack, rcond=1e-12, hermitian=True) @ gradient
        slope = float(gradient @ step)
        if met or -slope <= 1e-12 * max(1.0, abs(value)):
            break
        length = 1.0
        while passes < STEPS:
            near = y + length * step
            found, passes = at(near), passes + 1
            now = found[0] + (basis @ near) @ target + near @ slack @ near / 2
            if now <= value + 1e-4 * length * slope:
                break
            bend = -slope * length * length / (2 * (now - value - slope * length))
            length = max(0.1 * length, min(0.5 * length, bend))
        else:
            raise RuntimeError(f"rates have not settled after {passes} passes; errors by domain: {(basis @ error * total).tolist()}")
        y, value, (_, totals, gram, error) = near, now, found
    return Fit((basis @ y).tolist(), (target * total).tolist(), (totals * total).tolist(), bool(met), passes)


def rated(scored: DataFrame, rates: Fit, least: float) -> DataFrame:
    """``scored`` with ``_rate`` and ``_copies``: the rate rounded up with the probability of its fraction.

    The chance is a hash of id and length, so it is the same in every run.
    """
    out = scored.withColumn("_rate", F.greatest(F.lit(float(least)), _raw(rates.pull)))
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "_tokens"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return out.withColumn("_copies", F.floor(F.col("_rate") + chance))


def mixing_rates(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, tokens: float | None = None,
    least: float = 0.0, **bounds: int,
) -> DataFrame:
    """Rates of all documents: doc_id, n_tokens, domain, posterior, rate, copies.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. Tokens are words
    separated by white space. ``domain`` is the likeliest one and ``posterior`` lists all in alphabetical order.
    Null and empty texts have no tokens and a rate like any text that looks like them; repeated rows get equal rates. Without labelled
    rows there is a single domain, ``all``. An empty table gives no rows.
    """
    model = train(docs, labelled, **bounds)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = materialise(with_posteriors(plain, F.col("text"), model).drop("text"), "posteriors")
    rates = fitted(scored, model, targets if model.weights else None, tokens, least)
    p = [F.col(f"_p{i}") for i in range(len(model.domains))]
    best = F.coalesce(*[F.when(x == (F.greatest(*p) if len(p) > 1 else p[0]), F.lit(d)) for x, d in zip(p, model.domains)])
    return rated(scored, rates, least).select(
        "doc_id", F.col("_tokens").alias("n_tokens"), best.alias("domain"), F.array(*p).alias("posterior"),
        F.col("_rate").alias("rate"), F.col("_copies").alias("copies"),
    )


def mixed(
    docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, tokens: float | None = None, least: float = 0.0
) -> DataFrame:
    """``docs`` with every row as often as its rate says, with its columns."""
    model = train(docs, labelled)
    plain = tagged(docs, F.col("doc_id").cast("long")).withColumnRenamed("_tag", "doc_id")
    posterior = with_posteriors(plain, F.col("_row.text"), model)
    scored = materialise(posterior.drop("_row"), "posteriors")
    rates = fitted(scored, model, targets if model.weights else None, tokens, least)
    # the same model and pull give the same rates again, so the texts need not be joined to them
    again = rated(posterior, rates, least).where("_copies > 0")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return again.select("_row", times.alias("_n")).select("_row.*")
