"""Secrets in text: fixed rules, and a linear-chain conditional random field that goes beyond them.

The field tags each word-like token as the begin of a secret, its inside, or outside, from the token's
shape, the words beside it, what separates it from the one before, and features of the whole file. It is
trained on the spans of the rules in a bounded sample of texts, so it learns what secrets look like and where
they stand, and finds some that no rule spells out. Words of letters and tokens of under twelve code
points are outside by definition, so the chain falls into short stretches of other tokens, each of which
is decoded by Viterbi between outside neighbours.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import text_of

# The rules of the contract, kinds in their order.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")
LEAST = {"assign": 12, "access": 18, "hex": 16}
HEX_RUN = re.compile(r"[0-9a-f]{16,}")

OUTSIDE, BEGIN, INSIDE = range(3)
TOKEN = re.compile(r"[\w+/.\-]+")
LONG = re.compile(r"[\w+/.\-]{12,}")
PARTS = re.compile(r"[\w+/.\-]+|[^\w+/.\-]+")
# each kind of feature has a region of its own in the table of weights
REGION, SHAPES, SLOTS = 1 << 11, 10, 16
BEFORE, SECOND, AFTER, GAP, FILE = range(SHAPES, SHAPES + 5)
LEAST_TOKEN = 12
AROUND, SEGMENT = 12, 32


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret) by the rules; those too short are dropped after matching."""
    out = []
    low = text.lower()
    if any(k in low for k in ASSIGN_KEYS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                out.append(("assign", m.start(), m.end(), m.start(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                out.append(("access", m.start(), m.end(), m.start()))
    # runs are as long as they can be, so only those that are long enough need be looked for
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX_RUN.finditer(text)]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def _slot(region: int, value: object) -> int:
    return region * REGION + zlib.crc32(str(value).encode()) % REGION


def candidate(token: str) -> bool:
    """Whether a token may belong to a secret: long, and no word of letters with clinging punctuation."""
    return len(token) >= LEAST_TOKEN and not token.strip("./+-").isalpha()


def shape_slots(token: str) -> list[int]:
    """Features of the token alone; all tokens that can't be in a secret look the same."""
    if not candidate(token):
        return [k * REGION for k in range(SHAPES)]
    n, t = len(token), token[:512]
    lower, upper = sum("a" <= c <= "z" for c in t), sum("A" <= c <= "Z" for c in t)
    digit = sum("0" <= c <= "9" for c in t)
    counts = [t.count(c) for c in set(t)]
    entropy = -sum(k / len(t) * math.log2(k / len(t)) for k in counts)
    kinds = f"{lower > 0:d}{upper > 0:d}{digit > 0:d}{lower + upper + digit < len(t):d}"
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(t, t[1:]))
    size = min(n, 64).bit_length() if n > 12 else n
    shape = (
        "", size, kinds, f"{kinds} {size}", int(2 * entropy), f"{10 * digit // len(t)} {n > 11}",
        f"{5 * upper // len(t)} {n > 11}", min(turns, 6), n > 11 and all(c in "0123456789abcdef" for c in t),
        t[:4] if n > 11 else "",
    )
    return [_slot(k, x) for k, x in enumerate(shape)]


def word_slot(region: int, token: str) -> int:
    """The word beside a token, known by its letters; any number or mixture is one word."""
    return _slot(region, token.lower() if token.isalpha() and len(token) <= 16 else "?")


def gap_slot(gap: str) -> int:
    marks = "".join(c for c in "=:\"'@(<\n" if c in gap)
    return _slot(GAP, f"{marks} {len(gap) > 1}")


def file_slots(text: str) -> list[int]:
    """Features of the whole text, alike for all its tokens."""
    n = max(len(text), 1)
    assigns, lines = text.count("=") + text.count(": "), text.count("\n") + 1
    return [_slot(FILE, min(int(math.log2(1 + 2000 * assigns / n)), 6)), _slot(FILE + 1, min(int(math.log2(n / lines)), 10))]


@dataclass(frozen=True)
class Field:
    """Weights: of features by tag, and of tags in a row."""

    weights: bytes
    turns: tuple[tuple[float, ...], ...]

    def table(self) -> np.ndarray:
        return np.frombuffer(self.weights, np.float32).reshape(-1, 3)


def tokens_of(text: str) -> tuple[list[str], list[str], np.ndarray]:
    """Tokens, the gap before each, and their starts."""
    parts = PARTS.findall(text)
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    odd = bool(parts) and not TOKEN.match(parts[0])
    tokens = parts[1::2] if odd else parts[0::2]
    gaps = (parts[0::2] if odd else ["", *parts[1::2]])[: len(tokens)]
    return tokens, gaps, starts[1::2] if odd else starts[0::2]


def slots_at(i: int, tokens: list[str], gaps: list[str], file: list[int], context_only: bool = False) -> list[int]:
    before = word_slot(BEFORE, tokens[i - 1] if i else "")
    second = word_slot(SECOND, tokens[i - 2] if i > 1 else "")
    after = word_slot(AFTER, tokens[i + 1] if i + 1 < len(tokens) else "")
    context = [before, second, after, gap_slot(gaps[i])]
    return context if context_only else [*shape_slots(tokens[i]), *context, *file]


def _with_other_secret(text: str, mark: tuple[int, int]) -> tuple[str, list[tuple[int, int]]]:
    """The text with a secret of random letters and digits in the place of one of the rules'.

    The rules know hexadecimal values and a few names; with these copies the field learns the place and
    the look of a secret rather than one alphabet.
    """
    draw = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    secret = "".join(draw.choices(string.ascii_letters + string.digits, k=draw.randint(20, 44)))
    start, end = mark
    changed = text[:start] + secret + text[end:]
    rest = [(a, b) for _, _, b, a in base_spans(changed) if b <= start or a >= start + len(secret)]
    return changed, [(start, start + len(secret)), *rest]


def train_field(texts: list[str], epochs: int = 80) -> Field | None:
    """Fit by gradient ascent on the likelihood of the rules' tags, forward and backward over short segments."""
    segments, tags = [], []
    marked_texts = [(text, [(a, b) for _, _, b, a in base_spans(text)]) for text in texts]
    marked_texts += [other for text, marks in marked_texts if marks for other in [_with_other_secret(text, marks[0])]]
    for text, marks in marked_texts:
        tokens, gaps, starts = tokens_of(text)
        if not tokens:
            continue
        tag = np.zeros(len(tokens), int)
        for start, end in marks:
            a, b = np.searchsorted(starts, start, "right") - 1, np.searchsorted(starts, end, "left")
            tag[max(a, 0) : b] = INSIDE
            tag[max(a, 0)] = BEGIN
        file = file_slots(text)
        marked = np.flatnonzero(tag)
        # segments around marks, and the first and a middle one of the text
        centres = [*marked[:: max(1, len(marked) // 20)][:20], AROUND, len(tokens) // 2]
        used = -1
        for c in sorted(int(c) for c in centres):
            a = max(c - AROUND, used + 1, 0)
            b = min(a + SEGMENT, len(tokens))
            if b - a < 2:
                continue
            used = b - 1
            segments.append([slots_at(i, tokens, gaps, file) for i in range(a, b)])
            tags.append(tag[a:b])
    if not any(t.any() for t in tags):
        return None
    n = len(segments)
    slots = np.full((n, SEGMENT, SLOTS), 0)
    y, mask = np.zeros((n, SEGMENT), int), np.zeros((n, SEGMENT), bool)
    for k, (s, t) in enumerate(zip(segments, tags)):
        slots[k, : len(t)], y[k, : len(t)], mask[k, : len(t)] = s, t, True
    weights, turns = np.zeros((SLOTS * REGION, 3)), np.zeros((3, 3))
    past, past_turns = np.full_like(weights, 1e-6), np.full_like(turns, 1e-6)
    real = np.eye(3)[y] * mask[..., None]
    pairs = mask[:, 1:] & mask[:, :-1]
    for _ in range(epochs):
        e = weights[slots].sum(2) * mask[..., None]
        alpha, beta = np.zeros((SEGMENT, n, 3)), np.zeros((SEGMENT, n, 3))
        alpha[0] = e[:, 0]
        for t in range(1, SEGMENT):
            x = alpha[t - 1][:, :, None] + turns
            top = x.max(1)
            alpha[t] = np.where(mask[:, t, None], top + np.log(np.exp(x - top[:, None]).sum(1)) + e[:, t], alpha[t - 1])
        for t in range(SEGMENT - 2, -1, -1):
            x = turns[None] + (e[:, t + 1] + beta[t + 1])[:, None, :]
            top = x.max(2)
            beta[t] = np.where(mask[:, t + 1, None], top + np.log(np.exp(x - top[..., None]).sum(2)), 0.0)
        both = alpha + beta
        whole = both[0].max(1) + np.log(np.exp(both[0] - both[0].max(1, keepdims=True)).sum(1))
        marginal = np.exp(both - whole[None, :, None]).transpose(1, 0, 2) * mask[..., None]
        seen = (real - marginal) / n
        gradient = np.stack(
            [np.bincount(slots.ravel(), np.repeat(seen[..., k].ravel(), SLOTS), SLOTS * REGION) for k in range(3)], 1
        ) - 2e-5 * weights
        joint = alpha[:-1, :, :, None] + turns + (e[:, 1:].transpose(1, 0, 2) + beta[1:])[:, :, None, :]
        joint = np.exp(joint - whole[None, :, None, None]) * pairs.T[..., None, None]
        counted = np.zeros((3, 3))
        np.add.at(counted, (y[:, :-1][pairs], y[:, 1:][pairs]), 1.0)
        turn_gradient = (counted - joint.sum((0, 1))) / n - 1e-4 * turns
        past += gradient**2
        past_turns += turn_gradient**2
        weights += 0.7 * gradient / np.sqrt(past)
        turns += 0.5 * turn_gradient / np.sqrt(past_turns)
    return Field(weights.astype(np.float32).tobytes(), tuple(map(tuple, turns.tolist())))


class Tagger:
    """Decodes whole texts with one field."""

    def __init__(self, field: Field):
        self.table = field.table()
        self.turns = np.array(field.turns)

    def spans(self, text: str) -> list[tuple[int, int]]:
        if not any(map(candidate, LONG.findall(text))):
            return []
        tokens, gaps, starts = tokens_of(text)
        file, out = file_slots(text), []
        found = np.array([i for i, t in enumerate(tokens) if candidate(t)])
        for run in np.split(found, np.flatnonzero(np.diff(found) > 1) + 1):
            tags = self.decoded(int(run[0]), int(run[-1]) + 1, tokens, gaps, file)
            start = None
            for i, tag in zip([*run, run[-1] + 1], [*tags, OUTSIDE]):
                if start is not None and tag != INSIDE:
                    out.append((int(starts[start]), int(starts[i - 1]) + len(tokens[i - 1])))
                    start = None
                if tag == BEGIN or tag == INSIDE and start is None:
                    start = i
        return out

    def decoded(self, a: int, b: int, tokens: list[str], gaps: list[str], file: list[int]) -> list[int]:
        """Best tags of tokens a to b - 1, whose neighbours on both sides are outside."""
        e = np.array([self.table[slots_at(i, tokens, gaps, file)].sum(0) for i in range(a, b)])
        score = e[0] + (self.turns[OUTSIDE] if a else 0)
        back = []
        for row in e[1:]:
            x = score[:, None] + self.turns
            back.append(x.argmax(0))
            score = x.max(0) + row
        if b < len(tokens):
            score = score + self.turns[:, OUTSIDE]
        tags = [int(score.argmax())]
        for pointers in reversed(back):
            tags.append(int(pointers[tags[-1]]))
        return tags[::-1]


@lru_cache(maxsize=2)
def _tagger(field: Field) -> Tagger:
    return Tagger(field)


def found_in(text: str, field: Field | None) -> list[tuple[str, int, int]]:
    """All spans: of the rules, and those of the field that touch none of them."""
    spans = [(k, a, b) for k, a, b, _ in base_spans(text)]
    if field is not None:
        base = sorted((a, b) for _, a, b in spans)
        for a, b in _tagger(field).spans(text):
            if not any(x < b and a < y for x, y in base):
                spans.append(("crf", a, b))
    return spans


def train(docs: DataFrame, most: int = 600, longest: int = 50_000) -> Field | None:
    """Fit on ``most`` texts with spans of the rules and as many without, drawn by a hash of id and text.

    Texts of over ``longest`` code points aren't drawn. Without any span there is nothing to learn.
    """
    plain = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("h"), text_of("text").alias("text"))
    rule = f"(?i)({'|'.join(ASSIGN_KEYS)})[\"']?\\x20*[:=]\\x20*[\"']?[a-z0-9+/_.=-]{{12,}}|(?-i)AKIA[A-Z0-9]{{14,}}|(?-i)[0-9a-f]{{16,}}"
    plain = plain.where(F.length("text") <= longest).withColumn("has", F.col("text").rlike(rule))
    texts = []
    for has in (True, False):
        side = plain.where(F.col("has") == has)
        # the hashes alone tell the last one drawn; at most as many texts then come to the driver
        last = side.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]
        if last is not None:
            texts += [r.text for r in side.where(F.col("h") <= last).select("text").limit(most).toLocalIterator()]
    return train_field(sorted(texts))


def secrets(docs: DataFrame, **bounds: int) -> DataFrame:
    """Spans of secrets: doc_id, n_assign, n_access, n_hex, base_sha256, spans per row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. ``spans`` lists
    kind:start:end, comma-joined, in code points; those of the rules always, and those of kind crf, which touch
    none of them. ``base_sha256`` covers the rules' alone. Null and empty texts have no spans; null ids
    and repeated rows are treated like all others, and an empty table gives no rows.
    """
    field = train(docs, **bounds)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans = found_in(text.as_py(), field)
                base = [x for x in spans if x[0] != "crf"]
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
