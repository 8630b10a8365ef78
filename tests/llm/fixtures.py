"""Small document tables with every awkward row, and plain-Python versions of what operators must return."""

from __future__ import annotations

import random
import re

# more columns than an operator needs, some with names that operators use inside
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, name string, level int, row long, key string, n long"

LONG = "alpha beta gamma delta " * 12_000


def rows(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    return [(i, t, "en", f"src{(i or 0) % 3}" if i != 5 else None, len(t or ""), "x", 1, 7, "k", 3) for i, t in texts]


def awkward() -> list[tuple[int | None, str | None]]:
    """Null ids and texts, empty and blank texts, ties, repeated rows, a very long text."""
    base = [
        (1, "one two three four five six seven eight nine ten"),
        (2, "one two  three four five six seven eight nine ten"),
        (3, "one two three four five six seven eight nine ten\n"),
        (3, "one two three four five six seven eight nine ten\n"),
        (4, None), (5, ""), (6, " \t\n"), (None, "lonely text without an id here"), (None, None),
        (7, LONG), (8, LONG + " "), (9, "Über straße 日本語 \U0001f600 end"), (10, "a"), (11, "A"), (12, "a\x0bb\x0cc"),
        (13, "x" * 9000), (14, "x" * 9000 + "y"), (15, "x" * 8192),
    ]
    return base


def near_copies(seed: int = 3, bases: int = 8, copies: int = 9) -> list[tuple[int, str]]:
    """Groups of copies that differ in a few words, of all sizes, with a passage that all groups share."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=30)
    out = []
    for b in range(bases):
        words = draw.choices(vocabulary, k=draw.choice([3, 5, 6, 8, 12, 30, 90, 300]))
        if len(words) > 12:
            words = words + passage
        for _ in range(copies):
            other = words[:]
            for _ in range(draw.randint(0, max(1, len(words) // 25))):
                other[draw.randrange(len(other))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                other += draw.choices(vocabulary, k=draw.randint(1, max(1, len(words) // 8)))
            out.append(" ".join(other))
    draw.shuffle(out)
    return list(enumerate(out, 100))


def words(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(text: str | None) -> frozenset:
    w = words(text)
    return frozenset([tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else []))


def components(texts: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(doc_id, n_shingles, component_id), by comparing all pairs."""
    sets = [shingle_set(t) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(texts, sets))]
