"""Exact duplicates and quality rules against SQL and against plain Python on awkward rows."""

import hashlib
import re
from collections import Counter

import pytest
from conftest import SMALL
from fixtures import SCHEMA, awkward, rows
from oracle import compare

from listenlake.llm import queries
from listenlake.llm.exact import drop_exact, exact_groups
from listenlake.llm.quality import quality_rules


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, queries.QUERIES[name], queries.ORACLES[name], SMALL) == ""


def plain_groups(texts):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in texts]
    out = []
    for (doc, text), key in zip(texts, norm):
        same = [(i, len(t or "")) for (i, t), k in zip(texts, norm) if k == key]
        keep = min(same, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[0]
        out.append((doc, keep, len(same), hashlib.sha256(key.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("key", ["xxhash64(block)", "length(block)", "0"])
@pytest.mark.parametrize("block", [4096, 3])
def test_groups_match_plain_python_whatever_the_key(spark, key, block):
    texts = [(i, (t or "")[:20000] if t else t) for i, t in awkward()]
    if block == 3:
        texts = [(i, t) for i, t in texts if len(t or "") < 100]
    found = exact_groups(spark.createDataFrame(rows(texts), SCHEMA), block, key).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == plain_groups(texts)
    # one row of each group stays
    kept = Counter(r.text_sha256 for r in found if r.kept)
    assert kept == Counter({r.text_sha256: 1 for r in found})


def test_dropping_keeps_columns_and_one_row_of_each_text(spark):
    docs = spark.createDataFrame(rows(awkward()), SCHEMA)
    out = drop_exact(docs)
    assert out.columns == docs.columns
    best = {}
    for i, t in awkward():
        key = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best[key] = min(best.get(key, (1, True, 0, "")), (-len(t or ""), i is None, i or 0, t or ""))
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted((i, t) for _, _, i, t in best.values())


@pytest.mark.parametrize("run", [exact_groups, quality_rules, drop_exact])
def test_an_empty_table_gives_no_rows(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {p for i, x in enumerate(windows) if often[x] > 1 for p in range(i, i + 8)}
    n_symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), n_symbols, len(lines) - len(set(lines)), len(covered)


def test_counts_match_plain_python(spark):
    texts = awkward() + [
        (20, "a b c d e f g h a b c d e f g h i"), (21, "a " * 30), (22, "#x |y|\n#x |y|\n\n \n#x |y|"), (23, "p q r s t u v w\np q r s t u v w"),
        (24, "a b c d e f g h x a b c d e f g h y a b c d e f g h"),
    ]
    found = quality_rules(spark.createDataFrame(rows(texts), SCHEMA)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == Counter((i, *plain_counts(t)) for i, t in texts)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in found)
    assert not any(r.kept and r.base_failed for r in found)


def test_a_small_host_is_shrunk_and_a_bad_one_rejected(spark):
    good = [f"w{i} " + " ".join(f"u{i}v{j}" for j in range(40)) for i in range(400)]
    data = [(i, t, f"h{i % 40}") for i, t in enumerate(good)]
    data += [(1000 + i, "too short", "bad") for i in range(300)] + [(2000, good[0], "bad")]
    data += [(3000, "short", "tiny"), (3001, good[1], "tiny")]
    found = {r.doc_id: r for r in quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert all(found[i].kept for i in range(400))
    assert not found[2000].kept and not found[2000].base_failed and not found[2000].host_kept
    assert found[3001].kept
