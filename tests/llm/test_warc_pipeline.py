"""Archives: round trips and pushed filters; and the pipeline, stage by stage, against plain Python."""

import base64
import hashlib
from collections import Counter

import pytest
from conftest import SMALL
from fixtures import SCHEMA, components, near_copies, rows
from pyspark.sql import functions as F

from listenlake.llm import exact, merkle, mixing, packing, quality, queries, secrets, tokens, toxicity, warc
from listenlake.llm.jaccard import near_groups

PAGES = [
    (1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "https://c\r\nEvil: 1", ""), (5, "https://d", "WARC/1.0\r\n\r\n" * 3),
    (0, "http://e", "<p>x</p>"), (None, "http://f", "<p>x</p>"), (None, "http://g", "lonely"), (7, "http://h", "é" * 3_000_000), (8, "http://i", "twice"),
    (8, "http://j", "twice"), (8, "http://j", "twice"),
]
KIND = "page_id long, url string, html string, digest string, size int, first boolean"


def pages(spark):
    return spark.createDataFrame([(*p, "d", 1, True) for p in PAGES], KIND).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_pages_come_back_from_their_archives(spark):
    found = warc.archived_pages(pages(spark)).collect()
    want = Counter()
    for i, (page, _, html) in enumerate(PAGES):
        same = [(p is None, p or 0, k) for k, (p, _, h) in enumerate(PAGES) if (h or "") == (html or "")]
        first = min(same)
        mine = (page is None, page or 0, i)
        want[(page, len((html or "").encode()), digest(html), *(("response", None) if mine == first else ("revisit", PAGES[first[2]][0])))] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == want
    assert warc.archived_pages(pages(spark).limit(0)).count() == 0


@pytest.mark.parametrize("compress", [False, True])
def test_filters_are_pushed_and_payloads_read_on_demand(spark, root, compress):
    warc.write_pages(pages(spark), root, compress=compress)
    some = warc.read_warc(spark, root).where((F.col("record_type") == "response") & F.col("target_uri").startswith("https"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo" not in plan and "StartsWith(target_uri" not in plan and "= response" not in plan
    assert {r.page_id: bytes(r.payload).decode() for r in some.collect()} == {5: "WARC/1.0\r\n\r\n" * 3}
    heads = warc.read_warc(spark, root, ["record_type", "page_id"])
    assert Counter(r.record_type for r in heads.collect()) == Counter(response=6, revisit=6)
    assert warc.read_warc(spark, root).where(F.col("record_type").isin("revisit", "request")).count() == 6


def test_a_damaged_payload_is_not_returned(spark, root):
    (file,) = [r.file for r in warc.write_pages(pages(spark).where("page_id = 1").coalesce(1), root).collect()]
    data = open(f"{root}/{file}", "rb").read()
    open(f"{root}/{file}", "wb").write(data.replace(b"<p>x</p>", b"<p>y</p>"))
    with pytest.raises(Exception, match="is damaged"):
        warc.read_warc(spark, root).collect()


def test_stages_work_on_what_the_one_before_kept(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.train(docs, labels)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL).cache()
        before, after = [[(r.doc_id, r.text) for r in x.collect()] for x in (docs, out)] if name != "best_fit_packing" else (None, None)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        if name == "toxicity":
            assert Counter(after) == Counter(x for x in before if toxicity.score(x[1], model) < 0.5)
        elif name == "exact_dedup":
            best = {}
            for i, t in before:
                key = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
                best[key] = min(best.get(key, (1, 0, "")), (-len(t or ""), i, t))
            assert Counter(after) == Counter((i, t) for _, i, t in best.values())
        elif name == "ngram_jaccard_join":
            kept = {c for _, n, c in components(before) if n} | {i for i, n, _ in components(before) if not n}
            assert Counter(i for i, _ in after) == Counter(kept)
        elif name == "mixing":
            assert set(after) == set(before)
        else:
            ids = Counter((r.doc_id, r.piece) for r in out.collect())
            times = Counter(r.doc_id for r in docs.collect())
            assert {i: n for (i, k), n in ids.items() if k == 0} == dict(times)
            fill = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("n"), F.sum("n")).first()
            assert fill[0] <= 2048 and fill[1] <= -(-fill[2] // 2048) + 2
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_the_pipeline_takes_clashing_columns_and_nulls(spark):
    import corpus_pipeline

    texts = [*near_copies(9, 4, 4), (None, None), (1, ""), (2, None), (3, "a b"), (3, "a b")]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == [x.split()[0] for x in SCHEMA.split(", ")]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= 4


# names that operators use inside
INNER = "_tag _id _toxic _domain _text _row _n _found _tokens _p0 _rate _copies _raw tag class root score best row level".split()


def test_inner_names_of_the_caller_come_back_as_they_were(spark):
    import corpus_pipeline

    texts = [*near_copies(9, 3, 4), (None, "x y"), (3, "a b"), (3, "a b")]
    data = [(*r[:5], *(f"{name} {i}" for name in INNER)) for i, r in enumerate(rows(texts))]
    ddl = ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *(f"{name} string" for name in INNER)])
    docs = spark.createDataFrame(data, ddl)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        found = docs.collect()
        assert found and {tuple(r) for r in found} <= set(data), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= 3
    docs = spark.createDataFrame(data, ddl)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    known = queries.labelled_domains(docs, labels)
    runs = [
        exact.exact_groups, near_groups, tokens.document_tokens, secrets.secrets, quality.quality_rules, packing.packed, merkle.manifest,
        lambda d: toxicity.toxicity(d, labels), lambda d: mixing.mixing_rates(d, known, queries.MIX),
    ]
    for run in runs:
        assert run(docs).select("doc_id").distinct().count() == len({r[0] for r in data})
