"""What a worker holds at once, and what it keeps from stage to stage."""

import random

import public_tokenizers
import pyarrow as pa

from listenlake.llm import jaccard as J
from listenlake.llm import memory
from listenlake.llm import packing as P
from listenlake.llm import tokenizer as T


class Docs:
    """Takes the function that workers would run."""

    def __init__(self, spark):
        self.spark = spark

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self.spark.createDataFrame([], schema)


def long_texts(n: int = 40) -> list[str]:
    draw = random.Random(4)
    return [" ".join(f"w{draw.randrange(10**6)}" for _ in range(20_000)) for _ in range(n)]


def test_a_batch_of_long_texts_is_worked_on_in_parts(spark):
    texts, docs = long_texts(), Docs(spark)
    ids = pa.array(range(len(texts)), pa.int64())
    J.sets_and_keys(docs)
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["doc_id", "tag", "text"])
    out = list(docs.run(iter([batch])))
    rows = [len(b) - b.column(3).null_count for b in out]
    assert sum(rows) == len(texts)
    assert max(rows) <= 14  # of about 150 kB each
    wanted = pa.concat_arrays([b.column(0) for b, n in zip(out, rows) if n]).to_pylist()
    J.class_sets(docs, spark.createDataFrame([(c,) for c in wanted], "class long"))
    sets = list(docs.run(iter([batch.select(["text"])])))
    assert [c for b in sets for c in b.column(0).to_pylist()] == wanted
    assert max(b.nbytes for b in sets) < 3_000_000


def test_slices_are_the_batch():
    texts = ["", "a" * 7, None, "b" * 3, "c" * 40, "", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = [part.column(0).to_pylist() for part in memory.slices(batch, 0, 10)]
    assert found == [["", "a" * 7, None, "b" * 3], ["c" * 40], ["", "d"]]
    assert [len(part) for part in memory.slices(batch.slice(0, 0), 0)] == [0]


def test_the_join_keeps_nothing_of_the_stage_before(spark):
    docs = Docs(spark)
    J.sets_and_keys(docs)
    memory.held("windows", "model", dict)
    ids = pa.array([1], pa.int64())
    list(docs.run(iter([pa.RecordBatch.from_arrays([ids, ids, pa.array(["a b c"])], ["doc_id", "tag", "text"])])))
    assert not memory._held


def test_packing_takes_texts_by_bytes(spark, monkeypatch):
    pieces_of = P.pieces_of

    class Watched:
        """Documents whose batches are looked at on their way; a batch's bytes stand in for a piece's checksum."""

        def __init__(self, docs):
            self.docs, self.sparkSession = docs, docs.sparkSession

        def select(self, *columns):
            return Watched(self.docs.select(*columns))

        def mapInArrow(self, run, schema):
            def sized(batches):
                for batch in batches:
                    for out in run(iter([batch])):
                        size = pa.array([batch.nbytes] * len(out), pa.int64())
                        yield out.set_column(out.schema.get_field_index("ids_crc32"), "ids_crc32", size)

            return self.docs.mapInArrow(sized, schema)

    monkeypatch.setattr(P, "pieces_of", lambda docs, *rest: pieces_of(Watched(docs), *rest))
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat('some words ', 20000) AS text").coalesce(1)
    found = P.packed(docs).selectExpr("count(DISTINCT doc_id)", "max(ids_crc32)").first()
    assert found[0] == 60
    assert found[1] < 3_000_000  # 13 MB of texts in all
    assert spark.conf.get(memory.BATCH_BYTES, None) is None


def test_the_pipeline_remembers_fewer_words_in_packing(spark, monkeypatch):
    import corpus_pipeline

    memory.let_go()
    docs = Docs(spark)
    docs.sparkSession = spark
    monkeypatch.setattr(P, "materialise", lambda frame, label: frame)
    monkeypatch.setattr(P, "pack", lambda pieces, capacity: spark.createDataFrame([], "item long"))
    corpus_pipeline.best_fit_packing(spark, docs, "")
    list(docs.run(iter([pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a b c"])], ["doc_id", "text"])])))
    (small,) = memory._held.values()
    assert small._words.most == 100_000
    few = T.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), remembered=3)
    for text in long_texts(1) + ["a b c d e a b", "  x  y ", ""]:
        assert few.encode(text) == small.encode(text)
    assert len(few._words) + len(few._words.old) <= 6
    memory._held.clear()


def test_a_bound_of_the_session_stands(spark):
    spark.conf.set(memory.BATCH_BYTES, "5000000")
    try:
        with memory.small_batches(spark):
            assert spark.conf.get(memory.BATCH_BYTES) == "5000000"
        assert spark.conf.get(memory.BATCH_BYTES) == "5000000"
    finally:
        spark.conf.unset(memory.BATCH_BYTES)


def test_an_encoder_gives_back_what_others_left(monkeypatch):
    memory.let_go()
    given = []
    monkeypatch.setattr(memory, "give_back", lambda: given.append(1))
    memory.held("a kind", "one", dict)
    memory.held("a kind", "one", dict)
    assert given == [1]
    memory._held.clear()
