"""The pipeline's stages: columns kept, decisions taken, odd rows survived."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidecast.llm.common import saved
from tidecast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = saved(stage(spark, docs, SF_DIR), name)
        assert out.columns == columns
        if name == "ngram_join":
            kept = {r.component_id for r in QUERIES["op6_ngram_join"](spark, SF_DIR).collect()}
            assert {r.doc_id for r in out.collect()} == kept
        docs = out
        counts.append(docs.count())
    assert all(counts) and counts[2] < counts[1] == counts[0]
    tokens = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert sum(r.start == 0 for r in pieces) == tokens


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, name, stage):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a text without key", "en", None, 4), (3, "same words in five or six", "en", "s", 1),
            (4, "Same words in five or six", "en", "s", 1), (4, "Same words in five or six", "en", "s", 1), (5, "12 34", None, "t", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = stage(spark, docs, SF_DIR).collect()
    ids = sorted((r.doc_id for r in out if r.doc_id), key=str)
    if name == "language_id":
        assert ids == [3, 4, 4]
    elif name == "ngram_join":
        assert ids == [1, 2, 3, 5]
    elif name == "suffix_dedup":
        assert ids == [3, 4, 4, 5]
    empty = spark.createDataFrame([], docs.schema)
    assert stage(spark, empty, SF_DIR).count() == 0


def test_passages_of_over_50_words_are_taken_out(spark):
    passage = " ".join(f"p{k}" for k in range(52))
    line, clean = " ".join(f"l{k}" for k in range(40)), " ".join(f"c{k}" for k in range(80))
    assert len(passage.encode()) < 400
    rows = [(k, f"head{k} {passage}\ntail{k}") for k in range(3)] + [(3, f"{clean} {line}"), (4, f"other {line}"), (5, passage), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in corpus_pipeline.without_repeats(spark, docs, SF_DIR).collect()}
    assert out == {k: f"head{k} \ntail{k}" for k in range(3)} | {3: f"{clean} {line}", 4: f"other {line}"}


def test_near_copies_with_null_and_repeated_ids(spark):
    base, other = ([f"{name}{k}" for k in range(60)] for name in ("w", "v"))
    near = [" ".join(base[:-1] + [f"end{k}"]) for k in range(6)]
    far = [" ".join(other[:-1] + [f"end{k}"]) for k in range(3)]
    rows = [(1, near[0]), (None, near[1]), (None, near[2]), (2, near[3]), (2, "a clean text that shares its id"), (1, near[4]),
            (None, far[0]), (None, far[1]), (None, None), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    first = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR).collect()
    assert sum(r.text in near for r in first) == 1 and {r.doc_id for r in first if r.text in near} == {1}
    assert sum(r.text in far for r in first) == 1
    assert sorted(((r.doc_id, r.text) for r in first if r.text not in near + far), key=str) == [(2, "a clean text that shares its id"), (3, ""), (None, None)]
    again = corpus_pipeline.one_of_each_group(spark, docs.repartition(5), SF_DIR).collect()
    assert sorted(first, key=str) == sorted(again, key=str)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0 and rows.count()
