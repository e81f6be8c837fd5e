"""Rows parted and looked up by bit tables, and rows written without shuffle files left behind."""

from pyspark.sql import functions as F

import corpus_pipeline
from tidecast.llm import mixing
from tidecast.llm.common import CLEANUP, saved
from tidecast.llm.tables import looked_up, parted

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_parted(spark):
    rows = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit("a wide text").alias("text"))
    sure, others = parted(rows, rows.where("id % 100 = 7 or id is null"), "id")
    sure, others = ({r.id for r in part.collect()} for part in (sure, others))
    assert {None, *range(7, 1000, 100)} <= others and len(others) < 20
    assert not sure & others and sure | others == {None, *range(1, 1000)}
    sure, others = parted(rows, rows.limit(0), "id")
    assert sure.count() == 1000 and others.count() == 0


def test_looked_up_with_full_tables(spark):
    rows = spark.range(3000).select("id", F.lit("a wide text").alias("text"))
    values = rows.select("id", F.when(F.col("id") % 7 == 0, 0).otherwise(F.col("id") % 3 + 1).alias("copies"))
    expected = {r.id: r.copies for r in values.collect()}
    for bits in (1 << 19, 1 << 25):  # many rows share bits, few do
        found = looked_up(rows, values, "id", "copies", bits).collect()
        assert len(found) == 3000 and {r.id: r.copies for r in found} == expected and {r.text for r in found} == {"a wide text"}
    assert looked_up(rows.limit(0), values.limit(0), "id", "copies").count() == 0


def test_texts_are_joined_only_where_tables_leave_it_open(spark):
    docs = spark.createDataFrame([(i, f"text {i} of its own " * 20, "en", "st"[i % 2], 1) for i in range(400)], DOCS)
    plan = mixing.mix(docs)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Union") == 1  # before: one join of all texts


def test_equal_rows_with_nulls_moved(spark):
    rows = [(1, "a", None, "b", 1), (1, "a", "b", None, 1), (1, None, "a", "b", 1), (1, "a", None, "b", 1), (None, "a", None, "b", 1), (1, "a", None, "b", None)]
    docs = spark.createDataFrame([(i, t and f"{t} few words", *more) for i, t, *more in rows], DOCS)
    found = corpus_pipeline.one_of_each_group(spark, docs, "").collect()
    # The equal texts form one group, of which the row with the least id stays; the one without text stays too.
    assert sorted(r.text is None for r in found) == [False, True]


def test_shuffle_files_go(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(type(spark.range(0)), "write", property(lambda df, own=type(spark.range(0)).write.fget: kept.append(spark.conf.get(CLEANUP, None)) or own(df)))
    before = spark.conf.get(CLEANUP, None)
    assert saved(spark.range(50).groupBy((F.col("id") % 10).alias("k")).count(), "test-cleanup").count() == 10
    assert kept == ["true"] and spark.conf.get(CLEANUP, None) == before
