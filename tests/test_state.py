import datetime

import pytest
from pyspark.sql import functions as F

from tidecast.operators import collections as docs, state as st
from tidecast.schemas import STATE
from tidecast.streaming.sinks import StateTable

T = [datetime.datetime(2024, 1, 1, h) for h in range(5)]


def rows(spark, *values):
    return spark.createDataFrame([(p, k, v, T[t], b) for p, k, v, t, b in values], STATE)


def content(df):
    return {(r.path, r.key): r.value_json for r in df.collect()}


def test_update_merges_and_keeps_the_newest(spark):
    old = rows(spark, ("s", "a", "1", 1, 0), ("s", "b", "2", 1, 0), ("t", "a", "3", 1, 0))
    new = rows(spark, ("s", "a", "9", 2, 1), ("s", "c", "4", 2, 1), ("t", "a", "0", 0, 1))
    merged = st.state_update(old, new)
    assert content(merged) == {("s", "a"): "9", ("s", "b"): "2", ("s", "c"): "4", ("t", "a"): "3"}
    assert content(st.state_update(merged, new)) == content(merged)
    assert content(st.state_update(new, old)) == content(merged)


def test_set_replaces_the_path_and_what_is_under_it(spark):
    old = rows(spark, ("ads", "timestamp", '"x"', 1, 0), ("ads/ads", "A", "1", 1, 0), ("ads/ads", "B", "2", 1, 0),
               ("adsense", "k", "5", 1, 0))
    new = rows(spark, ("ads/ads", "C", "3", 2, 1))
    assert content(st.state_set(old, "ads/ads", new)) == {
        ("ads", "timestamp"): '"x"', ("ads/ads", "C"): "3", ("adsense", "k"): "5"}
    assert content(st.state_set(old, "ads", new)) == {("ads/ads", "C"): "3", ("adsense", "k"): "5"}


def test_delete_and_get(spark):
    old = rows(spark, ("a", "b", "1", 1, 0), ("a/b", "x", "2", 1, 0), ("a", "c", "3", 1, 0))
    assert content(st.state_get(old, "a")) == content(old)
    assert content(st.state_delete(old, "a/b")) == {("a", "c"): "3"}
    assert st.state_get(old, "none").count() == 0


def test_push_generates_growing_unique_keys(spark):
    values = spark.range(0, 100, 1, 5).select(F.lit('{"same":1}').alias("value_json"), F.lit(T[0]).alias("updated_at"))
    first = st.state_push(spark.createDataFrame([], STATE), "log", values, 1)
    both = st.state_push(first, "log", values, 2)
    keys = [r.key for r in both.orderBy("batch_id", "key").collect()]
    assert len(set(keys)) == 200 and keys == sorted(keys)


def test_children_are_json(spark):
    record = spark.createDataFrame([(T[0], 'a"b', 1.5, None, [1, 2])],
                                   "updated_at timestamp, t string, d double, n int, l array<int>")
    assert content(st.children(record, "p", ["t", "d", "n", "l"])) == {
        ("p", "t"): '"a\\"b"', ("p", "d"): "1.5", ("p", "n"): "null", ("p", "l"): "[1,2]"}


def test_state_table_versions(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"))
    assert table.read().count() == 0
    for batch in (0, 1):
        changes = rows(spark, ("s", "a", str(batch), batch, batch))
        table.commit(st.state_update(table.read(batch), changes), batch)
    again = rows(spark, ("s", "a", "1", 1, 1))
    table.commit(st.state_update(table.read(1), again), 1)
    assert content(table.read()) == {("s", "a"): "1"}
    assert content(table.read(before=1)) == {("s", "a"): "0"}
    empty = StateTable(spark, str(tmp_path / "state"))
    empty.commit(st.state_delete(empty.read(), "s"), 2)
    assert empty.read().count() == 0


def test_state_table_reuses_its_folders(spark, tmp_path):
    table = StateTable(spark, str(tmp_path / "state"), keep=3)
    for batch in (0, 1, 2, 4, 5, 6):
        table.commit(st.state_update(table.read(batch), rows(spark, ("s", str(batch), "1", 1, batch))), batch)
    assert sorted(k for _, k in content(table.read())) == ["0", "1", "2", "4", "5", "6"]
    assert table.version() == 6 and table.version(before=6) == 5
    assert len(list((tmp_path / "state").glob("slot=*"))) == 3


@pytest.fixture
def collection(spark):
    rows = [("03", "x", ("en", 1)), ("01", "x", ("de", 2)), ("02", "y", ("en", 2)), ("04", None, None)]
    return spark.createDataFrame(rows, "_id string, k string, u struct<lang: string, n: int>")


def test_find(collection):
    assert [r._id for r in docs.find_many(collection, {"k": "x"}).collect()] == ["01", "03"]
    assert [r._id for r in docs.find_many(collection, {"u.lang": "en", "u.n": 2}).collect()] == ["02"]
    assert [r._id for r in docs.find_many(collection, {}, limit=2).collect()] == ["01", "02"]
    assert [r._id for r in docs.find_many(collection, {"k": None}).collect()] == ["04"]
    assert docs.find_one(collection, {"k": "x"}).first()._id == "01"
    assert docs.find_one(collection, {"k": "z"}).count() == 0


def test_update_one_and_delete_one(collection):
    updated = docs.update_one(collection, {"k": "x"}, {"k": "new"})
    assert {r._id: r.k for r in updated.collect()} == {"01": "new", "02": "y", "03": "x", "04": None}
    assert docs.update_one(collection, {"k": "z"}, {"k": "new"}).where("k = 'new'").count() == 0
    assert [r._id for r in docs.delete_one(collection, {"k": "x"}).orderBy("_id").collect()] == ["02", "03", "04"]
    assert docs.delete_one(collection, {"k": "z"}).count() == 4
    assert [docs.count_matched(collection, {"k": k}).first().n for k in ("x", "z")] == [1, 0]


def test_inserted_ids_are_unique(spark):
    same = spark.range(0, 50, 1, 4).select(F.lit("same").alias("t"))
    both = docs.with_ids(same, 1).unionByName(docs.with_ids(same, 2))
    assert both.select("_id").distinct().count() == 100
