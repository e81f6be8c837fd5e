"""Event tables: every batch once whatever fails in between, and readers that open only what they need."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidecast.functions.sentiment import inline_lexicon, score_sentiment
from tidecast.plans import history
from tidecast.sources.messages import message_stream
from tidecast.streaming import jobs, tables
from tidecast.streaming.tables import EventTable
from tidecast.streaming.windows import flat_windows, sentiment_windows
from tidecast.workspace import subfolders

DAY0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
NOW = {"availableNow": True}


def at(hours):
    return DAY0 + datetime.timedelta(hours=hours)


def batch(spark, *hours):
    return spark.createDataFrame([(None if h is None else at(h), str(h)) for h in hours], "event_ts timestamp, name string")


def names(rows):
    return sorted(r.name for r in rows.collect())


@pytest.fixture
def table(spark, tmp_path):
    table = EventTable(spark, str(tmp_path / "t"), "event_ts")
    for k, hours in enumerate([(1, 2), (3, 25), (26, None), (50, 51), ()]):
        table.write(batch(spark, *hours), k, "r")
    return table


def test_every_batch_is_read_once(spark, table):
    assert names(table.read()) == sorted(["1", "2", "3", "25", "26", "None", "50", "51"])
    table.write(batch(spark, 99), 2, "r")  # a batch that is there is not replaced
    table.write(batch(spark, 7), 2, "other run")
    assert names(table.read()) == sorted(["1", "2", "3", "7", "25", "26", "None", "50", "51"]) and table.newest() == at(51)


@pytest.mark.parametrize("step", ["staging", "moving", "logging"])
def test_a_batch_goes_on_where_it_failed(spark, table, monkeypatch, step):
    def fail(*args, **more):
        raise RuntimeError("down")

    with monkeypatch.context() as broken:
        if step == "staging":
            broken.setattr(tables, "make_folder", fail)
        elif step == "moving":
            broken.setattr(tables, "move_folder", fail)
        else:
            broken.setattr(EventTable, "_log", fail)
        with pytest.raises(RuntimeError):
            table.write(batch(spark, 60, 61), 5, "r")
    assert "60" not in names(table.read())  # half a commit is in no answer
    table.write(batch(spark, 60, 61), 5, "r")
    assert names(table.read(at(60))) == ["60", "61"] and not subfolders(spark, f"{table.root}/_staging")


def test_readers_open_only_what_can_hold_the_times(spark, table):
    recent = table.read(since=at(50))
    assert names(recent) == ["50", "51"] and len(recent.inputFiles()) == 1 and len(table.read().inputFiles()) >= 5
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan.split("PartitionFilters")[1] and "GreaterThanOrEqual(event_ts" in plan
    assert names(table.read(until=at(3))) == ["1", "2", "3"] and names(table.read(at(2), at(25))) == ["2", "25", "3"]
    assert table.read(since=at(999)).count() == 0 and table.read(since=at(999)).columns == ["event_ts", "name"]


def test_periods_do_not_depend_on_the_session_zone(spark, tmp_path):
    table = EventTable(spark, str(tmp_path / "t"), "event_ts")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        table.write(batch(spark, 20), 0, "r")  # the next day in Tokyo
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert names(table.read(at(19))) == ["20"] and names(table.read(at(20), at(20))) == ["20"] and table.newest() == at(20)


def test_merged_tables_hold_the_same_rows(spark, table):
    before = names(table.read())
    assert table.merge(before=datetime.date(2024, 1, 3)) == 4  # two folders of each of the first two days
    assert names(table.read()) == before and table.merge(before=datetime.date(2024, 1, 3)) == 0
    assert len(table.read(until=at(30)).inputFiles()) == 2
    table.fold_log()
    assert len(subfolders(spark, f"{table.root}/_log")) == 1 and names(table.read()) == before
    table.write(batch(spark, 88), 3, "r")  # still known after the fold
    assert names(table.read()) == before
    table.write(batch(spark, 4), 5, "r")
    assert table.merge() == 2 and names(table.read()) == sorted([*before, "4"])
    table.fold_log()
    assert names(table.read()) == sorted([*before, "4"])
    assert table.vacuum(datetime.timedelta(hours=1)) == 0
    assert table.vacuum(datetime.timedelta(0)) > 0 and names(table.read()) == sorted([*before, "4"])


def test_an_unfinished_fold_changes_nothing(spark, table, monkeypatch):
    before = names(table.read())
    table.merge()
    with monkeypatch.context() as broken:
        broken.setattr(tables, "remove_folder", lambda *a: (_ for _ in ()).throw(RuntimeError("down")))
        with pytest.raises(RuntimeError):
            table.fold_log()
    assert names(table.read()) == before
    table.fold_log()
    assert names(table.read()) == before and len(subfolders(spark, f"{table.root}/_log")) == 1


def test_followers_see_each_batch_once_and_no_merge(spark, table, tmp_path):
    def follow():
        query = table.follow(2).writeStream.trigger(**NOW).format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out"))
        query.awaitTermination()
        return names(spark.read.parquet(str(tmp_path / "out")))

    before = names(table.read())
    assert follow() == before
    table.merge()
    table.write(batch(spark, 70), 9, "r")
    assert follow() == sorted([*before, "70"])


def test_nothing_committed(spark, tmp_path):
    table = EventTable(spark, str(tmp_path / "none"), "event_ts")
    with pytest.raises(ValueError, match="nothing is committed"):
        table.read()
    assert table.newest() is None and table.merge() == 0
    table.fold_log()
    given = EventTable(spark, str(tmp_path / "none"), "event_ts", batch(spark).schema)
    assert given.read().count() == 0 and given.follow().isStreaming


def test_history_of_a_table(spark, tmp_path):
    table = EventTable(spark, str(tmp_path / "t"), "event_ts")
    for day in range(6):
        rows = [(at(24 * day + h), r, h, 1.5) for h in range(3) for r in "BA"]
        table.write(spark.createDataFrame(rows, "event_ts timestamp, region string, viewers int, engagement_rate float"), day, "r")
    asof = table.newest()
    recent = table.read(asof - datetime.timedelta(hours=1))
    got = history.viewership_history(recent, asof, 1)
    assert [(r.timestamp, r.region) for r in got.collect()] == [(f"2024-01-06T0{h}:00:00", r) for h in (1, 2) for r in "AB"]
    assert "PartitionFilters: [isnotnull(event_date" in got._jdf.queryExecution().executedPlan().toString() and len(recent.inputFiles()) == 1


# --- the posts job

def post(i, text="good", **more):
    return json.dumps({"id": i and str(i), "text": text, "created_at": (DAY0 + datetime.timedelta(minutes=i or 0)).strftime("%Y-%m-%dT%H:%M:%SZ")} | more)


def send(spark, tmp_path, *values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def run_posts(spark, tmp_path, once_within=None):
    layout = jobs.Layout(str(tmp_path / "out"))
    words = inline_lexicon(spark.createDataFrame([("good", 2.0)], "token string, valence double"))
    messages = message_stream(spark, "parquet", {}, str(tmp_path / "in"))
    query = jobs.start_posts(messages, lambda df: score_sentiment(df, "text", words), layout, NOW, once_within)
    query.awaitTermination()
    return layout, query


@pytest.mark.parametrize("fail_at", ["posts", "post_rejects"])
@pytest.mark.parametrize("step", ["_place", "_log"])
def test_posts_and_rejects_come_from_one_pass_and_survive_failures(spark, tmp_path, monkeypatch, fail_at, step):
    send(spark, tmp_path, post(1), post(2), "broken")
    whole = getattr(EventTable, step)

    def fail(self, *args):
        if self.root.endswith(f"/{fail_at}"):
            raise RuntimeError("down")
        return whole(self, *args)

    with monkeypatch.context() as broken:
        broken.setattr(EventTable, step, fail)
        with pytest.raises(Exception, match="down"):
            run_posts(spark, tmp_path)
    send(spark, tmp_path, post(3))
    layout, query = run_posts(spark, tmp_path)
    read = [p for p in query.recentProgress if p["numInputRows"]]
    assert sum(p["numInputRows"] for p in read) <= 4 and all(len(p["sources"]) == 1 for p in read)  # the topic's rows, no more than once
    assert sorted(r.id for r in layout.events(spark, "posts").read().collect()) == ["1", "2", "3"]
    assert [r.value for r in layout.events(spark, "post_rejects").read().collect()] == ["broken"]
    assert not [n for n in subfolders(spark, layout.table("posts")) if "spark_metadata" in n]


def test_repeated_posts_count_once_over_a_restart(spark, tmp_path):
    send(spark, tmp_path, post(1), post(1), post(None, "a"), post(None, "a"), "broken")
    run_posts(spark, tmp_path, "1 hour")
    send(spark, tmp_path, post(1, "again"), post(2), post(30), post(None, "a"), "broken")
    layout, _ = run_posts(spark, tmp_path, "1 hour")
    found = layout.events(spark, "posts").read()
    assert sorted((r.id or "-", r.text) for r in found.collect()) == [("-", "a")] * 3 + [("1", "good"), ("2", "good"), ("30", "good")]
    assert layout.events(spark, "post_rejects").read().count() == 2
    windows = {}
    sentiment_windows(jobs.scored_posts(spark, layout).where("id IS NOT NULL")).writeStream.outputMode("complete").trigger(**NOW).foreachBatch(
        lambda b, _: windows.update({r.window_start: r.avg_compound for r in flat_windows(b).collect()})).option(
        "checkpointLocation", str(tmp_path / "w")).start().awaitTermination()
    assert len(windows) == 2 and found.where(F.col("id") == "1").count() == 1
