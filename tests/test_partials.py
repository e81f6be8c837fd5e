"""Maintained sums: a batch counts once, what is written follows what has changed, and averages of sums are those of the rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import feeds, post, run_jobs  # noqa: F401
from tidecast.functions.averages import mean
from tidecast.plans import dashboard
from tidecast.streaming import jobs, tables
from tidecast.streaming.partials import Kind, PartialTable
from tidecast.streaming.windows import flat_windows, merged_windows, sentiment_windows

DAY0 = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
KIND = Kind("event_ts", ("k",), ("n",), ("x",), grain="day")
ROWS = [(1, "a", 1, 1.0), (2, "a", 2, None), (30, "a", 3, 4.0), (3, None, 4, 2.0), (None, "b", 5, 6.0), (5, "c", None, None)]


def rows(spark, values):
    return spark.createDataFrame([(None if h is None else DAY0 + datetime.timedelta(hours=h), *v) for h, *v in values],
                                 "event_ts timestamp, k string, n int, x double")


def totals(df):
    return {r.k: (r.n, r.x) for r in df.groupBy("k").agg(F.sum("n").alias("n"), mean(df, "x").alias("x")).collect()}


@pytest.fixture
def table(spark, tmp_path):
    return PartialTable(spark, str(tmp_path / "t"), KIND)


def add(table, spark, values, batch_id, run="r"):
    table.write(KIND.delta(rows(spark, values)), batch_id, run)


def test_sums_of_deltas_are_sums_of_rows(spark, table):
    for k, part in enumerate([ROWS[:2], ROWS[2:4], ROWS[4:], []]):
        add(table, spark, part, k)
    expected = {"a": (6, 2.5), None: (4, 2.0), "b": (5, 6.0), "c": (None, None)}
    assert totals(table.read()) == totals(rows(spark, ROWS)) == expected
    add(table, spark, ROWS, 1)  # repeated
    assert totals(table.read()) == expected
    add(table, spark, ROWS[:1], 1, "other run")
    assert totals(table.read())["a"] == (7, 2.0)


def test_merged_sums_are_a_row_a_key_and_period(spark, table):
    for k in range(4):
        add(table, spark, ROWS, k)
    before = totals(table.read())
    assert table.read().count() == 20  # a: two days; NULL, b, c
    assert table.merge() == 12  # two days and the rows without a time, in four batches
    assert table.read().count() == 5 and totals(table.read()) == before
    add(table, spark, ROWS, 4)
    assert totals(table.read())["a"] == (30, 2.5)


@pytest.mark.parametrize("step", ["move_folder", "_log"])
def test_a_batch_that_failed_counts_once(spark, table, monkeypatch, step):
    def fail(*args, **more):
        raise OSError(step)
    add(table, spark, ROWS, 0)
    with monkeypatch.context() as patch:
        patch.setattr(*((tables, step) if step == "move_folder" else (PartialTable, step)), fail)
        with pytest.raises(OSError):
            add(table, spark, ROWS, 1)
    assert totals(table.read())["a"] == (6, 2.5)
    add(table, spark, ROWS, 1)
    assert totals(table.read())["a"] == (12, 2.5)


def test_a_hot_key_is_a_row(spark, table):
    df = spark.range(20_000).select(F.lit(DAY0).alias("event_ts"), F.lit("a").alias("k"), F.col("id").cast("int").alias("n"), F.col("id").cast("double").alias("x"))
    table.write(KIND.delta(df), 0, "r")
    assert [(r.n, r.n_x) for r in table.read().collect()] == [(199_990_000, 20_000)]


def test_grain_is_that_of_the_folders(spark, tmp_path):
    with pytest.raises(ValueError):
        PartialTable(spark, str(tmp_path / "t"), KIND, "month")
    assert jobs.Layout(str(tmp_path), "month").sums(spark, "ad_sums").kind.grain == "month"


def complete(spark, layout):
    return {tuple(r) for r in merged_windows(layout.sums(spark, "window_sums").read()).collect()}


def test_complete_windows_write_what_has_changed(spark, tmp_path, feeds):
    layout = run_jobs(spark, tmp_path)
    table = layout.sums(spark, "window_sums")
    assert complete(spark, layout) == {tuple(r) for r in flat_windows(sentiment_windows(layout.events(spark, "posts").read())).collect()}
    first = table.live().agg(F.sum("n")).first()[0]
    assert first == 6
    feeds("posts", post(2, "good day"), post(200, "good day"))  # one is in an old window, which has long been closed
    run_jobs(spark, tmp_path)
    assert table.live().agg(F.sum("n")).first()[0] == first + 2
    assert complete(spark, layout) == {tuple(r) for r in flat_windows(sentiment_windows(layout.events(spark, "posts").read())).collect()}
    run_jobs(spark, tmp_path)  # nothing new
    assert table.live().agg(F.sum("n")).first()[0] == first + 2


def test_new_checkpoint_does_not_add_posts_again(spark, tmp_path, feeds):
    layout = run_jobs(spark, tmp_path)
    (tmp_path / "out" / "checkpoints" / "post_sums").rename(tmp_path / "gone")
    with pytest.raises(ValueError):
        jobs.start_post_sums(jobs.scored_posts(spark, layout), layout, {"availableNow": True})


def values(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_dashboards_of_sums_are_those_of_rows(spark, tmp_path, feeds):
    layout = run_jobs(spark, tmp_path)
    for visual, name, raw in [(dashboard.viewers_by_region, "viewer_sums", "regional_viewership"), (dashboard.viewers_over_time, "audience_sums", "viewership"),
                              (dashboard.card_ctr, "ad_sums", "ad_performance"), (dashboard.ad_performance_by_type, "ad_sums", "ad_performance"),
                              (dashboard.ad_cost_over_time, "cost_sums", "ad_performance"), (dashboard.card_compound, "closed_window_sums", "sentiment_windows")]:
        of_sums, of_rows = visual(layout.sums(spark, name).read()), visual(layout.events(spark, raw).read())
        assert of_sums.columns == of_rows.columns
        assert values(of_sums) == values(of_rows), name
    folders = layout.sums(spark, "ad_sums").read().inputFiles()
    assert folders and all("/ad_sums/" in f for f in folders)
