import datetime
import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidecast.functions.sentiment import inline_lexicon, score_sentiment
from tidecast.operators import flatten
from tidecast.operators.posts import normalize_posts
from tidecast.sources.messages import message_batch, message_stream, parse_posts, parse_viewership
from tidecast.streaming import jobs
from tidecast.streaming.sinks import StateTable, batch_writer, fan_out, read_batches, write_batch
from tidecast.streaming.windows import flat_windows, sentiment_windows

NOW = {"availableNow": True}
START = datetime.datetime(2024, 1, 1)
SCORE = "named_struct('positive', float(id), 'neutral', 0f, 'negative', 0f, 'compound', 0f)"


def write_minutes(spark, folder, rows):
    df = spark.createDataFrame([(i, START + datetime.timedelta(minutes=m)) for i, m in rows], "id int, created_ts timestamp")
    df.coalesce(1).write.mode("append").parquet(folder)


def run_minutes(spark, tmp_path, mode, write):
    stream = spark.readStream.schema("id int, created_ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    scored = stream.selectExpr("created_ts", f"{SCORE} AS sentiment")
    query = sentiment_windows(scored).writeStream.outputMode(mode).trigger(**NOW).foreachBatch(write) \
        .option("checkpointLocation", str(tmp_path / mode)).start()
    query.awaitTermination()
    return query


# One file per batch; ids 4 and 8 come after their window has been closed.
BATCHES = [[(1, 1), (2, 6)], [(3, 30)], [(5, 31)], [(4, 2), (6, 24), (8, 18)], [(7, 60)]]


def test_late_rows(spark, tmp_path):
    for batch in BATCHES:
        write_minutes(spark, str(tmp_path / "in"), batch)
        time.sleep(1.1)
    out = str(tmp_path / "out")
    run_minutes(spark, tmp_path, "append", batch_writer(out, flat_windows))
    got = {(r.window_start - START).seconds // 60: r.avg_positive for r in read_batches(spark, out).collect()}
    assert got == {0: 1.0, 5: 2.0, 20: 6.0, 30: 4.0}
    last = {}
    run_minutes(spark, tmp_path, "complete", lambda b, i: last.update({r.window.start: r.avg_positive for r in b.collect()}))
    assert {(k - START).seconds // 60: v for k, v in last.items()} == {0: 2.5, 5: 2.0, 15: 8.0, 20: 6.0, 30: 4.0, 60: 7.0}


def test_batch_written_twice_counts_once(spark, tmp_path):
    table = str(tmp_path / "t")
    for batch_id in (0, 1, 1):
        write_batch(spark.range(10 * (batch_id + 1)), table, batch_id, sort_by=["id"])
    assert read_batches(spark, table).count() == 30
    assert read_batches(spark, table).columns == ["id"]


def viewership(i, total):
    return json.dumps({"timestamp": (START + datetime.timedelta(minutes=i)).isoformat(), "total_viewers": total,
                       "regional_data": [{"region": r, "viewers": total // 2, "engagement_rate": 1.5} for r in "ab"],
                       "platform_data": [{"platform": "p", "viewers": total, "buffer_rate": 0.5, "avg_resolution": "4K"}]})


def ad(i, n):
    return json.dumps({"timestamp": (START + datetime.timedelta(minutes=i)).isoformat(), "ads": [
        {"type": t, "impressions": n, "clicks": 1, "ctr": 1.0, "cost": 2.0, "conversions": 1, "cost_per_conversion": 2.0,
         "regions": [{"region": "a", "impressions": n, "clicks": 1, "ctr": 1.0}]} for t in ("x", "y")[:1 + n % 2]]})


def post(i, text):
    return json.dumps({"id": str(i), "text": text, "lang": "en",
                       "created_at": (START + datetime.timedelta(minutes=i)).isoformat() + "Z"})


@pytest.fixture
def feeds(spark, tmp_path):
    def add(topic, *values):
        spark.createDataFrame([(v,) for v in values], "value string").write.mode("append").parquet(str(tmp_path / "in" / topic))
    add("posts", *[post(i, "good day" if i % 2 else "bad day") for i in range(30)], "broken")
    add("viewership", *[viewership(i, 10 + i) for i in range(6)], "broken")
    add("ads", *[ad(i, 3) for i in range(4)], "broken")
    return add


def run_jobs(spark, tmp_path):
    layout = jobs.Layout(str(tmp_path / "out"))
    words = inline_lexicon(spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double"))
    topics = {t: message_stream(spark, "parquet", {}, str(tmp_path / "in" / t)) for t in ("posts", "viewership", "ads")}
    jobs.run_available(spark, topics, lambda df: score_sentiment(df, "text", words), layout)
    return layout


def state(spark, layout, path):
    return {(r.path, r.key): json.loads(r.value_json) for r in StateTable(spark, layout.state(path)).read().collect()}


def test_jobs_end_to_end_and_restart(spark, tmp_path, feeds):
    layout = run_jobs(spark, tmp_path)

    def count(name):
        return read_batches(spark, layout.table(name)).count()

    posts = spark.read.parquet(layout.table("posts"))
    assert posts.count() == 30 and spark.read.parquet(layout.table("post_rejects")).count() == 1
    assert {(r.text, r.sentiment.compound > 0) for r in posts.collect()} == {("good day", True), ("bad day", False)}
    assert [count(n) for n in ("viewership", "regional_viewership", "platform_viewership", "viewership_rejects")] == [6, 12, 6, 1]
    assert [count(n) for n in ("ads", "ad_performance", "regional_ads", "ad_rejects")] == [4, 8, 8, 1]
    # Last post at 00:29, so the watermark is 00:19 and the windows up to 00:15 are final.
    assert count("sentiment_windows") == 3
    now = state(spark, layout, "viewership")
    assert now["viewership", "total_viewers"] == 15 and len(now["viewership", "regional_data"]) == 2
    assert state(spark, layout, "sentiment")["sentiment", "timestamp"] == "2024-01-01T00:30:00"
    ads = state(spark, layout, "ads")
    assert ads["ads", "timestamp"] == "2024-01-01T00:03:00" and ads["ads/ads", "x"]["impressions"] == 12
    assert ("ads/ads", "y") in ads

    feeds("viewership", viewership(3, 99))
    feeds("ads", ad(9, 2))
    feeds("posts", post(90, "good"))
    run_jobs(spark, tmp_path)
    assert [count(n) for n in ("viewership", "ads", "sentiment_windows")] == [7, 5, 6]
    # An older message does not replace the newest; a batch of ads replaces the list, also types it lacks.
    assert state(spark, layout, "viewership")["viewership", "total_viewers"] == 15
    ads = state(spark, layout, "ads")
    assert ads["ads/ads", "x"]["impressions"] == 2 and ("ads/ads", "y") not in ads
    assert state(spark, layout, "sentiment")["sentiment", "timestamp"] == "2024-01-01T01:35:00"


def test_continuous_jobs_may_start_in_any_order(spark, tmp_path, feeds):
    layout = jobs.Layout(str(tmp_path / "out"))
    words = inline_lexicon(spark.createDataFrame([("good", 2.0)], "token string, valence double"))
    topics = {t: message_stream(spark, "parquet", {}, str(tmp_path / "in" / t)) for t in ("posts", "viewership", "ads")}
    running = jobs.start_all(spark, topics, lambda df: score_sentiment(df, "text", words), layout, "0 seconds")
    try:
        for query in reversed(running):
            query.processAllAvailable()
        for query in running:
            query.processAllAvailable()
    finally:
        for query in running:
            query.stop()
    assert spark.read.parquet(layout.table("posts")).count() == 30
    assert read_batches(spark, layout.table("sentiment_windows")).count() == 3
    assert state(spark, layout, "sentiment")["sentiment", "timestamp"] == "2024-01-01T00:30:00"


def test_batch_without_ads_keeps_the_state(spark, tmp_path, feeds):
    run_jobs(spark, tmp_path)
    feeds("ads", "broken again")
    layout = run_jobs(spark, tmp_path)
    assert StateTable(spark, layout.state("ads")).version() == 1
    assert state(spark, layout, "ads")["ads/ads", "x"]["impressions"] == 12


def test_normaliser_runs_on_a_stream(spark, tmp_path):
    envelope = {"data": [{"id": "1", "text": "Cup", "author_id": "u"}], "includes": {"users": [{"id": "u", "name": "N"}]}}
    spark.createDataFrame([(json.dumps(envelope),)] * 3, "value string").write.parquet(str(tmp_path / "in"))
    stream = normalize_posts(message_stream(spark, "parquet", {}, str(tmp_path / "in")), ["cup"])
    stream.writeStream.trigger(**NOW).foreachBatch(batch_writer(str(tmp_path / "t"))) \
        .option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    rows = read_batches(spark, str(tmp_path / "t")).collect()
    assert [(r.user.name, r.keywords) for r in rows] == [("N", ["cup"])] * 3


def test_stream_equals_batch(spark, tmp_path, feeds):
    path = str(tmp_path / "in" / "viewership")
    stream = flatten.regional_viewership(parse_viewership(message_stream(spark, "parquet", {}, path)))
    stream.writeStream.trigger(**NOW).foreachBatch(batch_writer(str(tmp_path / "t"))) \
        .option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    batch = flatten.regional_viewership(parse_viewership(message_batch(spark, path)))
    assert sorted(read_batches(spark, str(tmp_path / "t")).collect()) == sorted(batch.collect())


def test_failing_sink_ends_the_query_and_the_batch_is_repeated(spark, tmp_path, feeds):
    table, failures = str(tmp_path / "t"), [True]

    def fail_once(batch, batch_id):
        if failures.pop() if failures else False:
            raise RuntimeError("sink is down")

    write = fan_out(lambda b: b, [batch_writer(table), fail_once])

    def run():
        message_stream(spark, "parquet", {}, str(tmp_path / "in" / "ads")).writeStream.trigger(**NOW).foreachBatch(write) \
            .option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert read_batches(spark, table).count() == 5


def test_kafka_source_is_asked_for(spark):
    with pytest.raises(Exception, match="kafka"):
        message_stream(spark, "kafka", {"kafka.bootstrap.servers": "b:9092", "subscribe": "t"})
    with pytest.raises(ValueError):
        message_stream(spark, "carrier-pigeon", {})


def test_complete_and_update_give_the_same_latest_state(spark, tmp_path, feeds):
    layout = run_jobs(spark, tmp_path)
    other = jobs.Layout(str(tmp_path / "other"))
    query = jobs.start_latest_sentiment(jobs.scored_posts(spark, layout), other, NOW, mode="complete")
    query.awaitTermination()
    assert state(spark, other, "sentiment") == state(spark, layout, "sentiment")


def test_rows_without_time_are_in_no_window(spark):
    df = spark.createDataFrame([(1, START), (2, None)], "id int, created_ts timestamp")
    windows = sentiment_windows(df.selectExpr("created_ts", f"{SCORE} AS sentiment"))
    assert [r.avg_positive for r in flat_windows(windows).collect()] == [1.0]
    assert parse_posts(spark.createDataFrame([('{"id": "1", "created_at": "?"}',)], "value string")) \
        .where(F.col("created_ts").isNull()).count() == 1
