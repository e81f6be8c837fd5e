"""Results that must not depend on sizes, checkpoints or the order of batches."""

import json

import pytest
from pyspark.sql import functions as F

from tidecast.functions.rounding import round_half_up
from tidecast.functions.sentiment import classifier_column, inline_lexicon, lexicon_sentiment, lexicon_sentiment_joined, score_sentiment
from tidecast.operators import collections as store
from tidecast.operators.posts import dedup_posts
from tidecast.plans import registry
from tidecast.sources.messages import message_stream
from tidecast.streaming import jobs
from tidecast.streaming.sinks import StateTable, read_batches


def test_large_values_round_to_themselves(spark):
    values = [1e13, -1e13, 1e300, 2.0**52, 0.125, -0.125, 1234567.891, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.r for r in df.select(round_half_up(F.col("v"), 2).alias("r")).collect()] == [1e13, -1e13, 1e300, 2.0**52, 0.13, -0.12, 1234567.89, None]


def test_delete_and_update_touch_one_row_with_a_key(spark):
    long = "1234567890123456789012"
    rows = [(long, "x"), (long[:20] + "99", "x"), (None, "x"), (None, "y")]
    docs = spark.createDataFrame(rows, "_id string, k string")
    assert store.delete_one(docs, {"k": "x"}).count() == 3
    assert store.delete_one(docs, {"k": "y"}).count() == 4
    assert store.update_one(docs, {"k": "x"}, {"k": "z"}).where("k = 'z'").count() == 1
    key = registry.tweet_collection.__code__.co_consts
    assert "%010d%s" in key


def test_lexicon_of_any_size_scores_alike(spark):
    lexicon = spark.range(60_000).select(F.concat(F.lit("w"), F.col("id")).alias("token"), ((F.col("id") % 9) - 4.0).alias("valence"))
    texts = spark.createDataFrame([("w1 w59999 w7 nothing",), ("",), (None,), ("w8 w8",)], "text string")
    joined = sorted(lexicon_sentiment_joined(texts, "text", lexicon).collect(), key=str)
    inline = sorted(lexicon_sentiment(texts, "text", inline_lexicon(lexicon, max_entries=100_000)).collect(), key=str)
    assert joined == inline
    with pytest.raises(ValueError):
        inline_lexicon(lexicon)
    assert score_sentiment(texts, "text", lexicon).count() == 4


def test_joined_lexicon_on_a_stream_inside_foreach_batch(spark, tmp_path):
    spark.createDataFrame([("good day",), ("bad day",)], "text string").write.parquet(str(tmp_path / "in"))
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        score_sentiment(stream, "text", lexicon)

    def write(batch, batch_id):
        score_sentiment(batch, "text", lexicon).write.mode("overwrite").parquet(str(tmp_path / f"out/{batch_id}"))

    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).foreachBatch(write).start().awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out/0")).collect()
    assert {r.text: r.sentiment.compound > 0 for r in rows} == {"good day": True, "bad day": False}


def test_classifier_sees_a_bounded_number_of_pieces(spark):
    def make():
        def classify(texts):
            assert len(texts) <= 3
            return ["POSITIVE"] * len(texts), [len(t) / 10 for t in texts]
        return classify

    df = spark.createDataFrame([("a" * 95,), ("b" * 4,), (None,)], "t string").coalesce(1)
    got = [r.h for r in df.select(classifier_column(F.col("t"), make, max_chars=10, pieces_per_call=3).alias("h")).collect()]
    assert got[:2] == pytest.approx([(90 * 1.0 + 5 * 0.5) / 95, 0.4]) and got[2] is None


def ad(day, n):
    return json.dumps({"timestamp": f"2024-01-{day:02d}T00:00:00Z", "ads": [{"type": f"t{day}", "impressions": n, "clicks": 1, "cost": 1.0, "conversions": 1, "regions": []}]})


def post(k):
    return json.dumps({"id": str(k), "text": "good", "created_at": f"2024-01-01T00:{k:02d}:00Z"})


def run(spark, layout, folder):
    words = inline_lexicon(spark.createDataFrame([("good", 2.0)], "token string, valence double"))
    topics = {t: message_stream(spark, "parquet", {}, f"{folder}/{t}") for t in ("posts", "viewership", "ads")}
    jobs.run_available(spark, topics, lambda df: score_sentiment(df, "text", words), layout)


def feed(spark, folder, **topics):
    for name in ("posts", "viewership", "ads"):
        spark.createDataFrame([(v,) for v in topics.get(name, [])], "value string").coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


class Moved(jobs.Layout):
    """The same tables and state under new checkpoints."""

    def checkpoint(self, job):
        return f"{self.root}/moved/{job}"


def test_new_checkpoint_loses_nothing(spark, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    feed(spark, first, ads=[ad(2, 10)])
    layout = jobs.Layout(str(tmp_path / "out"))
    jobs.start_ads(message_stream(spark, "parquet", {}, f"{first}/ads"), layout, {"availableNow": True}).awaitTermination()
    feed(spark, second, ads=[ad(3, 20)])
    for _ in range(2):  # the second start finds nothing new
        jobs.start_ads(message_stream(spark, "parquet", {}, f"{second}/ads"), Moved(layout.root), {"availableNow": True}).awaitTermination()
    assert sorted(r.timestamp[:10] for r in read_batches(spark, layout.table("ads")).collect()) == ["2024-01-02", "2024-01-03"]
    state = {(r.path, r.key): json.loads(r.value_json) for r in StateTable(spark, layout.state("ads")).read().collect()}
    assert ("ads/ads", "t3") in state and ("ads/ads", "t2") not in state


def test_posts_refuse_a_new_checkpoint(spark, tmp_path):
    folder, layout = str(tmp_path / "in"), jobs.Layout(str(tmp_path / "out"))
    feed(spark, folder, posts=[post(1), post(2)])
    run(spark, layout, folder)
    run(spark, layout, folder)  # a restart is no new checkpoint
    assert spark.read.parquet(layout.table("posts")).count() == 2
    with pytest.raises(ValueError):
        jobs.start_posts(message_stream(spark, "parquet", {}, f"{folder}/posts"), lambda df: df, Moved(layout.root), {"availableNow": True})


def test_late_ads_change_neither_list_nor_stamp(spark, tmp_path):
    folder, layout = str(tmp_path / "in"), jobs.Layout(str(tmp_path / "out"))
    for day in (2, 1):
        feed(spark, folder, ads=[ad(day, 10)])
        jobs.start_ads(message_stream(spark, "parquet", {}, f"{folder}/ads"), layout, {"availableNow": True}).awaitTermination()
    state = {(r.path, r.key): json.loads(r.value_json) for r in StateTable(spark, layout.state("ads")).read().collect()}
    assert ("ads/ads", "t2") in state and ("ads/ads", "t1") not in state and state["ads", "timestamp"].startswith("2024-01-02")


def test_state_of_a_new_run_follows_the_newest(spark, tmp_path):
    def rows(v):
        return spark.createDataFrame([("p", "k", v, None, 0)], "path string, key string, value_json string, updated_at timestamp, batch_id long")

    old, new = (StateTable(spark, str(tmp_path / "s"), run=r) for r in ("old", "new"))
    old.commit(rows("1"), 40)
    assert new.read(before=0).first().value_json == "1"
    new.commit(rows("2"), 0)
    assert old.read().first().value_json == new.read().first().value_json == "2"
    new.commit(rows("3"), 0)
    assert new.read().first().value_json == "3" and new.read(before=0).first().value_json == "1"


def test_dedup(spark, tmp_path):
    rows = [("1", "2024-01-01 00:00:00"), ("1", "2024-01-01 00:00:00"), ("2", "2024-01-01 00:01:00"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "id string, at string").withColumn("created_ts", F.to_timestamp("at"))
    assert dedup_posts(df).count() == 4
    df.where("id is not null").write.parquet(str(tmp_path / "in"))
    stream = dedup_posts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    stream.writeStream.trigger(availableNow=True).format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2"]


def test_dedup_keeps_posts_without_an_id_on_a_stream(spark, tmp_path):
    rows = [("1", "a", "2024-01-01 00:00:00"), ("1", "a", "2024-01-01 00:00:00"), (None, "b", "2024-01-01 00:01:00"), (None, "c", "2024-01-01 00:01:00"), (None, "d", None)]
    df = spark.createDataFrame(rows, "id string, text string, at string").withColumn("created_ts", F.to_timestamp("at"))
    df.write.parquet(str(tmp_path / "in"))
    stream = dedup_posts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    stream.writeStream.trigger(availableNow=True).format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out")).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c", "d"]
