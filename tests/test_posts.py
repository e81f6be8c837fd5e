import datetime
import json

from pyspark.sql import functions as F

from tidecast.plans import feeds
from tidecast.operators import posts as ops
from tidecast.operators.posts import POST_COLUMNS

USERS = [{"id": "u1", "name": "old"}, {"id": "u2", "name": "Bo", "location": "X", "verified": True},
         {"id": "u1", "name": "Al", "username": "al"}]
POSTS = [{"id": "1", "text": "The Cup", "created_at": "2024-01-01T00:00:00Z", "author_id": "u1", "lang": "en",
          "public_metrics": {"like_count": 3}},
         {"id": "2", "text": "none", "created_at": "2024-01-01T00:00:01Z", "author_id": "u2"},
         {"id": "3", "text": "cupboard", "created_at": "2024-01-01T00:00:02Z", "author_id": "nobody", "lang": None}]


def test_normaliser(messages):
    df = messages(json.dumps({"data": POSTS, "includes": {"users": USERS}}))
    out = ops.normalize_posts(df, ["Cup"])
    assert out.columns == POST_COLUMNS
    one, two, three = out.orderBy("id").collect()
    assert (one.user.name, one.user.username, one.user.location, one.user.verified) == ("Al", "al", "", False)
    assert (one.lang, one.metrics, one.keywords, one.source) == ("en", {"like_count": 3}, ["Cup"], "twitter")
    assert (two.lang, two.metrics, two.keywords, two.user.verified) == ("unknown", {}, [], True)
    assert (three.user.id, three.user.name, three.lang, three.keywords) == ("", "", "unknown", ["Cup"])
    assert datetime.datetime.fromisoformat(one.processed_at)


def test_guard(messages):
    df = messages(json.dumps({"data": POSTS}), json.dumps({"includes": {"users": USERS}}),
                  json.dumps({"data": POSTS, "includes": {}}), json.dumps({"errors": []}), "broken", None)
    assert ops.normalize_posts(df, []).count() == 0


def test_same_author_key_in_two_responses_stays_apart(messages):
    other = [{"id": "u1", "name": "Other"}]
    df = messages(json.dumps({"data": POSTS[:1], "includes": {"users": USERS}}),
                  json.dumps({"data": POSTS[:1], "includes": {"users": other}}))
    assert {r.user.name for r in ops.normalize_posts(df, []).collect()} == {"Al", "Other"}


def test_author_join_takes_the_last_entry_and_survives_a_hot_author(spark):
    posts = spark.range(3000).select(F.col("id").cast("string").alias("id"),
                                     F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("author_id"))
    users = spark.createDataFrame([("hot", "old", 1), ("hot", "new", 2), ("1", "one", 1)], "id string, name string, n int")
    out = ops.join_authors(posts, users, "n")
    assert out.count() == 3000
    assert out.where("user.name = 'new'").count() == 1000
    assert out.where("user is null").count() == 1999


def test_recent_keywords_and_cap(spark):
    asof = datetime.datetime(2024, 1, 1, 12)
    rows = [(str(i), asof - datetime.timedelta(minutes=i), "Cup" if i % 2 else "x") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, created_ts timestamp, text string")
    assert ops.filter_recent(df, "created_ts", asof).count() == 16
    assert ops.filter_keywords(df, "text", ["cup"]).count() == 20
    assert [r.id for r in ops.newest(df, limit=3).collect()] == ["0", "1", "2"]
    assert ops.newest(df).count() == 40


def test_documents_without_an_event_are_posts_too(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("documents", "events", "customer", "nation", "region"):
        rows = spark.read.parquet(f"{source}/{name}.parquet")
        (rows.where("event_id % 3 <> 0") if name == "events" else rows).write.parquet(str(tmp_path / f"{name}.parquet"))
    posts = feeds.raw_posts(spark, str(tmp_path))
    assert posts.count() == spark.read.parquet(f"{source}/documents.parquet").count()
    lone = posts.where("doc_id % 3 = 0").first()
    assert (lone.event_type, lone.author_id, lone.created_at) == ("none", "0", "2024-01-01T00:00:00.000000Z")
    assert posts.where("doc_id % 3 = 1 AND event_type = 'none'").count() == 0


def odd_tables(spark, folder):
    """Documents and events whose numbers repeat or are missing, and two customers."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")

    put("documents", [(1, "one", "en", 3), (1, "one again", "de", 9), (2, "two", "fr", 3), (None, "lost", "en", 4), (None, None, None, None), (7, "quiet", "es", 5)],
        "doc_id long, text string, lang string, n_chars long")
    at = datetime.datetime(2024, 1, 1, 12)
    put("events", [(1, at, 5, "click"), (1, at + datetime.timedelta(hours=1), 6, "view"), (2, at, 5, "error"), (None, at, 6, "view"), (9, at, 6, "view"), (7, None, 5, None)],
        "event_id long, ts timestamp, user_id long, event_type string")
    put("customer", [(5, "Customer#5", 0, 6000.0, "A"), (0, "Customer#0", 0, 1.0, "B")], "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string")
    put("nation", [(0, "N", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("region", [(0, "ASIA")], "r_regionkey long, r_name string")
    return str(folder)


def test_posts_with_authors_are_the_plain_joins_of_odd_numbers(spark, tmp_path):
    folder = odd_tables(spark, tmp_path)
    found = feeds.posts_with_authors(spark, folder)
    plain = ops.join_authors(feeds.raw_posts(spark, folder), feeds.user_versions(spark, folder), "version")

    def listed(posts):
        return sorted(r.j for r in posts.select(F.to_json(F.struct(*sorted(plain.columns))).alias("j")).collect())
    assert found.count() == 4 + 1 + 2 + 1
    assert found.where("user.id = '0'").count() == 2
    assert listed(found) == listed(plain)


def test_a_text_is_shuffled_once_and_never_sorted_for_its_author(spark, tmp_path):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        posts = feeds.post_messages(spark, odd_tables(spark, tmp_path))
        plan = posts._jdf.queryExecution().executedPlan()
        nodes = [plan.initialPlan()]
        moved, sorts = 0, 0
        while nodes:
            node = nodes.pop()
            nodes += [node.children().apply(k) for k in range(node.children().size())]
            if "text#" in node.output().mkString(","):
                moved += "Exchange" in node.nodeName()
                sorts += node.nodeName() == "Sort"
        assert (moved, sorts) == (1, 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
