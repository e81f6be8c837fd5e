"""Message feeds derived from the benchmark tables, for the registered queries and the tests.

Each feed is computed by Spark from whole tables and written once per session as messages, one JSON document
per row, the way a topic's archive would hold them.  Sums are of whole numbers, so they are exact.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidecast.functions.sentiment import classifier_score
from tidecast.functions.text import strip_markup, tokens
from tidecast.operators.ad_metrics import click_through_rate, cost_per_conversion
from tidecast.operators.posts import finish_posts, join_authors
from tidecast.schemas import POST
from tidecast.workspace import new_folder

KEYWORDS = ["the", "Der", "LA"]
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "on"]
# "on" is in both lists on purpose: the stop list wins.
LEXICON = [("er", 1.9), ("nd", -2.1), ("ha", 2.7), ("th", -1.5), ("re", 0.8), ("on", -0.6), ("ea", 1.1), ("un", -1.0)]
RESOLUTIONS = ["480p", "720p", "1080p", "1440p", "4K"]
ENVELOPE_SIZE = 2
#: Time, author and type of a post whose document has no event.
NO_EVENT = {"created_ts": "2024-01-01 00:00:00", "user_id": 0, "event_type": "none"}

_written: dict[tuple[str, str, str], str] = {}
_writing = threading.RLock()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder of a derived data set; ``write(folder)`` runs the first time it is asked for."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _writing:
        if key not in _written:
            folder = new_folder(spark, name)
            write(folder)
            _written[key] = folder
        return _written[key]


def message_feed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of a message feed: ``posts``, ``envelopes``, ``viewership`` or ``ads``."""
    build = {
        "posts": post_messages, "envelopes": envelope_messages,
        "viewership": viewership_messages, "ads": ad_messages,
    }[name]
    # The join of the texts deals posts out by their size, so these are not shuffled again.
    dealt = (lambda rows: rows) if name == "posts" else spread
    return derived(spark, sf_dir, f"feed-{name}", lambda folder: dealt(build(spark, sf_dir)).write.parquet(folder))


def spread(rows: DataFrame) -> DataFrame:
    """Give a feed from a few files at least a file per core, as a topic has several partitions."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if len(rows.inputFiles()) >= cores else rows.repartition(cores)


def messages_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


# --- viewership and advertising ---------------------------------------------------------------------------


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-number sums per day, market segment, region and order priority.

    Line items are summed per order first: the join then reuses that shuffle, on fewer rows.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
        F.count("*").alias("n"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    homes = customer_regions(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "r_name")
    return lines.join(orders, "o_orderkey").join(homes, "o_custkey").groupBy(
        F.col("o_orderdate").cast("timestamp").alias("d"), F.col("c_mktsegment").alias("typ"),
        F.col("r_name").alias("region"), F.col("o_orderpriority").alias("plat"),
    ).agg(F.sum("q").alias("q"), F.sum("n").alias("n"), F.sum("cents").alias("cents"))


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return table(spark, sf_dir, "customer").join(nations, "c_nationkey").join(regions, "n_regionkey")


def sales_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = derived(spark, sf_dir, "sales", lambda out: sales(spark, sf_dir).write.parquet(out))
    return spark.read.parquet(folder)


def day_text() -> Column:
    return F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")


def viewership_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per day.  Its lists are as long as there are regions and priorities, five of each."""
    base = sales_folder(spark, sf_dir)

    def breakdown(key: str, entry: Column, name: str) -> DataFrame:
        per_key = base.groupBy("d", key).agg(F.sum("q").cast("int").alias("viewers"))
        return per_key.groupBy("d").agg(F.sort_array(F.collect_list(entry)).alias(name))

    viewers = F.col("viewers")
    rate = (F.lit(5.0) + (viewers % 1000) / F.lit(100.0)).cast("float")
    buffering = (F.lit(0.1) + (viewers % 490) / F.lit(100.0)).cast("float")
    resolution = F.get(F.array(*[F.lit(r) for r in RESOLUTIONS]), viewers % 5)
    regional = F.struct("region", "viewers", rate.alias("engagement_rate"))
    platform = F.struct(F.col("plat").alias("platform"), "viewers", buffering.alias("buffer_rate"),
                        resolution.alias("avg_resolution"))
    totals = base.groupBy("d").agg(F.sum("q").cast("int").alias("total_viewers"))
    joined = totals.join(breakdown("region", regional, "regional_data"), "d") \
        .join(breakdown("plat", platform, "platform_data"), "d")
    return messages_of(joined.select(day_text(), "total_viewers", "regional_data", "platform_data"))


def ad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per day, with an ad per market segment and its regions, five of each."""
    base = sales_folder(spark, sf_dir)
    ctr = click_through_rate(F.col("clicks"), F.col("impressions")).cast("float").alias("ctr")
    impressions = F.sum(F.expr("cents div 1000")).cast("int").alias("impressions")
    clicks = F.sum("q").cast("int").alias("clicks")
    regions = base.groupBy("d", "typ", "region").agg(impressions, clicks) \
        .groupBy("d", "typ").agg(F.sort_array(F.collect_list(F.struct("region", "impressions", "clicks", ctr)))
                                 .alias("regions"))
    cost = (F.sum("cents") / F.lit(100.0)).cast("float").alias("cost")
    ads = base.groupBy("d", "typ").agg(impressions, clicks, cost, F.sum("n").cast("int").alias("conversions")) \
        .join(regions, ["d", "typ"])
    per_conversion = cost_per_conversion(F.col("cost"), F.col("conversions")).cast("float")
    ad = F.struct(F.col("typ").alias("type"), "impressions", "clicks", ctr, "cost", "conversions",
                  per_conversion.alias("cost_per_conversion"), "regions")
    days = ads.groupBy("d").agg(F.sort_array(F.collect_list(ad)).alias("ads"))
    return messages_of(days.select(day_text(), "ads"))


def campaign_folder(spark: SparkSession, sf_dir: str) -> str:
    """Campaign files: one line per day, an array with a record per market segment."""
    def write(folder: str) -> None:
        records = sales_folder(spark, sf_dir).groupBy("d", "typ").agg(
            F.sum(F.expr("cents div 1000")).alias("impressions"), F.sum("q").alias("clicks"),
            (F.sum("cents") / F.lit(100.0)).alias("cost"), F.sum("n").alias("conversions"),
        )
        record = F.struct(F.col("typ").alias("campaign"), "impressions", "clicks", "cost", "conversions",
                          F.date_format("d", "yyyy-MM-dd").alias("date"))
        lines = records.groupBy("d").agg(F.to_json(F.collect_list(record)).alias("line"))
        lines.select("line").write.text(folder)
    return derived(spark, sf_dir, "campaigns", write)


def campaign_array_folder(spark: SparkSession, sf_dir: str) -> str:
    """The campaign files in their other layout: each file is one array over many lines, and a record takes several of them."""
    def array(batches):
        first = "["
        for batch in batches:
            if len(batch):
                lines = [(first if k == 0 else ",") + day for k, day in enumerate(batch.column(0).to_pylist())]
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                first = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]" if first == "," else "[]"])], names=["value"])

    def write(folder: str) -> None:
        inner = F.expr("substr(value, 2, length(value) - 2)")
        apart = F.regexp_replace(inner, r'(?<=[,{])"', '\n  "')
        spark.read.text(campaign_folder(spark, sf_dir)).select(apart.alias("value")).mapInArrow(array, "value string").write.text(folder)

    return derived(spark, sf_dir, "campaign-arrays", write)


# --- posts ------------------------------------------------------------------------------------------------


def documents_of_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")


def with_events(spark: SparkSession, sf_dir: str, documents: DataFrame) -> DataFrame:
    """Time, author and type of the posts: those of the event of a document's number, or of `NO_EVENT`."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("created_ts"), "user_id", "event_type")
    rows = documents.join(events, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(v).cast(events.schema[c].dataType)) for c, v in NO_EVENT.items()})
    user, lost = F.col("user_id").cast("string"), F.col("event_type") == "error"
    return rows.withColumn("author_id", F.when(lost, F.concat(F.lit("gone"), user)).otherwise(user))


def post_rows(rows: DataFrame, *more: str) -> DataFrame:
    """Posts from documents with their events, and ``more`` columns."""
    user, lost = F.col("user_id").cast("string"), F.col("event_type") == "error"
    text = F.concat(F.lit("RT @user"), user, F.lit(" https://t.co/"), F.col("doc_id").cast("string"),
                    F.lit(" #Été_"), F.col("event_type"), F.lit(" "), F.col("text"))
    metrics = F.create_map(F.lit("like_count"), (F.col("n_chars") % 1000).cast("int"),
                           F.lit("retweet_count"), (F.col("n_chars") % 97).cast("int"))
    return rows.select(
        "doc_id", F.col("doc_id").cast("string").alias("id"), text.alias("text"),
        F.concat(F.date_format("created_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("created_at"),
        "created_ts", F.when(~lost, F.col("lang")).alias("lang"), "author_id",
        F.when(~lost, metrics).alias("metrics"), "event_type", *more,
    )


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document; the event of the same number gives time, author and type.  A document without one has those of `NO_EVENT`.

    Posts of type "error" have no language, and an author nobody knows.  Events without a document are no posts: they have no text.
    """
    return post_rows(with_events(spark, sf_dir, documents_of_posts(spark, sf_dir)))


def user_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as a user, twice: an outdated entry without a location, then the current one."""
    current = customer_regions(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("_"))).alias("username"),
        F.col("r_name").alias("location"), (F.col("c_acctbal") > 5000).alias("verified"),
        F.lit("").alias("profile_image_url"),
    )
    version = F.explode(F.array(F.lit(0), F.lit(1))).alias("version")
    return current.select("*", version).withColumn(
        "location", F.when(F.col("version") == 1, F.col("location")).otherwise(F.lit("")))


def posts_with_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same posts with their authors.

    Events and authors are joined for the numbers of documents alone, so a text is shuffled once, and hashing the small side leaves the texts unsorted.
    """
    documents = documents_of_posts(spark, sf_dir)
    numbers = with_events(spark, sf_dir, documents.select("doc_id").distinct())
    known = join_authors(numbers, user_versions(spark, sf_dir), "version").withColumnRenamed("doc_id", "number").hint("shuffle_hash")
    return post_rows(documents.join(known, F.col("doc_id").eqNullSafe(F.col("number"))), "user")


def post_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in their contract."""
    posts = posts_with_authors(spark, sf_dir)
    return messages_of(finish_posts(posts, KEYWORDS).select(*[f.name for f in POST.fields]))


def envelope_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search responses of a few posts each, numbered consecutively, so a response never holds more.

    A response none of whose authors is known has no users part.
    """
    posts = raw_posts(spark, sf_dir).withColumn("envelope", F.expr(f"doc_id div {ENVELOPE_SIZE}"))
    users = user_versions(spark, sf_dir)
    fields = ["id", "name", "username", "location", "verified", "profile_image_url"]
    entry = F.struct("version", *fields)
    included = posts.select("envelope", F.col("author_id").alias("id")).distinct().join(users, "id") \
        .groupBy("envelope").agg(F.sort_array(F.collect_list(entry)).alias("entries")) \
        .select("envelope", F.struct(F.transform("entries", lambda e: F.struct(*[e[f].alias(f) for f in fields]))
                                     .alias("users")).alias("includes"))
    post = F.struct("doc_id", "id", "text", "created_at", "lang", "author_id",
                    F.col("metrics").alias("public_metrics"))
    by_number = lambda a, b: F.signum(a["doc_id"] - b["doc_id"]).cast("int")
    listed = posts.groupBy("envelope").agg(F.array_sort(F.collect_list(post), by_number).alias("data"))
    return messages_of(listed.join(included, "envelope", "left").select(
        F.transform("data", lambda p: p.dropFields("doc_id")).alias("data"), "includes"))


# --- sentiment inputs -------------------------------------------------------------------------------------


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "token string, valence double")


def benchmark_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger word list: every word of the benchmark passages, with a valence from its length."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(tokens(strip_markup(F.col("text")))).alias("token"))
    valence = ((F.length("token") % 9) - 4) / F.lit(2.0)
    return words.distinct().select("token", valence.alias("valence"))


def classifier_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier answers for the labelled documents, as (id, label, score)."""
    label = F.when(F.col("toxic") == 0, F.lit("POSITIVE")).otherwise(F.lit("NEGATIVE"))
    score = F.when(F.col("quality") == 1, F.lit(0.9)).otherwise(F.lit(0.6))
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), label.alias("label"), score.alias("score"))


def oriented_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as (id, h): 1 means positive."""
    return classifier_scores(spark, sf_dir).select(
        "id", classifier_score(F.col("label"), F.col("score")).alias("h"))
