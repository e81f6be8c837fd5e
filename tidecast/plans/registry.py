"""The registered queries: each operator over feeds derived from whole benchmark tables.

Every query takes (spark, sf_dir) and returns a flat DataFrame: nested values are spread into columns or rows,
32-bit floats are widened, times are ISO text, and averages are rounded to six decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidecast.functions.rounding import round_half_up
from tidecast.functions.sentiment import (
    classifier_column, combine_sentiment, inline_lexicon, lexicon_sentiment, lexicon_sentiment_joined, score_sentiment,
)
from tidecast.functions.text import clean_text, filtered_text, tokens
from tidecast.functions.timestamps import iso_format
from tidecast.operators import collections as docs
from tidecast.operators import flatten, posts as post_ops, state as state_ops
from tidecast.operators.ad_metrics import ad_metrics, regional_ad_metrics
from tidecast.operators.aggregates import ads_by_type
from tidecast.operators.facts import ad_performance_records, sentiment_records, store, viewership_records
from tidecast.operators.latest import latest_ads, latest_sentiment, latest_viewership
from tidecast.operators.skew import lookup_join
from tidecast.plans import dashboard, feeds, history
from tidecast.schemas import (
    AD_PERFORMANCE_TABLE, SCORED_POST, SENTIMENT_TABLE, STATE, VIEWERSHIP, VIEWERSHIP_TABLE,
)
from tidecast.session import use_utc
from tidecast.sources.campaigns import read_campaigns
from tidecast.sources.messages import (
    message_batch, message_stream, parse_ads, parse_posts, parse_rejects, parse_viewership,
)
from tidecast.sources.warehouse import warehouse_sql
from tidecast.streaming import jobs
from tidecast.streaming.sinks import StateTable, batch_writer, read_batches
from tidecast.streaming.windows import flat_windows, merged_windows, sentiment_windows
from tidecast.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = {"availableNow": True}
#: The feeds hold a few messages a day, so a folder of a table holds a month.
PERIOD = "month"
HISTORY_HOURS = 24 * 30
REPORT_HOURS = 24
SCORES = ["positive", "neutral", "negative", "compound"]
AVERAGES = [f"avg_{s}" for s in SCORES]


def query(name: str) -> Callable[[Query], Query]:
    """Register a query."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(use_utc(spark), sf_dir)
        QUERIES[name] = run
        return fn
    return register


# --- shared inputs ----------------------------------------------------------------------------------------


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return message_batch(spark, feeds.message_feed(spark, sf_dir, name))


def feed_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return message_stream(spark, "parquet", {}, feeds.message_feed(spark, sf_dir, name))


def parsed_posts(spark, sf_dir):
    return parse_posts(feed(spark, sf_dir, "posts"))


def parsed_viewership(spark, sf_dir):
    return parse_viewership(feed(spark, sf_dir, "viewership"))


def parsed_ads(spark, sf_dir):
    return parse_ads(feed(spark, sf_dir, "ads"))


def score(spark: SparkSession, sf_dir: str) -> jobs.Score:
    """Lexicon scores blended with the classifier scores of the labelled documents."""
    lexicon = inline_lexicon(feeds.lexicon(spark), feeds.STOP_WORDS)

    def scored(posts: DataFrame) -> DataFrame:
        rated = lookup_join(posts, feeds.oriented_scores(spark, sf_dir), "id")
        return score_sentiment(rated, "text", lexicon, classifier=F.col("h")).drop("h")
    return scored


def scored_posts(spark, sf_dir):
    return score(spark, sf_dir)(parsed_posts(spark, sf_dir))


def layout(spark: SparkSession, sf_dir: str) -> jobs.Layout:
    """Tables and state, after the streaming jobs have processed all feeds; run once per session."""
    def run(folder: str) -> None:
        topics = {name: feed_stream(spark, sf_dir, name) for name in ("posts", "viewership", "ads")}
        jobs.run_available(spark, topics, score(spark, sf_dir), jobs.Layout(folder, PERIOD))
    return jobs.Layout(feeds.derived(spark, sf_dir, "jobs", run), PERIOD)


def stored(spark, sf_dir, name):
    return layout(spark, sf_dir).events(spark, name).read()


def sums(spark, sf_dir, name):
    return layout(spark, sf_dir).sums(spark, name).read()


def stored_since(spark, sf_dir, name, hours):
    """The last hours of a table, and its newest time: only the folders that can hold them are opened."""
    table = layout(spark, sf_dir).events(spark, name)
    newest = table.newest()
    return table.read(newest - timedelta(hours=hours)), newest


def stored_posts(spark, sf_dir):
    return stored(spark, sf_dir, "posts")


def stored_state(spark, sf_dir, path):
    return StateTable(spark, layout(spark, sf_dir).state(path)).read()


# --- output shapes ----------------------------------------------------------------------------------------


def rounded(*names: str) -> dict[str, Column]:
    return {n: round_half_up(F.col(n).cast("double"), 6) for n in names}


def widened(rows: DataFrame) -> DataFrame:
    """32-bit floats as doubles, times as ISO text."""
    casts = {}
    for f in rows.schema.fields:
        kind = f.dataType.typeName()
        if kind == "float":
            casts[f.name] = F.col(f.name).cast("double")
        elif kind == "timestamp":
            casts[f.name] = iso_format(F.col(f.name))
    return rows.withColumns(casts) if casts else rows


def spread_post(posts: DataFrame) -> DataFrame:
    return posts.select(
        "id", "text", "created_at", "lang",
        F.element_at("metrics", "like_count").alias("like_count"),
        F.element_at("metrics", "retweet_count").alias("retweet_count"),
        F.col("user.id").alias("user_id"), F.col("user.name").alias("user_name"),
        F.col("user.username").alias("username"), F.col("user.location").alias("location"),
        F.col("user.verified").alias("verified"),
        "source", F.array_join("keywords", "|").alias("keywords"),
    )


def spread_sentiment(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, *[F.col(f"sentiment.{s}").cast("double").alias(s) for s in SCORES])


def spread_viewership(record: DataFrame) -> DataFrame:
    """One viewership record as a row per list entry."""
    regional = record.select("timestamp", "total_viewers", F.lit("region").alias("part"),
                             F.inline("regional_data").alias("name", "viewers", "rate"), F.lit("").alias("resolution"))
    platform = record.select("timestamp", "total_viewers", F.lit("platform").alias("part"),
                             F.inline("platform_data").alias("name", "viewers", "rate", "resolution"))
    return widened(regional.unionByName(platform))


def spread_windows(windows: DataFrame) -> DataFrame:
    return widened(flat_windows(windows)).withColumns(rounded(*AVERAGES))


# --- sources ----------------------------------------------------------------------------------------------


def stream_table(rows: DataFrame, spark: SparkSession, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what its source holds now, and read back what it wrote.

    Append goes to a table of batches; in complete mode each batch is the whole result, so the last one
    replaces the others.
    """
    folder = new_folder(spark, name)
    if mode == "complete":
        write = lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{folder}/table")
    else:
        write = batch_writer(f"{folder}/table")
    writer = rows.writeStream.outputMode(mode).trigger(**NOW).foreachBatch(write)
    writer.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    return spark.read.parquet(f"{folder}/table") if mode == "complete" else read_batches(spark, f"{folder}/table")


@query("source_replay")
def source_replay(spark, sf_dir):
    messages = stream_table(feed_stream(spark, sf_dir, "viewership"), spark, "replay")
    return parse_viewership(messages).select("timestamp", "total_viewers")


@query("parse_tweets")
def parse_tweets(spark, sf_dir):
    return spread_post(parsed_posts(spark, sf_dir))


@query("tweets_dedup")
def tweets_dedup(spark, sf_dir):
    """Every post fetched twice, kept once."""
    posts = parsed_posts(spark, sf_dir)
    return spread_post(post_ops.dedup_posts(posts.unionByName(posts)))


@query("parse_viewership")
def parse_viewership_messages(spark, sf_dir):
    rows = parsed_viewership(spark, sf_dir)
    return widened(rows.select("timestamp", "event_ts", "total_viewers",
                               F.size("regional_data").alias("n_regions"), F.size("platform_data").alias("n_platforms")))


@query("parse_ads")
def parse_ad_messages(spark, sf_dir):
    rows = parsed_ads(spark, sf_dir)
    regions = F.aggregate("ads", F.lit(0), lambda n, ad: n + F.size(ad["regions"]))
    return widened(rows.select("timestamp", "event_ts", F.size("ads").alias("n_ads"), regions.alias("n_regions")))


@query("parse_rejects")
def parse_rejected(spark, sf_dir):
    """Prose and foreign JSON among the viewership messages are set aside, whole."""
    prose = feeds.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    foreign = feeds.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    mixed = feed(spark, sf_dir, "viewership").unionByName(prose).unionByName(foreign)
    return parse_rejects(mixed, VIEWERSHIP, "timestamp")


def tweet_collection(spark, sf_dir):
    """Posts as a document collection, keyed so that insertion order is post order: length before digits, nothing cut."""
    return parsed_posts(spark, sf_dir).withColumn(docs.ID, F.format_string("%010d%s", F.length("id"), F.col("id")))


@query("collection_find_many")
def collection_find_many(spark, sf_dir):
    found = docs.find_many(tweet_collection(spark, sf_dir), {"lang": "en", "user.location": "ASIA"})
    return spread_post(found)


@query("collection_find_one")
def collection_find_one(spark, sf_dir):
    return spread_post(docs.find_one(tweet_collection(spark, sf_dir), {"lang": "fr", "user.verified": True}))


@query("warehouse_sql")
def warehouse_sql_query(spark, sf_dir):
    regional = flatten.regional_viewership(parsed_viewership(spark, sf_dir))
    sql = """
        SELECT region, count(*) AS messages, sum(viewers) AS viewers, max(viewers) AS peak
        FROM {regional} WHERE viewers >= :least GROUP BY region
    """
    return warehouse_sql(spark, sql, {"regional": regional}, {"least": 100})


def state_rows(spark, sf_dir, batch_id=0):
    """A state with a path per region and a child per customer of that region."""
    homes = feeds.customer_regions(spark, sf_dir).select(
        "r_name", "c_custkey", "c_name", "c_mktsegment", F.lit("2024-01-01").cast("timestamp").alias("updated_at"))
    return homes.select(
        F.concat(F.lit("audience/"), F.col("r_name")).alias("path"), F.col("c_custkey").cast("string").alias("key"),
        F.to_json(F.struct("c_name", "c_mktsegment")).alias("value_json"), "updated_at",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


@query("latest_state_get")
def latest_state_get(spark, sf_dir):
    return state_ops.state_get(state_rows(spark, sf_dir), "audience/ASIA").select("path", "key", "value_json")


@query("campaign_json_scan")
def campaign_json_scan(spark, sf_dir):
    return read_campaigns(spark, feeds.campaign_folder(spark, sf_dir), one_array_per_file=False)


@query("campaign_array_scan")
def campaign_array_scan(spark, sf_dir):
    return read_campaigns(spark, feeds.campaign_array_folder(spark, sf_dir), one_array_per_file=True)


# --- posts and ad metrics ---------------------------------------------------------------------------------


@query("tweets_recent_window")
def tweets_recent_window(spark, sf_dir):
    posts = parsed_posts(spark, sf_dir)
    asof = history.newest_time(posts, "created_ts")
    return post_ops.filter_recent(posts, "created_ts", asof).select("id", "created_at", "text")


@query("tweets_keyword_filter")
def tweets_keyword_filter(spark, sf_dir):
    posts = parsed_posts(spark, sf_dir)
    return post_ops.filter_keywords(posts, "text", feeds.KEYWORDS).select("id", "text")


@query("tweets_capped")
def tweets_capped(spark, sf_dir):
    return post_ops.newest(parsed_posts(spark, sf_dir)).select("id", "created_at")


@query("tweets_join_users")
def tweets_join_users(spark, sf_dir):
    return feeds.posts_with_authors(spark, sf_dir).select(
        "id", "author_id", F.col("user.name").alias("user_name"), F.col("user.username").alias("username"),
        F.col("user.location").alias("location"), F.col("user.verified").alias("verified"))


@query("tweets_defaults")
def tweets_defaults(spark, sf_dir):
    posts = post_ops.with_defaults(feeds.posts_with_authors(spark, sf_dir))
    return posts.select(
        "id", "lang", F.size("metrics").alias("n_metrics"), F.col("user.id").alias("user_id"),
        F.col("user.name").alias("user_name"), F.col("user.location").alias("location"),
        F.col("user.verified").alias("verified"), F.col("user.profile_image_url").alias("profile_image_url"))


@query("tweets_keyword_tags")
def tweets_keyword_tags(spark, sf_dir):
    posts = post_ops.with_keywords(feeds.raw_posts(spark, sf_dir), feeds.KEYWORDS)
    return posts.select("id", F.array_join("keywords", "|").alias("keywords"), F.size("keywords").alias("n_keywords"))


@query("tweets_envelope_guard")
def tweets_envelope_guard(spark, sf_dir):
    usable = post_ops.usable_envelopes(feed(spark, sf_dir, "envelopes"))
    return usable.select(F.col("data")[0]["id"].alias("first_id"), F.size("data").alias("n_posts"),
                         F.size("users").alias("n_users"))


@query("tweets_normalize")
def tweets_normalize(spark, sf_dir):
    return spread_post(post_ops.normalize_posts(feed(spark, sf_dir, "envelopes"), feeds.KEYWORDS))


@query("ad_metrics")
def ad_metric_ratios(spark, sf_dir):
    ads = flatten.ads_flat(parsed_ads(spark, sf_dir))
    return widened(ad_metrics(ads).select("timestamp", "type", "ctr", "cost_per_conversion"))


@query("regional_ad_metrics")
def regional_ad_metric_ratios(spark, sf_dir):
    rows = flatten.regional_ads(parsed_ads(spark, sf_dir))
    return regional_ad_metrics(rows).select("timestamp", "type", "region", "ctr")


@query("campaign_metrics")
def campaign_metrics(spark, sf_dir):
    return ad_metrics(read_campaigns(spark, feeds.campaign_folder(spark, sf_dir), one_array_per_file=False))


# --- flatten ----------------------------------------------------------------------------------------------


@query("regional_viewership")
def regional_viewership(spark, sf_dir):
    return widened(flatten.regional_viewership(parsed_viewership(spark, sf_dir)).drop("event_ts"))


@query("platform_viewership")
def platform_viewership(spark, sf_dir):
    return widened(flatten.platform_viewership(parsed_viewership(spark, sf_dir)).drop("event_ts"))


@query("ads_flat")
def ads_flat(spark, sf_dir):
    return widened(flatten.ads_flat(parsed_ads(spark, sf_dir)).drop("event_ts"))


@query("regional_ads")
def regional_ads(spark, sf_dir):
    return widened(flatten.regional_ads(parsed_ads(spark, sf_dir)).drop("event_ts"))


# --- text and sentiment -----------------------------------------------------------------------------------


@query("text_clean")
def text_clean(spark, sf_dir):
    return parsed_posts(spark, sf_dir).select("id", clean_text(F.col("text")).alias("cleaned"))


@query("text_tokens_filtered")
def text_tokens_filtered(spark, sf_dir):
    cleaned = clean_text(F.col("text"))
    return parsed_posts(spark, sf_dir).select(
        "id", F.size(tokens(cleaned, feeds.STOP_WORDS)).alias("n_words"),
        filtered_text(cleaned, feeds.STOP_WORDS).alias("kept"))


@query("sentiment_empty_guard")
def sentiment_empty_guard(spark, sf_dir):
    """Missing texts, and texts of which cleaning leaves nothing, score zero even where a classifier answered."""
    user = F.concat(F.lit("@user"), F.col("author_id"))
    kind = F.col("event_type")
    texts = feeds.raw_posts(spark, sf_dir).withColumn(
        "text", F.when(kind == "error", F.lit(None)).when(kind == "view", F.lit(""))
        .when(kind == "click", F.concat(user, F.lit(" https://t.co/x "), user)).otherwise(F.col("text")))
    scored = score_sentiment(texts, "text", feeds.lexicon(spark), feeds.STOP_WORDS, F.lit(0.9))
    zero = F.forall(F.array(*[F.col(f"sentiment.{s}") for s in SCORES]), lambda s: s == 0)
    return scored.select("id", "event_type", zero.alias("all_zero"))


@query("lexicon_sentiment")
def lexicon_sentiments(spark, sf_dir):
    lexicon = inline_lexicon(feeds.lexicon(spark), feeds.STOP_WORDS)
    scored = lexicon_sentiment(parsed_posts(spark, sf_dir), "text", lexicon)
    return scored.select("id", "n_words", "pos", "neu", "neg", "compound")


@query("lexicon_sentiment_joined")
def lexicon_sentiments_joined(spark, sf_dir):
    """The join form, with the words of the benchmark passages as the lexicon."""
    lexicon = feeds.benchmark_lexicon(spark, sf_dir)
    scored = lexicon_sentiment_joined(parsed_posts(spark, sf_dir), "text", lexicon, feeds.STOP_WORDS)
    return scored.select("id", "n_words", "pos", "neu", "neg", "compound")


@query("lexicon_sentiment_inline")
def lexicon_sentiments_inline(spark, sf_dir):
    """The inline form with the same lexicon: the same scores without a shuffle."""
    lexicon = inline_lexicon(feeds.benchmark_lexicon(spark, sf_dir), feeds.STOP_WORDS)
    scored = lexicon_sentiment(parsed_posts(spark, sf_dir), "text", lexicon)
    return scored.select("id", "n_words", "pos", "neu", "neg", "compound")


@query("classifier_score")
def classifier_scores(spark, sf_dir):
    posts = parsed_posts(spark, sf_dir).select("id", clean_text(F.col("text")).alias("cleaned"))
    rated = lookup_join(posts, feeds.oriented_scores(spark, sf_dir), "id")
    return rated.select("id", F.length("cleaned").alias("n_chars"), "h")


@query("classifier_hook")
def classifier_hook(spark, sf_dir):
    """A stand-in model: more "e" than "n" is positive, and the share of the larger is the score."""
    def letter_classifier():
        def classify(texts):
            counts = [(t.count("e"), t.count("n")) for t in texts]
            labels = ["POSITIVE" if e >= n else "NEGATIVE" for e, n in counts]
            return labels, [max(e, n) / (e + n) if e + n else 0.5 for e, n in counts]
        return classify

    posts = parsed_posts(spark, sf_dir).select("id", clean_text(F.col("text")).alias("cleaned"))
    scored = posts.withColumn("h", classifier_column(F.col("cleaned"), letter_classifier))
    return scored.select("id", round_half_up(F.col("h"), 6).alias("h"))


@query("sentiment_combine")
def sentiment_combine(spark, sf_dir):
    """The blend over lexicon-like shares made from the event values, with and without a classifier score."""
    events = feeds.table(spark, sf_dir, "events")
    value = F.least(F.abs(F.col("value")) / F.lit(100.0), F.lit(1.0))
    shares = events.select("event_id", "event_type", value.alias("pos"), ((1 - value) * F.lit(0.25)).alias("neg"),
                           ((1 - value) * F.lit(0.75)).alias("neu"), (value - F.lit(0.5)).alias("compound"))
    h = F.when(F.col("event_type") == "click", F.lit(0.9)).when(F.col("event_type") == "view", F.lit(0.2))
    blended = combine_sentiment(F.col("pos"), F.col("neu"), F.col("neg"), F.col("compound"), h)
    return spread_sentiment(shares.select("event_id", blended.alias("sentiment")), "event_id") \
        .withColumns(rounded(*SCORES))


@query("tweet_sentiment")
def tweet_sentiment(spark, sf_dir):
    return spread_sentiment(scored_posts(spark, sf_dir), "id")


# --- windows and streams ----------------------------------------------------------------------------------


@query("sentiment_5min")
def sentiment_5min(spark, sf_dir):
    return spread_windows(sentiment_windows(scored_posts(spark, sf_dir)))


def scored_post_stream(spark, sf_dir):
    return jobs.scored_posts(spark, layout(spark, sf_dir))


@query("sentiment_5min_append")
def sentiment_5min_append(spark, sf_dir):
    rows = stream_table(sentiment_windows(scored_post_stream(spark, sf_dir)), spark, "append")
    return spread_windows(rows)


@query("sentiment_5min_complete")
def sentiment_5min_complete(spark, sf_dir):
    rows = stream_table(sentiment_windows(scored_post_stream(spark, sf_dir)), spark, "complete", "complete")
    return spread_windows(rows)


@query("sentiment_5min_maintained")
def sentiment_5min_maintained(spark, sf_dir):
    """All windows, from the sums that the jobs keep: complete output that rewrites no window."""
    return widened(merged_windows(sums(spark, sf_dir, "window_sums"))).withColumns(rounded(*AVERAGES))


LATE_FROM = "2024-01-02 12:00:00"


@query("sentiment_late_drop")
def sentiment_late_drop(spark, sf_dir):
    """Posts in two deliveries.  The second holds the posts of unknown language, however old: those whose window
    the first delivery has closed are dropped."""
    posts = stored_posts(spark, sf_dir)
    on_time = (F.col("lang") != "unknown") & (F.col("created_ts") < F.lit(LATE_FROM).cast("timestamp"))
    folder = new_folder(spark, "late")
    write = batch_writer(f"{folder}/table")
    for number, delivery in enumerate([posts.where(on_time), posts.where(~on_time)]):
        delivery.write.parquet(f"{folder}/deliveries/{number}")
        stream = spark.readStream.schema(SCORED_POST).parquet(f"{folder}/deliveries/*")
        writer = sentiment_windows(stream).writeStream.outputMode("append").trigger(**NOW).foreachBatch(write)
        writer.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    return spread_windows(read_batches(spark, f"{folder}/table"))


@query("regional_viewership_stream")
def regional_viewership_stream(spark, sf_dir):
    rows = flatten.regional_viewership(parse_viewership(feed_stream(spark, sf_dir, "viewership")))
    return widened(stream_table(rows, spark, "regional-viewership").drop("event_ts"))


@query("regional_ads_stream")
def regional_ads_stream(spark, sf_dir):
    rows = flatten.regional_ads(parse_ads(feed_stream(spark, sf_dir, "ads")))
    return widened(stream_table(rows, spark, "regional-ads").drop("event_ts"))


TABLES = ["sentiment_windows", "viewership", "regional_viewership", "platform_viewership", "ads", "ad_performance",
          "regional_ads"]


@query("fanout_counts")
def fanout_counts(spark, sf_dir):
    counts = stored_posts(spark, sf_dir).agg(F.lit("posts").alias("name"), F.count("*").alias("n"))
    for name in TABLES:
        counts = counts.unionByName(stored(spark, sf_dir, name).agg(F.lit(name).alias("name"), F.count("*").alias("n")))
    return counts


# --- aggregates and latest records ------------------------------------------------------------------------


def by_type(rows: DataFrame) -> DataFrame:
    return widened(rows).withColumns(rounded("ctr", "cost", "cost_per_conversion"))


@query("ads_by_type")
def ads_by_type_totals(spark, sf_dir):
    return by_type(ads_by_type(flatten.ads_flat(parsed_ads(spark, sf_dir))))


@query("ads_by_type_maintained")
def ads_by_type_maintained(spark, sf_dir):
    return by_type(ads_by_type(sums(spark, sf_dir, "ad_sums")))


@query("latest_ads")
def latest_ads_record(spark, sf_dir):
    return by_type(latest_ads(flatten.ads_flat(parsed_ads(spark, sf_dir))).drop("updated_at"))


@query("latest_sentiment")
def latest_sentiment_record(spark, sf_dir):
    newest = latest_sentiment(sentiment_windows(scored_posts(spark, sf_dir)))
    return newest.drop("updated_at").withColumns(rounded(*SCORES))


@query("latest_viewership")
def latest_viewership_record(spark, sf_dir):
    return spread_viewership(latest_viewership(parsed_viewership(spark, sf_dir)))


@query("recent_tweets")
def recent_tweets(spark, sf_dir):
    posts = history.recent_posts(stored_posts(spark, sf_dir))
    return spread_sentiment(posts, "id", "created_at", "text", "lang")


# --- sinks ------------------------------------------------------------------------------------------------


@query("sink_tweets")
def sink_tweets(spark, sf_dir):
    return spread_sentiment(stored_posts(spark, sf_dir), "id", "text", "created_at", "lang", "source")


@query("sink_tweets_once")
def sink_tweets_once(spark, sf_dir):
    """The posts job over a topic that holds every post twice, with repeats dropped on arrival."""
    twice = feed_stream(spark, sf_dir, "posts").unionByName(feed_stream(spark, sf_dir, "posts"))
    own = jobs.Layout(new_folder(spark, "posts-once"), PERIOD)
    jobs.start_posts(twice, score(spark, sf_dir), own, NOW, once_within="15 minutes").awaitTermination()
    return spread_sentiment(own.events(spark, "posts").read(), "id", "text", "created_at", "lang", "source")


@query("sink_sentiment")
def sink_sentiment(spark, sf_dir):
    return widened(stored(spark, sf_dir, "sentiment_windows")).withColumns(rounded(*AVERAGES))


@query("sink_viewership")
def sink_viewership(spark, sf_dir):
    return spread_viewership(stored(spark, sf_dir, "viewership"))


@query("sink_regional")
def sink_regional(spark, sf_dir):
    return widened(stored(spark, sf_dir, "regional_viewership").drop("event_ts"))


@query("sink_platform")
def sink_platform(spark, sf_dir):
    return widened(stored(spark, sf_dir, "platform_viewership").drop("event_ts"))


@query("sink_ads_raw")
def sink_ads_raw(spark, sf_dir):
    stored_ads = stored(spark, sf_dir, "ads").select("timestamp", F.explode("ads").alias("ad"))
    return widened(stored_ads.select("timestamp", "ad.type", "ad.impressions", "ad.clicks", "ad.cost",
                                     F.size("ad.regions").alias("n_regions")))


@query("sink_ads")
def sink_ads(spark, sf_dir):
    return widened(stored(spark, sf_dir, "ad_performance").drop("event_ts"))


@query("sink_regional_ads")
def sink_regional_ads(spark, sf_dir):
    return widened(stored(spark, sf_dir, "regional_ads").drop("event_ts"))


# --- state ------------------------------------------------------------------------------------------------


def state_changes(spark, sf_dir):
    """A second batch for the same state: customers in debt become "blocked"."""
    rows = state_rows(spark, sf_dir, batch_id=1)
    debtors = feeds.table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("key"))
    return rows.join(debtors, "key", "left_semi").withColumn("value_json", F.lit('{"blocked":true}'))


def state_out(state: DataFrame) -> DataFrame:
    return state.select("path", "key", "value_json")


@query("state_update")
def state_update(spark, sf_dir):
    return state_out(state_ops.state_update(state_rows(spark, sf_dir), state_changes(spark, sf_dir)))


@query("state_set")
def state_set(spark, sf_dir):
    replacement = state_changes(spark, sf_dir).where("path = 'audience/ASIA'")
    return state_out(state_ops.state_set(state_rows(spark, sf_dir), "audience/ASIA", replacement))


@query("state_push")
def state_push(spark, sf_dir):
    """Every order value pushed onto one list; keys are generated, so only their number is shown."""
    values = feeds.table(spark, sf_dir, "orders").select(
        F.to_json(F.struct("o_orderkey", "o_orderpriority")).alias("value_json"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    empty = spark.createDataFrame([], STATE)
    pushed = state_ops.state_push(empty, "orders/log", values, 7)
    return pushed.groupBy("path", "batch_id", F.to_date("updated_at").cast("string").alias("day")).agg(
        F.count_distinct("key").alias("n_keys"), F.min("value_json").alias("first_value"),
        F.max("value_json").alias("last_value"))


@query("state_delete")
def state_delete(spark, sf_dir):
    return state_out(state_ops.state_delete(state_rows(spark, sf_dir), "audience/ASIA"))


# --- warehouse records ------------------------------------------------------------------------------------


def stored_records(spark, records, schema, name):
    folder = new_folder(spark, name)
    store(records, folder, schema)
    return spark.read.schema(schema).parquet(folder)


def with_text_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("timestamp", iso_format(F.col("timestamp").cast("timestamp")))


@query("store_viewership")
def store_viewership(spark, sf_dir):
    regional = flatten.regional_viewership(parsed_viewership(spark, sf_dir))
    records = viewership_records(regional.select(
        F.concat_ws("/", "timestamp", "region").alias("id"), F.col("event_ts").alias("timestamp"),
        F.col("viewers").alias("total_viewers"), "region"))
    return with_text_time(stored_records(spark, records, VIEWERSHIP_TABLE, "warehouse-viewership"))


def post_records(spark, sf_dir):
    return sentiment_records(scored_posts(spark, sf_dir).select(
        "id", F.col("created_ts").alias("timestamp"), "source", "text", "sentiment.*",
        F.col("user.location").alias("region")))


@query("store_sentiment")
def store_sentiment(spark, sf_dir):
    records = post_records(spark, sf_dir)
    return with_text_time(stored_records(spark, records, SENTIMENT_TABLE, "warehouse-sentiment"))


@query("store_ad_performance")
def store_ad_performance(spark, sf_dir):
    ads = flatten.ads_flat(parsed_ads(spark, sf_dir))
    records = ad_performance_records(ads.withColumns({
        "id": F.concat_ws("/", "timestamp", "type"), "timestamp": F.col("event_ts")}))
    return with_text_time(stored_records(spark, records, AD_PERFORMANCE_TABLE, "warehouse-ads"))


@query("collection_insert")
def collection_insert(spark, sf_dir):
    """Two inserts into one collection; the store keys are generated, so only their number is shown."""
    folder = new_folder(spark, "collection")
    posts = parsed_posts(spark, sf_dir)
    for batch_id in (1, 2):
        docs.with_ids(posts, batch_id).write.mode("append").parquet(folder)
    return spark.read.parquet(folder).groupBy("id").agg(
        F.count("*").alias("n"), F.count_distinct(docs.ID).alias("n_keys"), F.max("text").alias("text"))


@query("collection_update_one")
def collection_update_one(spark, sf_dir):
    updated = docs.update_one(tweet_collection(spark, sf_dir), {"lang": "de", "user.verified": True},
                              {"lang": "at", "source": "corrected"})
    return updated.select("id", "lang", "source")


@query("collection_delete_one")
def collection_delete_one(spark, sf_dir):
    return docs.delete_one(tweet_collection(spark, sf_dir), {"lang": "de", "user.verified": True}).select("id", "lang")


# --- read side --------------------------------------------------------------------------------------------


@query("viewership_history")
def viewership_history(spark, sf_dir):
    return widened(history.viewership_history(*stored_since(spark, sf_dir, "regional_viewership", HISTORY_HOURS), HISTORY_HOURS))


@query("sentiment_history")
def sentiment_history(spark, sf_dir):
    rows = history.sentiment_history(*stored_since(spark, sf_dir, "sentiment_windows", HISTORY_HOURS), HISTORY_HOURS)
    return rows.withColumns(rounded(*SCORES))


@query("ads_history")
def ads_history(spark, sf_dir):
    return widened(history.ads_history(*stored_since(spark, sf_dir, "ad_performance", HISTORY_HOURS), HISTORY_HOURS))


EXPORT_FIELDS = {
    "region": "string", "viewers": "int", "engagement_rate": "float", "positive": "double", "neutral": "double",
    "negative": "double", "compound": "double", "type": "string", "impressions": "int", "clicks": "int",
    "ctr": "float", "cost": "float", "conversions": "int", "cost_per_conversion": "float",
}


def exported(spark, sf_dir, data_type):
    """The export's JSON payloads, read back field by field.  Each section ends at its own newest time."""
    rows = None
    for name, table in {"viewership": "regional_viewership", "sentiment": "sentiment_windows", "ads": "ad_performance"}.items():
        if data_type in ("all", name):
            recent, asof = stored_since(spark, sf_dir, table, REPORT_HOURS)
            part = history.export_rows(history.export({name: recent}, asof, name, REPORT_HOURS))
            rows = part if rows is None else rows.unionByName(part)
    payload = F.from_json("payload_json", ", ".join(f"{k} {v}" for k, v in EXPORT_FIELDS.items()))
    spread = rows.select("section", "timestamp", payload.alias("p")).select("section", "timestamp", "p.*")
    return spread.withColumns(rounded(*[k for k, v in EXPORT_FIELDS.items() if v in ("float", "double")]))


@query("export_all")
def export_all(spark, sf_dir):
    return exported(spark, sf_dir, "all")


@query("export_viewership")
def export_viewership(spark, sf_dir):
    return exported(spark, sf_dir, "viewership").select("section", "timestamp", "region", "viewers", "engagement_rate")


@query("export_sentiment")
def export_sentiment(spark, sf_dir):
    return exported(spark, sf_dir, "sentiment").select("section", "timestamp", *SCORES)


@query("export_ads")
def export_ads(spark, sf_dir):
    return exported(spark, sf_dir, "ads").select("section", "timestamp", *history.AD_COLUMNS)


def field(key: str, kind: str) -> Column:
    """One child of a current record, decoded."""
    text = F.max(F.when(F.col("key") == key, F.col("value_json")))
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), f"v {kind}")["v"].alias(key)


@query("current_viewership")
def current_viewership(spark, sf_dir):
    record = history.current(stored_state(spark, sf_dir, "viewership"), "viewership")
    lists = {f.name: f.dataType.simpleString() for f in VIEWERSHIP.fields}
    return spread_viewership(record.agg(*[field(k, kind) for k, kind in lists.items()]))


@query("current_sentiment")
def current_sentiment(spark, sf_dir):
    record = history.current(stored_state(spark, sf_dir, "sentiment"), "sentiment")
    values = record.agg(field("timestamp", "string"), *[field(s, "double") for s in SCORES])
    return values.withColumns(rounded(*SCORES))


@query("current_ads")
def current_ads(spark, sf_dir):
    rows = history.current(stored_state(spark, sf_dir, "ads"), "ads").where("path = 'ads/ads'")
    schema = "type string, impressions bigint, clicks bigint, ctr double, cost double, conversions bigint, " \
             "cost_per_conversion double"
    ads = rows.select(iso_format(F.col("updated_at")).alias("timestamp"),
                      F.from_json("value_json", schema).alias("ad"))
    return by_type(ads.select("timestamp", "ad.*"))


# --- dashboard --------------------------------------------------------------------------------------------


@query("card_total_viewers")
def card_total_viewers(spark, sf_dir):
    """The newest message is in the folder of the newest time."""
    return dashboard.card_total_viewers(stored_since(spark, sf_dir, "viewership", 0)[0])


@query("viewers_by_region")
def viewers_by_region(spark, sf_dir):
    return dashboard.viewers_by_region(sums(spark, sf_dir, "viewer_sums"))


@query("viewers_over_time")
def viewers_over_time(spark, sf_dir):
    return dashboard.viewers_over_time(sums(spark, sf_dir, "audience_sums"))


@query("card_compound")
def card_compound(spark, sf_dir):
    return dashboard.card_compound(sums(spark, sf_dir, "closed_window_sums")).withColumns(rounded("compound"))


@query("sentiment_trend")
def sentiment_trend(spark, sf_dir):
    rows = dashboard.sentiment_trend(stored(spark, sf_dir, "sentiment_windows"))
    return rows.withColumns(rounded("positive", "neutral", "negative"))


@query("sentiment_by_region")
def sentiment_by_region(spark, sf_dir):
    return dashboard.sentiment_by_region(sums(spark, sf_dir, "region_sums")).withColumns(rounded("positive"))


@query("card_ctr")
def card_ctr(spark, sf_dir):
    return dashboard.card_ctr(sums(spark, sf_dir, "ad_sums")).withColumns(rounded("ctr", "weighted_ctr"))


@query("ad_performance_by_type")
def ad_performance_by_type(spark, sf_dir):
    return dashboard.ad_performance_by_type(sums(spark, sf_dir, "ad_sums"))


@query("ad_cost_over_time")
def ad_cost_over_time(spark, sf_dir):
    return dashboard.ad_cost_over_time(sums(spark, sf_dir, "cost_sums")).withColumns(rounded("cost"))
