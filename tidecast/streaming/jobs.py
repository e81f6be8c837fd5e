"""The streaming jobs: one pass over each topic, with checkpoints.

Every topic is read and decoded once and fans out inside ``foreachBatch`` to tables with a log (`tables.py`), which hold each batch once.  The window
jobs stream from the table of scored posts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecast.operators.flatten import ads_flat, platform_viewership, regional_ads, regional_viewership
from tidecast.operators.latest import latest_ads, latest_sentiment, latest_viewership
from tidecast.operators.state import children, keyed_children, state_set, state_update
from tidecast.schemas import ADS, POST, SCORED_POST, VIEWERSHIP
from tidecast.sources.messages import decode, decode_once, parsed_rows, rejected_rows
from tidecast.streaming.partials import Kind, PartialTable
from tidecast.streaming.sinks import BatchWriter, StateTable, fan_out, run_of
from tidecast.streaming.tables import EventTable
from tidecast.streaming.windows import SCORES, flat_windows, sentiment_windows, window_scores
from tidecast.workspace import has_files

SENTIMENT_FIELDS = ["timestamp", "positive", "neutral", "negative", "compound"]
VIEWERSHIP_FIELDS = ["timestamp", "total_viewers", "regional_data", "platform_data"]
AD_FIELDS = ["type", "impressions", "clicks", "ctr", "cost", "conversions", "cost_per_conversion"]

Score = Callable[[DataFrame], DataFrame]


#: Event time of each table; tables of rejects have none.
TIMES = {
    "posts": "created_ts", "sentiment_windows": "window_end", "viewership": "event_ts", "regional_viewership": "event_ts",
    "platform_viewership": "event_ts", "ads": "event_ts", "ad_performance": "event_ts", "regional_ads": "event_ts",
}


AD_SUMS = ("impressions", "clicks", "cost", "conversions")

#: Sums that the jobs maintain for dashboards.  A grain stands for the period of the layout.
SUMS = {
    "viewer_sums": Kind("event_ts", ("region",), ("viewers",), grain="day"),
    "audience_sums": Kind("event_ts", (), ("total_viewers",)),
    "ad_sums": Kind("event_ts", ("type",), AD_SUMS, ("ctr", "cost_per_conversion"), grain="day"),
    "cost_sums": Kind("event_ts", (), ("cost",)),
    "closed_window_sums": Kind("window_end", (), (), ("avg_compound",), grain="day"),
    "window_sums": Kind("window_end", ("window_start",), (), SCORES),
    "region_sums": Kind("created_ts", ("region",), (), ("positive",), grain="day"),
}


@dataclass(frozen=True)
class Layout:
    """Where tables, state and checkpoints live, below one shared folder.  ``period``: of event time, for a folder of a table."""

    root: str
    period: str = "day"

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def events(self, spark: SparkSession, name: str) -> EventTable:
        return EventTable(spark, self.table(name), TIMES.get(name), SCORED_POST if name == "posts" else None, self.period)

    def sums(self, spark: SparkSession, name: str) -> PartialTable:
        """A table of maintained sums; see `SUMS`."""
        kind = SUMS[name]
        return PartialTable(spark, self.table(name), kind if kind.grain is None else replace(kind, grain=self.period), self.period)

    def state(self, path: str) -> str:
        return f"{self.root}/state/{path}"

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"


def _start(rows: DataFrame, layout: Layout, job: str, trigger: dict, write: BatchWriter, mode: str = "append") -> StreamingQuery:
    writer = rows.writeStream.queryName(job).outputMode(mode).trigger(**trigger) \
        .option("checkpointLocation", layout.checkpoint(job))
    return writer.foreachBatch(write).start()


def start_posts(messages: DataFrame, score: Score, layout: Layout, trigger: dict, once_within: str | None = None) -> StreamingQuery:
    """One pass over the topic: parsed and scored posts to ``posts``, unreadable messages to ``post_rejects``.  ``score`` adds the ``sentiment`` column.

    ``once_within`` (a duration) drops a post whose id was seen in that time, counted from its arrival; see `first_arrivals`.  A new checkpoint would
    read the topic again into the same table and count its posts twice, so it is refused: move the table away with its old checkpoint.
    """
    columns = [f.name for f in SCORED_POST.fields]
    spark = messages.sparkSession
    if has_files(spark, layout.table("posts") + "/_log") and not has_files(spark, layout.checkpoint("posts") + "/offsets"):
        raise ValueError("the posts table was written under another checkpoint")

    def posts(decoded: DataFrame) -> DataFrame:
        return score(parsed_rows(decoded, POST, "created_at", "created_ts")).select(*columns)

    writers = [
        layout.events(spark, "posts").writer(posts),
        layout.events(spark, "post_rejects").writer(lambda d: rejected_rows(d, POST, "created_at")),
    ]
    if once_within:
        return _start(first_arrivals(decode(messages, POST), F.col("data.id"), once_within), layout, "posts", trigger, fan_out(lambda b: b, writers))
    return _start(messages, layout, "posts", trigger, fan_out(lambda batch: decode_once(batch, POST, "created_at"), writers))


def first_arrivals(rows: DataFrame, key: Column, within: str) -> DataFrame:
    """Rows of a stream whose key has not arrived within a time; rows without a key stay.

    The time is that of arrival, so a row is never late, however old its own time is.  Keys are kept in the query's state, over restarts too, for
    ``within`` at least and twice that at most.
    """
    keyed = rows.where(key.isNotNull()).withColumn("first_key", key).withColumn("arrived_at", F.current_timestamp())
    first = keyed.withWatermark("arrived_at", within).dropDuplicatesWithinWatermark(["first_key"]).drop("first_key", "arrived_at")
    return first.unionByName(rows.where(key.isNull()))


#: Files of posts that a window job takes at once.
POST_FILES = 1000


def scored_posts(spark: SparkSession, layout: Layout) -> DataFrame:
    """The ``posts`` table as a stream; it may be asked for before the first post is there."""
    return layout.events(spark, "posts").follow(POST_FILES)


def start_sentiment_windows(posts: DataFrame, layout: Layout, trigger: dict) -> StreamingQuery:
    """Each window once, when it is complete, to the ``sentiment_windows`` table, and the sums of these."""
    spark = posts.sparkSession
    writers = [layout.events(spark, "sentiment_windows").writer(), layout.sums(spark, "closed_window_sums").adder()]
    return _start(sentiment_windows(posts), layout, "sentiment_windows", trigger, fan_out(flat_windows, writers))


def start_post_sums(posts: DataFrame, layout: Layout, trigger: dict) -> StreamingQuery:
    """Sums of scores by window, open windows too, and by region.

    No window is in the query's state: a batch adds a row for each window it meets, so complete output costs what has changed and no more.
    A new checkpoint would add all posts again, so it is refused.
    """
    spark = posts.sparkSession
    if has_files(spark, layout.table("window_sums") + "/_log") and not has_files(spark, layout.checkpoint("post_sums") + "/offsets"):
        raise ValueError("the sums were written under another checkpoint")

    def regions(batch: DataFrame) -> DataFrame:
        return batch.select("created_ts", F.col("user.location").alias("region"), F.col("sentiment.positive").alias("positive"))

    writers = [layout.sums(spark, "window_sums").adder(window_scores), layout.sums(spark, "region_sums").adder(regions)]
    return _start(posts, layout, "post_sums", trigger, fan_out(lambda b: b.select("created_ts", "user", "sentiment"), writers))


def start_latest_sentiment(posts: DataFrame, layout: Layout, trigger: dict, mode: str = "update") -> StreamingQuery:
    """The newest window to the state path ``sentiment``.

    ``update`` hands over changed windows and forgets old ones; ``complete`` repeats every window in every
    batch and keeps them all.  The state is the same, as it only takes the newest.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, layout.state("sentiment"), run=run_of(batch))
        changes = children(latest_sentiment(batch), "sentiment", SENTIMENT_FIELDS, batch_id=batch_id)
        table.commit(state_update(table.read(batch_id), changes), batch_id)

    return _start(sentiment_windows(posts), layout, "latest_sentiment", trigger, write, mode)


def start_viewership(messages: DataFrame, layout: Layout, trigger: dict) -> StreamingQuery:
    """Viewership messages to raw, regional and platform tables, rejects, and the state ``viewership``."""
    def parsed(decoded: DataFrame) -> DataFrame:
        return parsed_rows(decoded, VIEWERSHIP, "timestamp", "event_ts")

    def write_state(decoded: DataFrame, batch_id: int) -> None:
        table = StateTable(decoded.sparkSession, layout.state("viewership"), run=run_of(decoded))
        changes = children(latest_viewership(parsed(decoded)), "viewership", VIEWERSHIP_FIELDS, batch_id=batch_id)
        table.commit(state_update(table.read(batch_id), changes), batch_id)

    spark = messages.sparkSession
    writers = [
        layout.events(spark, "viewership").writer(parsed),
        layout.events(spark, "regional_viewership").writer(lambda d: regional_viewership(parsed(d))),
        layout.events(spark, "platform_viewership").writer(lambda d: platform_viewership(parsed(d))),
        layout.sums(spark, "audience_sums").adder(parsed),
        layout.sums(spark, "viewer_sums").adder(lambda d: regional_viewership(parsed(d))),
        layout.events(spark, "viewership_rejects").writer(lambda d: rejected_rows(d, VIEWERSHIP, "timestamp")),
        write_state,
    ]
    write = fan_out(lambda batch: decode(batch, VIEWERSHIP), writers)
    return _start(messages, layout, "viewership", trigger, write)


def start_ads(messages: DataFrame, layout: Layout, trigger: dict) -> StreamingQuery:
    """Advertising messages to raw, per-ad and per-region tables, rejects, and the state ``ads``.

    The state's list of ads and its time stamp come from one batch: the totals of a batch replace both, unless the batch is
    older than the stamp.
    """
    def parsed(decoded: DataFrame) -> DataFrame:
        return parsed_rows(decoded, ADS, "timestamp", "event_ts")

    def write_state(decoded: DataFrame, batch_id: int) -> None:
        totals = latest_ads(ads_flat(parsed(decoded))).persist()
        try:
            table = StateTable(decoded.sparkSession, layout.state("ads"), run=run_of(decoded))
            state = table.read(batch_id)
            new = totals.agg(F.max("updated_at")).first()[0]
            old = state.where("path = 'ads' AND key = 'timestamp'").agg(F.max("updated_at")).first()[0]
            if not totals.isEmpty() and (old is None or new is not None and new >= old):
                listed = keyed_children(totals, "ads/ads", "type", AD_FIELDS, batch_id=batch_id)
                stamp = children(totals.select("updated_at", "timestamp").distinct(), "ads", ["timestamp"],
                                 batch_id=batch_id)
                state = state_update(state_set(state, "ads/ads", listed), stamp)
            table.commit(state, batch_id)
        finally:
            totals.unpersist()

    spark = messages.sparkSession
    writers = [
        layout.events(spark, "ads").writer(parsed),
        layout.events(spark, "ad_performance").writer(lambda d: ads_flat(parsed(d))),
        layout.events(spark, "regional_ads").writer(lambda d: regional_ads(parsed(d))),
        layout.sums(spark, "ad_sums").adder(lambda d: ads_flat(parsed(d))),
        layout.sums(spark, "cost_sums").adder(lambda d: ads_flat(parsed(d))),
        layout.events(spark, "ad_rejects").writer(lambda d: rejected_rows(d, ADS, "timestamp")),
        write_state,
    ]
    write = fan_out(lambda batch: decode(batch, ADS), writers)
    return _start(messages, layout, "ads", trigger, write)


def start_topics(topics: dict[str, DataFrame], score: Score, layout: Layout, trigger: dict,
                 once_within: str | None = None) -> list[StreamingQuery]:
    """The jobs that read topics: message streams under ``posts``, ``viewership`` and ``ads``."""
    return [
        start_posts(topics["posts"], score, layout, trigger, once_within),
        start_viewership(topics["viewership"], layout, trigger),
        start_ads(topics["ads"], layout, trigger),
    ]


def start_windows(spark: SparkSession, layout: Layout, trigger: dict) -> list[StreamingQuery]:
    """The jobs that read the scored posts."""
    return [
        start_sentiment_windows(scored_posts(spark, layout), layout, trigger),
        start_latest_sentiment(scored_posts(spark, layout), layout, trigger),
        start_post_sums(scored_posts(spark, layout), layout, trigger),
    ]


def start_all(spark: SparkSession, topics: dict[str, DataFrame], score: Score, layout: Layout,
              interval: str = "10 seconds", once_within: str | None = None) -> list[StreamingQuery]:
    """Start every job; the caller waits on the queries, and restarts from the checkpoints after an error."""
    trigger = {"processingTime": interval}
    return start_windows(spark, layout, trigger) + start_topics(topics, score, layout, trigger, once_within)


def run_available(spark: SparkSession, topics: dict[str, DataFrame], score: Score, layout: Layout, once_within: str | None = None) -> None:
    """Process everything the topics hold now, then stop: a catch-up run with the same checkpoints.

    An error in a job is raised here.
    """
    now = {"availableNow": True}
    for query in start_topics(topics, score, layout, now, once_within):
        query.awaitTermination()
    for query in start_windows(spark, layout, now):
        query.awaitTermination()
