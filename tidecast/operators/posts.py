"""Posts: recency, keywords, authors, defaults, and the normaliser of raw search responses."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.text import contains_any, keyword_tags
from tidecast.functions.timestamps import iso_format
from tidecast.operators.skew import lookup_join
from tidecast.schemas import POST_ENVELOPE, USER

# Names and defaults of the post contract.
SOURCE = "twitter"
UNKNOWN_LANGUAGE = "unknown"
RECENT_MINUTES = 15
MAX_RESULTS = 100
POST_COLUMNS = ["id", "text", "created_at", "lang", "metrics", "user", "source", "keywords", "processed_at"]


def filter_recent(posts: DataFrame, ts_col: str, asof: datetime, minutes: int = RECENT_MINUTES) -> DataFrame:
    """Posts from the last ``minutes`` before ``asof``."""
    start = F.lit(asof) - F.make_interval(mins=F.lit(minutes))
    return posts.where(F.col(ts_col) >= start)


def filter_keywords(posts: DataFrame, text_col: str, keywords: Sequence[str]) -> DataFrame:
    """Posts that hold at least one keyword, ignoring case."""
    return posts.where(contains_any(F.col(text_col), keywords))


def newest(posts: DataFrame, ts_col: str = "created_ts", id_col: str = "id", limit: int = MAX_RESULTS) -> DataFrame:
    """The ``limit`` newest posts: each task keeps its own top rows, so nothing is sorted as a whole."""
    return posts.orderBy(F.col(ts_col).desc(), F.col(id_col)).limit(limit)


def latest_users(users: DataFrame, order_col: str) -> DataFrame:
    """One row per user id, the last by ``order_col``; aggregated before the shuffle."""
    fields = [c for c in users.columns if c != order_col]
    return (
        users.groupBy("id").agg(F.max_by(F.struct(*fields), order_col).alias("user"))
        .select("id", "user")
    )


def join_authors(posts: DataFrame, users: DataFrame, order_col: str) -> DataFrame:
    """Add ``user`` to each post, NULL for an unknown author.

    Users are reduced to one entry each first; a prolific author's posts are spread, see `lookup_join`.
    """
    authors = latest_users(users, order_col).withColumnRenamed("id", "author_id")
    return lookup_join(posts, authors, "author_id")


def default_user(user: Column) -> Column:
    """The user struct with empty strings and false for what is missing."""
    text = [F.coalesce(user[name], F.lit("")).alias(name) for name in ("id", "name", "username", "location")]
    verified = F.coalesce(user["verified"], F.lit(False)).alias("verified")
    image = F.coalesce(user["profile_image_url"], F.lit("")).alias("profile_image_url")
    return F.struct(*text, verified, image).cast(USER)


def with_defaults(posts: DataFrame) -> DataFrame:
    """Fill missing language, metrics and author fields.

    A column cannot tell an absent JSON key from a null, so both get the default.
    """
    return posts.withColumns({
        "lang": F.coalesce("lang", F.lit(UNKNOWN_LANGUAGE)),
        "metrics": F.coalesce("metrics", F.create_map().cast("map<string, int>")),
        "user": default_user(F.col("user")),
    })


def with_keywords(posts: DataFrame, keywords: Sequence[str], text_col: str = "text") -> DataFrame:
    """Tag each post with the keywords it holds."""
    return posts.withColumn("keywords", keyword_tags(F.col(text_col), keywords))


def finish_posts(posts: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """(id, text, created_at, lang, metrics, user) to the post contract."""
    return with_keywords(with_defaults(posts), keywords).withColumns({
        "source": F.lit(SOURCE),
        "processed_at": iso_format(F.current_timestamp()),
    }).select(*POST_COLUMNS)


def usable_envelopes(messages: DataFrame) -> DataFrame:
    """Raw responses that carry both posts and users; the others yield nothing."""
    return (
        messages.select(F.from_json("value", POST_ENVELOPE).alias("e"))
        .select("e.data", "e.includes.users")
        .where(F.col("data").isNotNull() & F.col("users").isNotNull())
    )


def envelope_posts(messages: DataFrame) -> DataFrame:
    """One row per post of the usable responses, with its author from the same response.

    The author is looked up inside the row, so no key is shuffled and it also runs on a stream.  Where a
    response names a user twice, the later entry wins.
    """
    users = usable_envelopes(messages).withColumn("users", F.reverse("users")) \
        .withColumn("user_ids", F.col("users.id"))

    def with_author(post: Column) -> Column:
        at = F.array_position(F.col("user_ids"), post["author_id"]).cast("int") - 1
        return F.struct(
            post["id"].alias("id"), post["text"].alias("text"), post["created_at"].alias("created_at"),
            post["lang"].alias("lang"), post["author_id"].alias("author_id"),
            post["public_metrics"].alias("metrics"), F.get(F.col("users"), at).alias("user"),
        )

    return users.select(F.explode(F.transform("data", with_author)).alias("post")).select("post.*")


def normalize_posts(messages: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Raw search responses to rows of the post contract."""
    return finish_posts(envelope_posts(messages).drop("author_id"), keywords)


def dedup_posts(posts: DataFrame, key: str = "id", event_time: str = "created_ts", lateness: str = "15 minutes") -> DataFrame:
    """Each post once, however often it was fetched; posts without a key stay apart.

    A stream forgets a key ``lateness`` after its time, which covers the window that fetches overlap in.
    """
    keyed, loose = posts.where(F.col(key).isNotNull()), posts.where(F.col(key).isNull())
    if posts.isStreaming:
        return keyed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key]).unionByName(loose)
    return keyed.dropDuplicates([key]).unionByName(loose)
