"""Event-time windows of sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.functions.averages import mean

# Window length and how late a post may be.
WINDOW = "5 minutes"
LATENESS = "10 minutes"
SCORES = ("positive", "neutral", "negative", "compound")


def sentiment_windows(posts: DataFrame, ts_col: str = "created_ts", window: str = WINDOW,
                      lateness: str = LATENESS) -> DataFrame:
    """Average scores per tumbling window: window, avg_positive, avg_neutral, avg_negative, avg_compound.

    On a stream the watermark lets finished windows leave the state; on a batch it has no meaning.  Only time
    and scores enter the aggregate, and it is partial before the shuffle, so a busy window is a few rows.
    """
    scores = posts.select(ts_col, "sentiment")
    if scores.isStreaming:
        scores = scores.withWatermark(ts_col, lateness)
    return scores.groupBy(F.window(ts_col, window).alias("window")).agg(
        F.avg("sentiment.positive").alias("avg_positive"),
        F.avg("sentiment.neutral").alias("avg_neutral"),
        F.avg("sentiment.negative").alias("avg_negative"),
        F.avg("sentiment.compound").alias("avg_compound"),
    )


def window_scores(posts: DataFrame, ts_col: str = "created_ts", window: str = WINDOW) -> DataFrame:
    """Each post's scores with the window it falls in; posts without a time are in none."""
    scores = posts.select(F.window(ts_col, window).alias("window"), "sentiment.*")
    return scores.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *SCORES)


def merged_windows(sums: DataFrame) -> DataFrame:
    """The table form of all windows, open ones too, from sums of `window_scores`."""
    return sums.groupBy("window_start", "window_end").agg(*[mean(sums, s).alias(f"avg_{s}") for s in SCORES])


def flat_windows(windows: DataFrame) -> DataFrame:
    """The table form: window_start, window_end and the averages."""
    return windows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "avg_positive", "avg_neutral", "avg_negative", "avg_compound",
    )
