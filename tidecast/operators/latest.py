"""The newest record of a table, in the shape served as current state.

Sorting by time and taking one row keeps one row per task; no table is sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.functions.timestamps import iso_format
from tidecast.operators.aggregates import ads_by_type


def latest_sentiment(windows: DataFrame) -> DataFrame:
    """The window that ends last: updated_at, timestamp (ISO), positive, neutral, negative, compound."""
    return windows.orderBy(F.col("window.end").desc()).limit(1).select(
        F.col("window.end").alias("updated_at"),
        iso_format(F.col("window.end")).alias("timestamp"),
        F.col("avg_positive").alias("positive"),
        F.col("avg_neutral").alias("neutral"),
        F.col("avg_negative").alias("negative"),
        F.col("avg_compound").alias("compound"),
    )


def latest_viewership(viewership: DataFrame) -> DataFrame:
    """The newest message with both breakdowns; of two with the same time, the larger audience."""
    newest = viewership.where(F.col("event_ts").isNotNull()).orderBy(
        F.col("event_ts").desc(), F.col("total_viewers").desc_nulls_last(),
        F.to_json(F.struct("regional_data", "platform_data")),
    )
    return newest.limit(1).select(
        F.col("event_ts").alias("updated_at"), "timestamp", "total_viewers", "regional_data", "platform_data",
    )


def latest_ads(ads: DataFrame) -> DataFrame:
    """Totals per ad type, each with the newest time over all types as ``updated_at`` and ``timestamp``.

    The record's list of ads is one row per type here: however many types there are, they never have to
    fit into one value.
    """
    totals = ads_by_type(ads)
    newest = ads.agg(F.max("event_ts")).scalar()
    return totals.select(
        newest.alias("updated_at"), iso_format(newest).alias("timestamp"),
        "type", "impressions", "clicks", "ctr", "cost", "conversions", "cost_per_conversion",
    )
