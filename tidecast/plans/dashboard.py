"""Dashboard visuals: counts and money are summed, rates averaged.

Those that sum or average take rows, or sums of them that the jobs maintain (`streaming/partials.py`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.functions.averages import mean
from tidecast.functions.timestamps import iso_format
from tidecast.operators.latest import latest_viewership


def card_total_viewers(viewership: DataFrame) -> DataFrame:
    """The newest total."""
    return latest_viewership(viewership).select("timestamp", "total_viewers")


def viewers_by_region(regional: DataFrame) -> DataFrame:
    return regional.groupBy("region").agg(F.sum("viewers").alias("viewers"))


def viewers_over_time(viewership: DataFrame) -> DataFrame:
    totals = viewership.groupBy("event_ts").agg(F.sum("total_viewers").alias("total_viewers"))
    return totals.orderBy("event_ts").select(iso_format(F.col("event_ts")).alias("timestamp"), "total_viewers")


def card_compound(windows: DataFrame) -> DataFrame:
    return windows.agg(mean(windows, "avg_compound").alias("compound"))


def sentiment_trend(windows: DataFrame) -> DataFrame:
    return windows.orderBy("window_end").select(
        iso_format(F.col("window_end")).alias("timestamp"), F.col("avg_positive").alias("positive"),
        F.col("avg_neutral").alias("neutral"), F.col("avg_negative").alias("negative"),
    )


def sentiment_by_region(records: DataFrame) -> DataFrame:
    """From the per-record sentiment table: only that one knows a region."""
    return records.groupBy("region").agg(mean(records, "positive").alias("positive"))


def card_ctr(ads: DataFrame) -> DataFrame:
    """The average rate, and the rate of the sums."""
    weighted = F.try_divide(F.sum("clicks"), F.sum("impressions")) * F.lit(100.0)
    return ads.agg(mean(ads, "ctr").alias("ctr"), weighted.alias("weighted_ctr"))


def ad_performance_by_type(ads: DataFrame) -> DataFrame:
    return ads.groupBy("type").agg(
        F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
    )


def ad_cost_over_time(ads: DataFrame) -> DataFrame:
    costs = ads.groupBy("event_ts").agg(F.sum("cost").alias("cost"))
    return costs.orderBy("event_ts").select(iso_format(F.col("event_ts")).alias("timestamp"), "cost")
