"""Grouped aggregates; each is a partial aggregate before its one shuffle, so a hot group costs little."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidecast.functions.averages import mean


def ads_by_type(ads: DataFrame) -> DataFrame:
    """Totals and average rates per ad type, with the time of its newest message; from ads or from sums of them."""
    return ads.groupBy("type").agg(
        F.max("event_ts").alias("event_ts"),
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        mean(ads, "ctr").alias("ctr"),
        F.sum("cost").alias("cost"),
        F.sum("conversions").alias("conversions"),
        mean(ads, "cost_per_conversion").alias("cost_per_conversion"),
    )
