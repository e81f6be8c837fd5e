"""Nested breakdowns to rows.  A message with a NULL or empty list yields no rows.

All of these are narrow: they run inside the scan's stage, on batch and streaming input alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Columns that say when a message was sent, carried to every row.
TIME = ["timestamp", "event_ts"]


def regional_viewership(viewership: DataFrame) -> DataFrame:
    """timestamp, event_ts, region, viewers, engagement_rate"""
    return viewership.select(*TIME, F.inline("regional_data"))


def platform_viewership(viewership: DataFrame) -> DataFrame:
    """timestamp, event_ts, platform, viewers, buffer_rate, avg_resolution"""
    return viewership.select(*TIME, F.inline("platform_data"))


def ads_flat(ads: DataFrame) -> DataFrame:
    """timestamp, event_ts, type, impressions, clicks, ctr, cost, conversions, cost_per_conversion"""
    return ads.select(*TIME, F.inline("ads")).drop("regions")


def regional_ads(ads: DataFrame) -> DataFrame:
    """timestamp, event_ts, type, region, impressions, clicks, ctr: two levels, keeping the ad's type"""
    per_ad = ads.select(*TIME, F.explode("ads").alias("ad"))
    return per_ad.select(*TIME, F.col("ad.type").alias("type"), F.inline("ad.regions"))
