"""Advertising ratios.  NULL where there is nothing to divide by, except cost without conversions, which is 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.rounding import round_half_up


def click_through_rate(clicks: Column, impressions: Column) -> Column:
    """Clicks per hundred impressions, two decimals."""
    return round_half_up(F.try_divide(clicks, impressions) * F.lit(100.0), 2)


def cost_per_conversion(cost: Column, conversions: Column) -> Column:
    """Cost per conversion, two decimals."""
    ratio = F.when(conversions > 0, F.try_divide(cost.cast("double"), conversions)).otherwise(F.lit(0.0))
    return round_half_up(ratio, 2)


def ad_metrics(ads: DataFrame) -> DataFrame:
    """Add (or replace) ``ctr`` and ``cost_per_conversion``; for flat ads and for campaign records."""
    return ads.withColumns({
        "ctr": click_through_rate(F.col("clicks"), F.col("impressions")),
        "cost_per_conversion": cost_per_conversion(F.col("cost"), F.col("conversions")),
    })


def regional_ad_metrics(regional_ads: DataFrame) -> DataFrame:
    """Add (or replace) ``ctr`` per region."""
    return regional_ads.withColumn("ctr", click_through_rate(F.col("clicks"), F.col("impressions")))
