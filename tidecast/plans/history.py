"""Read side: history since a time, the export for a BI tool, recent posts, current state."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidecast.functions.timestamps import iso_format
from tidecast.operators.collections import ID
from tidecast.operators.state import state_get

DEFAULT_HOURS = 1
DEFAULT_POSTS = 10
AD_COLUMNS = ["type", "impressions", "clicks", "ctr", "cost", "conversions", "cost_per_conversion"]


def since(table: DataFrame, ts_col: str, asof: datetime, hours: int) -> DataFrame:
    """Rows of the last ``hours`` before ``asof``; the bound is a constant that reaches the scan."""
    return table.where(F.col(ts_col) >= F.lit(asof) - F.make_interval(hours=F.lit(hours)))


def newest_time(table: DataFrame, ts_col: str) -> datetime:
    """The newest time in a table, as an ``asof`` for history of a feed that has ended."""
    return table.agg(F.max(ts_col)).first()[0]


def viewership_history(regional: DataFrame, asof: datetime, hours: int = DEFAULT_HOURS) -> DataFrame:
    """Regional viewership in time order: timestamp, region, viewers, engagement_rate."""
    return since(regional, "event_ts", asof, hours).orderBy("event_ts", "region").select(
        iso_format(F.col("event_ts")).alias("timestamp"), "region", "viewers", "engagement_rate",
    )


def sentiment_history(windows: DataFrame, asof: datetime, hours: int = DEFAULT_HOURS) -> DataFrame:
    """Sentiment windows in time order: timestamp (window end), positive, neutral, negative, compound."""
    return since(windows, "window_end", asof, hours).orderBy("window_end").select(
        iso_format(F.col("window_end")).alias("timestamp"),
        F.col("avg_positive").alias("positive"), F.col("avg_neutral").alias("neutral"),
        F.col("avg_negative").alias("negative"), F.col("avg_compound").alias("compound"),
    )


def ads_history(ads: DataFrame, asof: datetime, hours: int = DEFAULT_HOURS) -> DataFrame:
    """Ad performance in time order: timestamp, type and the ad's six measures."""
    return since(ads, "event_ts", asof, hours).orderBy("event_ts", "type").select(
        iso_format(F.col("event_ts")).alias("timestamp"), *AD_COLUMNS,
    )


SECTIONS = {"viewership": viewership_history, "sentiment": sentiment_history, "ads": ads_history}


def export(tables: Mapping[str, DataFrame], asof: datetime, data_type: str = "all",
           hours: int = DEFAULT_HOURS) -> dict[str, DataFrame]:
    """The requested sections, each a history; a type that names no section gives none."""
    wanted = SECTIONS if data_type == "all" else {k: v for k, v in SECTIONS.items() if k == data_type}
    return {name: section(tables[name], asof, hours) for name, section in wanted.items()}


def export_rows(sections: Mapping[str, DataFrame]) -> DataFrame | None:
    """All sections as one result: section, timestamp, payload_json."""
    out = None
    for name, rows in sections.items():
        part = rows.select(
            F.lit(name).alias("section"), "timestamp",
            F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("payload_json"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def recent_posts(posts: DataFrame, limit: int = DEFAULT_POSTS) -> DataFrame:
    """The newest posts, without the store key."""
    newest = posts.orderBy(F.col("created_ts").desc(), F.col("id")).limit(limit)
    return newest.drop(ID)


def current(state: DataFrame, path: str) -> DataFrame:
    """The current record of a path; no rows where there is no data."""
    return state_get(state, path)
