"""Declared schemas of the messages and of the tables.

Fixed values: field names, order and types are the feeds' and tables' contracts.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, FloatType, IntegerType, LongType, MapType, StringType, StructField,
    StructType, TimestampNTZType, TimestampType,
)


TEXT, FLAG = StringType(), BooleanType()
INT, LONG, FLOAT, DOUBLE = IntegerType(), LongType(), FloatType(), DoubleType()
TIME, NAIVE_TIME = TimestampType(), TimestampNTZType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


USER = struct(id=TEXT, name=TEXT, username=TEXT, location=TEXT, verified=FLAG, profile_image_url=TEXT)

POST = struct(
    id=TEXT, text=TEXT, created_at=TEXT, lang=TEXT, metrics=MapType(TEXT, INT), user=USER, source=TEXT,
    keywords=ArrayType(TEXT), processed_at=TEXT,
)

VIEWERSHIP = struct(
    timestamp=TEXT,
    total_viewers=INT,
    regional_data=ArrayType(struct(region=TEXT, viewers=INT, engagement_rate=FLOAT)),
    platform_data=ArrayType(struct(platform=TEXT, viewers=INT, buffer_rate=FLOAT, avg_resolution=TEXT)),
)

AD_REGION = struct(region=TEXT, impressions=INT, clicks=INT, ctr=FLOAT)
AD = struct(
    type=TEXT, impressions=INT, clicks=INT, ctr=FLOAT, cost=FLOAT, conversions=INT, cost_per_conversion=FLOAT,
    regions=ArrayType(AD_REGION),
)
ADS = struct(timestamp=TEXT, ads=ArrayType(AD))

# One response of the social search service: posts plus the users they refer to.
RAW_POST = struct(id=TEXT, text=TEXT, created_at=TEXT, lang=TEXT, author_id=TEXT, public_metrics=MapType(TEXT, INT))
POST_ENVELOPE = struct(data=ArrayType(RAW_POST), includes=struct(users=ArrayType(USER)))

CAMPAIGN = struct(campaign=TEXT, impressions=LONG, clicks=LONG, cost=DOUBLE, conversions=LONG, date=TEXT)

SENTIMENT = struct(positive=FLOAT, neutral=FLOAT, negative=FLOAT, compound=FLOAT)
SCORED_POST = StructType([*POST.fields, StructField("created_ts", TIME), StructField("sentiment", SENTIMENT)])

# Per-record warehouse tables.
VIEWERSHIP_TABLE = struct(
    id=TEXT, timestamp=NAIVE_TIME, match_id=TEXT, total_viewers=INT, region=TEXT, platform=TEXT, avg_watch_time=DOUBLE,
)
SENTIMENT_TABLE = struct(
    id=TEXT, timestamp=NAIVE_TIME, match_id=TEXT, source=TEXT, text=TEXT, compound=DOUBLE, positive=DOUBLE,
    neutral=DOUBLE, negative=DOUBLE, region=TEXT,
)
AD_PERFORMANCE_TABLE = struct(
    id=TEXT, timestamp=NAIVE_TIME, match_id=TEXT, ad_id=TEXT, type=TEXT, impressions=INT, clicks=INT, conversions=INT,
    cost=DOUBLE, ctr=DOUBLE,
)

# Latest state: one row per child of a path.
STATE = struct(path=TEXT, key=TEXT, value_json=TEXT, updated_at=TIME, batch_id=LONG)
