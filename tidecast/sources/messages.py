"""Message topics: live, replayed from files, or as a finished batch; and the decoding of their payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidecast.functions.timestamps import parse_timestamp
from tidecast.schemas import ADS, POST, VIEWERSHIP


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, min_partitions: int | None = None,
                  **extra: str) -> dict[str, str]:
    """Reader options for one topic.

    A bound per trigger keeps the first batch after an outage from growing with the outage, and
    ``min_partitions`` splits a hot topic partition over several tasks.  Security settings go in ``extra``
    with their ``kafka.`` prefix.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return {**options, **extra}


def message_stream(spark: SparkSession, source: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """A stream with one ``value`` column holding the message text.

    ``source`` is ``kafka`` (the connector of the running Spark version goes on the classpath at submit
    time), or ``parquet`` or ``text`` to replay files below ``path``.
    """
    reader = spark.readStream.options(**options)
    if source == "kafka":
        raw = reader.format("kafka").load()
    elif source == "parquet":
        raw = reader.schema("value string").parquet(path)
    elif source == "text":
        raw = reader.text(path)
    else:
        raise ValueError(f"unknown message source: {source}")
    return payload(raw)


def message_batch(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """The same replay files as a finished batch."""
    return payload(spark.read.schema("value string").format(source).load(path))


def payload(raw: DataFrame) -> DataFrame:
    """The message body as text."""
    return raw.select(F.col("value").cast("string").alias("value"))


def decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """``value`` plus the parsed ``data`` struct.  A bad field is NULL; a bad payload has only NULL fields.

    Exploding a list of one keeps a filter on the fields above the parser; pushed below it, the filter would
    parse every message a second time.
    """
    return messages.select("value", F.explode(F.array(F.from_json("value", schema))).alias("data"))


def unparsed(schema: StructType) -> Column:
    """True for a decoded message none of whose fields came through."""
    return reduce(lambda a, b: a & b, [F.col(f"data.`{f.name}`").isNull() for f in schema.fields])


def parsed_rows(decoded: DataFrame, schema: StructType, time_field: str, ts_col: str) -> DataFrame:
    """The schema's fields as columns, and ``ts_col``, the parsed form of the time text."""
    rows = decoded.where(~unparsed(schema)).select("data.*")
    return rows.withColumn(ts_col, parse_timestamp(F.col(time_field)))


def rejected(schema: StructType, time_field: str | None = None) -> Column:
    """True for a decoded message of which nothing is parsed, or (given ``time_field``) no readable time."""
    bad = unparsed(schema)
    if time_field:
        bad = bad | parse_timestamp(F.col(f"data.`{time_field}`")).isNull()
    return bad


def decode_once(messages: DataFrame, schema: StructType, time_field: str) -> DataFrame:
    """`decode` for a batch that is kept: only rejected messages keep their payload beside what was parsed."""
    return decode(messages, schema).withColumn("value", F.when(rejected(schema, time_field), F.col("value")))


def rejected_rows(decoded: DataFrame, schema: StructType, time_field: str | None = None) -> DataFrame:
    """Payloads to look at, as they came: nothing parsed, or (given ``time_field``) no readable time.

    The second kind is also among the parsed rows, with a NULL time that no window or history will hold.
    """
    return decoded.where(rejected(schema, time_field)).select("value")


def parse_messages(messages: DataFrame, schema: StructType, time_field: str, ts_col: str) -> DataFrame:
    return parsed_rows(decode(messages, schema), schema, time_field, ts_col)


def parse_rejects(messages: DataFrame, schema: StructType, time_field: str | None = None) -> DataFrame:
    return rejected_rows(decode(messages, schema), schema, time_field)


def parse_posts(messages: DataFrame) -> DataFrame:
    """Posts, with ``created_ts`` parsed from ``created_at``."""
    return parse_messages(messages, POST, "created_at", "created_ts")


def parse_viewership(messages: DataFrame) -> DataFrame:
    """Viewership messages, with ``event_ts`` parsed from ``timestamp``."""
    return parse_messages(messages, VIEWERSHIP, "timestamp", "event_ts")


def parse_ads(messages: DataFrame) -> DataFrame:
    """Advertising messages, with ``event_ts`` parsed from ``timestamp``."""
    return parse_messages(messages, ADS, "timestamp", "event_ts")
