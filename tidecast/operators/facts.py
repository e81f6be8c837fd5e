"""Per-record warehouse tables with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidecast.schemas import AD_PERFORMANCE_TABLE, SENTIMENT_TABLE, VIEWERSHIP_TABLE

# Table names.
TABLES = {
    "VIEWERSHIP": VIEWERSHIP_TABLE,
    "SENTIMENT": SENTIMENT_TABLE,
    "AD_PERFORMANCE": AD_PERFORMANCE_TABLE,
}


def conform(records: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in order and type; one the records lack is NULL."""
    have = set(records.columns)
    return records.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def create_tables(spark: SparkSession, location: str, database: str = "default") -> None:
    """Create the warehouse tables that do not exist yet, as parquet below ``location``."""
    for name, schema in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet "
            f"LOCATION '{location.rstrip('/')}/{name.lower()}'"
        )


def viewership_records(records: DataFrame) -> DataFrame:
    return conform(records, VIEWERSHIP_TABLE)


def sentiment_records(records: DataFrame) -> DataFrame:
    return conform(records, SENTIMENT_TABLE)


def ad_performance_records(records: DataFrame) -> DataFrame:
    return conform(records, AD_PERFORMANCE_TABLE)


def store(records: DataFrame, path: str, schema: StructType) -> None:
    """Append records to the table at ``path``."""
    conform(records, schema).write.mode("append").parquet(path)
