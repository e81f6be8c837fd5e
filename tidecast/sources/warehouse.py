"""SQL over the stored tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def warehouse_sql(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None,
                  args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a query; ``{name}`` in it refers to ``tables``, ``:name`` to ``args``.

    The result stays a DataFrame.  Values belong in ``args``, never in the SQL text.
    """
    return spark.sql(sql, args=dict(args or {}), **(tables or {}))
