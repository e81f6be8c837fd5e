"""Joins whose left side may have a third of its rows on one key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALT = "_salt"


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, salts: int = 1, spread_by: str | None = None) -> DataFrame:
    """Left join ``rows`` to ``lookup``, which has one row per key.

    In a batch, adaptive execution splits a hot key, and a lookup that statistics show to be small is broadcast, so a
    plain join is all it takes.  The plan of a stream is not adapted at run time: there a caller that expects a hot key names
    a narrow column to spread its rows by and the number of groups, and the lookup is repeated for each group.
    """
    if salts == 1:
        return rows.join(lookup, key, "left")
    left = rows.withColumn(SALT, F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    right = lookup.select("*", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias(SALT))
    return left.join(right, [key, SALT], "left").drop(SALT)
