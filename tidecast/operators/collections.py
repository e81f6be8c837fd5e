"""Document collections: nested rows with a store key ``_id`` that grows in insertion order.

Rows without a store key are read like others, after them, but `update_one` and `delete_one` never touch them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

ID = "_id"
DEFAULT_LIMIT = 100


def matches(query: Mapping[str, Any]) -> Column:
    """Equality on each named field; nested fields are dotted, and None matches a missing value."""
    return reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.lit(value)) for name, value in query.items()],
                  F.lit(True))


def with_ids(documents: DataFrame, batch_id: int) -> DataFrame:
    """Give each document a unique store key: the batch, then task and row number within it."""
    key = F.format_string("%020d-%020d", F.lit(batch_id).cast("bigint"), F.monotonically_increasing_id())
    return documents.select(key.alias(ID), *[c for c in documents.columns if c != ID])


def find_many(collection: DataFrame, query: Mapping[str, Any], limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The first ``limit`` matches in insertion order."""
    return collection.where(matches(query)).orderBy(F.asc_nulls_last(ID)).limit(limit)


def find_one(collection: DataFrame, query: Mapping[str, Any]) -> DataFrame:
    """The first match, or no row."""
    return find_many(collection, query, 1)


def first_match(collection: DataFrame, query: Mapping[str, Any]) -> Column:
    """The store key of the first match: a minimum, so no ranking of the matches is needed."""
    return collection.where(matches(query)).agg(F.min(ID)).scalar()


def has_key(key: Column) -> Column:
    """Whether a row is the one with ``key``; a row without a store key never is."""
    return F.coalesce(F.col(ID) == key, F.lit(False))


def update_one(collection: DataFrame, query: Mapping[str, Any], changes: Mapping[str, Any]) -> DataFrame:
    """The collection with the top-level columns of ``changes`` set in the first match."""
    hit = has_key(first_match(collection, query))
    updated = {
        name: F.when(hit, F.lit(value).cast(collection.schema[name].dataType)).otherwise(F.col(name))
        for name, value in changes.items()
    }
    return collection.withColumns(updated)


def delete_one(collection: DataFrame, query: Mapping[str, Any]) -> DataFrame:
    """The collection without its first match."""
    return collection.where(~has_key(first_match(collection, query)))


def count_matched(collection: DataFrame, query: Mapping[str, Any]) -> DataFrame:
    """How many documents `update_one` or `delete_one` touches: 0 or 1."""
    return find_one(collection, query).agg(F.count("*").alias("n"))
