"""Latest state by path, as a table with one row per child: (path, key, value_json, updated_at, batch_id).

A path names a list of children, and a child may be a path itself (``ads`` and ``ads/ads``).  Each operator
takes the old state and returns the new one; `tidecast.streaming.sinks.StateTable` stores it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidecast.schemas import STATE

COLUMNS = [field.name for field in STATE.fields]


def json_value(value: Column) -> Column:
    """Any column as the JSON text of its value."""
    listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def children(records: DataFrame, path: str, fields: Sequence[str], updated_at: str = "updated_at",
             batch_id: int = 0) -> DataFrame:
    """One state row per field of each record: the field's name is the key."""
    entries = F.array(*[F.struct(F.lit(f).alias("key"), json_value(F.col(f)).alias("value_json")) for f in fields])
    return records.select(
        F.lit(path).alias("path"), F.inline(entries),
        F.col(updated_at).alias("updated_at"), F.lit(batch_id).cast("bigint").alias("batch_id"),
    ).select(*COLUMNS)


def keyed_children(records: DataFrame, path: str, key: str, fields: Sequence[str],
                   updated_at: str = "updated_at", batch_id: int = 0) -> DataFrame:
    """One state row per record: ``key`` names the child, its value is the object of ``fields``."""
    return records.select(
        F.lit(path).alias("path"), F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value_json"),
        F.col(updated_at).alias("updated_at"), F.lit(batch_id).cast("bigint").alias("batch_id"),
    )


def below(path: str) -> Column:
    """Rows of a path and of everything under it, including the entry for the path in its parent."""
    parent, _, name = path.rpartition("/")
    own = (F.col("path") == path) | F.col("path").startswith(path + "/")
    return own | ((F.col("path") == parent) & (F.col("key") == name)) if parent else own


def state_update(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Merge: named children are replaced, others kept.

    The newest (updated_at, batch_id) wins, whatever order the rows arrive in, so merging a batch again
    changes nothing.  Grouped with a partial aggregate, so a child updated very often does not pile up.
    """
    newest = F.max_by(F.struct("value_json", "updated_at", "batch_id"),
                      F.struct("updated_at", "batch_id", "value_json"))
    merged = state.select(*COLUMNS).unionByName(changes.select(*COLUMNS))
    return merged.groupBy("path", "key").agg(newest.alias("n")).select("path", "key", "n.*").select(*COLUMNS)


def state_set(state: DataFrame, path: str, replacement: DataFrame) -> DataFrame:
    """Replace everything under ``path`` by the rows of ``replacement``."""
    return state.where(~below(path)).select(*COLUMNS).unionByName(replacement.select(*COLUMNS))


def state_push(state: DataFrame, path: str, values: DataFrame, batch_id: int) -> DataFrame:
    """Append each row of ``values`` (value_json, updated_at) under a generated key.

    Keys are unique and grow with the batch; they come from the task and row number, without a sort.
    """
    key = F.format_string("%020d-%020d", F.lit(batch_id).cast("bigint"), F.monotonically_increasing_id())
    pushed = values.select(
        F.lit(path).alias("path"), key.alias("key"), "value_json", "updated_at",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
    )
    return state.select(*COLUMNS).unionByName(pushed)


def state_delete(state: DataFrame, path: str) -> DataFrame:
    """Remove a path and everything under it."""
    return state.where(~below(path)).select(*COLUMNS)


def state_get(state: DataFrame, path: str) -> DataFrame:
    """The children of a path and of the paths under it; no rows where there is nothing."""
    return state.where(below(path)).select(*COLUMNS)
