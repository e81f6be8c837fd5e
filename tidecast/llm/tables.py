"""Tables of a fixed size that all tasks fill and the driver puts together: bit tables and counters."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Bits of a table of wanted hashes, and counters or bytes of a table that travel together.
WANTED_BITS, CHUNK = 1 << 26, 1 << 16


def set_bits(table: np.ndarray, hashes: np.ndarray) -> None:
    at = hashes.view(np.uint64) % np.uint64(len(table) * 8)
    np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))


def is_set(table: np.ndarray, value: int) -> bool:
    bit = value % (len(table) * 8)
    return bool(table[bit >> 3] >> (bit & 7) & 1)


def are_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) % np.uint64(len(table) * 8)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def chunk_rows(table: np.ndarray, part: int) -> pa.RecordBatch:
    """The non-empty chunks of a table, packed."""
    chunks = table.reshape(-1, min(CHUNK, len(table)))
    used = np.flatnonzero(chunks.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(np.full(len(used), part), pa.int64()),
                                       pa.array([zlib.compress(chunks[i].tobytes(), 1) for i in used], pa.binary())], names=["chunk", "part", "data"])


def merged(rows: DataFrame, size: int, kind: str, combine: np.ufunc) -> np.ndarray:
    """One table from the packed chunks of all tasks, combined in two levels so that no task meets all of them."""
    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        total = combine.reduce([np.frombuffer(zlib.decompress(d), kind) for d in frame["data"]], dtype=kind)
        return pd.DataFrame({"chunk": frame["chunk"][:1], "part": frame["part"][:1] // 32, "data": [zlib.compress(total.tobytes(), 1)]})

    for level in (F.floor(F.col("part") / 32), F.lit(0)):
        rows = rows.groupBy("chunk", level.alias("level")).applyInPandas(lambda f: fold(f), "chunk long, part long, data binary")
    out = np.zeros(size, kind).reshape(-1, min(CHUNK, size))
    for row in rows.collect():  # at most ``size`` counters
        out[row.chunk] = np.frombuffer(zlib.decompress(bytes(row.data)), kind)
    return out.reshape(-1)


def bit_table(hashes: DataFrame, bits: int = WANTED_BITS) -> np.ndarray:
    """The bit table of ``hashes``, a frame with one column of longs."""
    def mark(batches):
        table = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            set_bits(table, batch.column(0).to_numpy())
        yield chunk_rows(table, TaskContext.get().partitionId())

    return merged(hashes.mapInArrow(mark, "chunk long, part long, data binary"), bits >> 3, "u1", np.bitwise_or)


def parted(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` is for certain none of ``keys``, and the others: those whose key is, and some by chance.

    So wide rows need a shuffle only where they are among a few, whatever the sizes of both.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bit_table(keys.select(F.xxhash64(key))))

    @F.pandas_udf("boolean")
    def among(hashes: pd.Series) -> pd.Series:
        return pd.Series(are_set(shared.value, hashes.to_numpy()))

    marked = rows.withColumn("__among", among.asNondeterministic()(F.xxhash64(key)))  # asked once a row
    return marked.where("not __among").drop("__among"), marked.where("__among").drop("__among")


def looked_up(rows: DataFrame, values: DataFrame, key: str, value: str, bits: int = WANTED_BITS >> 1) -> DataFrame:
    """``rows`` with the ``value``, a small number not NULL, that ``values`` has for their ``key``, which it has once.

    There is a bit table for each number, so there should be few.  Where only one number's table has a row's bit, that is the row's; the
    others, more of them the more rows there are, are joined.
    """
    numbers = sorted(r[0] for r in values.select(value).distinct().collect())
    tables = [bit_table(values.where(F.col(value) == n).select(F.xxhash64(key)), bits) for n in numbers]
    shared = rows.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("long")
    def told(hashes: pd.Series) -> pd.Series:
        held = np.array([are_set(t, hashes.to_numpy()) for t in shared.value]).reshape(len(numbers), len(hashes))
        sure = held.sum(axis=0) == 1
        return pd.Series(np.where(sure, held.argmax(axis=0) if numbers else 0, -1))

    marked = rows.withColumn("__place", told.asNondeterministic()(F.xxhash64(key)))
    given = F.element_at(F.array(*[F.lit(n) for n in numbers] or [F.lit(0)]), (F.col("__place") + 1).cast("int"))
    sure = marked.where("__place >= 0").withColumn(value, given.cast(values.schema[value].dataType)).drop("__place")
    return sure.unionByName(marked.where("__place < 0").drop("__place").join(values.select(key, value), key))
