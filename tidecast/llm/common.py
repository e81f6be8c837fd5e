"""Small helpers the operators share: tables in the shared folder, Arrow strings as bytes, 64-bit mixing."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidecast.workspace import new_folder, remove_folder

#: White space as the contracts define it: space, and the control characters tab to carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: list[list[str]] = []
#: Whether Spark removes the shuffle files of an action at its end, and not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_rows(df: DataFrame, path: str) -> None:
    """Write the rows; the shuffle files it took go at once, as the rows are read from the folder from then on."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEANUP, before) if before is not None else conf.unset(CLEANUP)


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written below the shared folder and read back: the lineage ends here and a lost executor costs a re-read."""
    path = new_folder(df.sparkSession, label)
    if _scratch:
        _scratch[-1].append(path)
    write_rows(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, work: Callable[[], DataFrame], label: str) -> tuple[DataFrame, str]:
    """The result of ``work``, written, and its folder; what `saved` wrote meanwhile is removed, as no plan that is left reads it."""
    _scratch.append([])
    try:
        rows = work()
        path = new_folder(spark, label)
        write_rows(rows, path)
        return spark.read.schema(rows.schema).parquet(path), path
    finally:
        for folder in _scratch.pop():
            remove_folder(spark, folder)


def saved_alone(spark: SparkSession, work: Callable[[], DataFrame], label: str) -> DataFrame:
    """As `saved`, of the result of ``work``; what that saved meanwhile is removed at once."""
    rows, path = settled(spark, work, label)
    if _scratch:
        _scratch[-1].append(path)
    return rows


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(value: object) -> int:
    """crc32 of the value's text, modulo 3: the fold that decides what a model may learn from."""
    return zlib.crc32(str(value).encode()) % 3


def fold_column(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3


def byte_view(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings and the offset of each; NULL counts as empty."""
    array = pc.fill_null(array, "" if not pa.types.is_binary(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind, width = (np.int64, 8) if wide else (np.int32, 4)
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind, len(array) + 1, array.offset * width).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each, so that work arrays stay small; a longer row comes alone."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


def with_columns(df: DataFrame, outputs: str, fn, inputs: list[str], twice: bool = True) -> DataFrame:
    """The rows of ``df`` with columns that ``fn(batch) -> list of arrays`` computes from Arrow batches.

    ``outputs`` is a schema string.  A column of ``df`` with the name of an output is replaced.  ``fn`` gets each batch's
    ``inputs`` (columns of ``df``, or of the frame before a clashing one is dropped).  Without ``twice`` an input that stays is sent once, not beside a copy.
    """
    from pyspark.sql.types import StructType

    added = StructType.fromDDL(outputs)
    kept = [c for c in df.columns if c not in added.names]
    given = {c: f"__in_{i}" for i, c in enumerate(inputs) if twice or c not in kept}
    at = [kept.index(c) if c not in given else len(kept) + list(given).index(c) for c in inputs]
    wide = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(n) for c, n in given.items()])
    schema = StructType([f for f in df.schema.fields if f.name in kept] + added.fields)

    def run(batches):
        for batch in batches:
            arrays = fn([batch.column(i) for i in at])
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + arrays, names=[*kept, *added.names])

    return wide.mapInArrow(run, schema)
