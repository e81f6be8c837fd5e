"""Tables that a micro-batch may be written to twice without harm.

All rows are written by the executors; errors end the query, and the restart repeats the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidecast.schemas import STATE

RUN, BATCH = "run", "batch_id"
BatchWriter = Callable[[DataFrame, int], None]


def run_of(rows: DataFrame) -> str:
    """The id of the streaming query whose batch this is.

    It lives in the query's checkpoint: restarts keep it, a new checkpoint, which numbers its batches from 0 again, has a new one.
    """
    return rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def write_batch(rows: DataFrame, table: str, batch_id: int, sort_by: Sequence[str] = (), run: str | None = None) -> None:
    """Write one batch of a run to a folder of its own, replacing what an earlier attempt left there.

    ``sort_by`` sorts within each task only, so that a time filter can skip row groups.
    """
    run = run or run_of(rows)
    if sort_by:
        rows = rows.sortWithinPartitions(*sort_by)
    rows.write.mode("overwrite").parquet(f"{table}/{RUN}={run}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """All batches of all runs of a table, without their numbers."""
    reader = spark.read.option("basePath", table)
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(table).drop(RUN, BATCH)


def batch_writer(table: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                 sort_by: Sequence[str] = ()) -> BatchWriter:
    """A writer that appends ``transform(batch)`` to a table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch) if transform else batch, table, batch_id, sort_by)
    return write


def fan_out(prepare: Callable[[DataFrame], DataFrame], writers: Sequence[BatchWriter]) -> BatchWriter:
    """Prepare a batch once and hand it to several writers.

    The prepared batch is kept in memory or on disk while they run; blocks of a lost executor are
    recomputed from the source.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        prepared = prepare(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for writer in writers:
                writer(prepared, batch_id)
        finally:
            prepared.unpersist()
    return write


class StateTable:
    """Latest state in versions, one per batch, of which the last ``keep`` are kept.

    A version is a batch of a run (see `run_of`).  Versions of all runs are numbered in the order of their first commit, so a new run,
    whose batches start at 0 again, continues from the newest state of any run.  A version counts once it is logged, which
    happens last, so readers never see half a version, and a repeated batch starts from the same predecessor and replaces the
    same version.  Versions take turns in ``keep`` folders, so the table does not grow with the number of batches; a reader
    has that many batches' time.  Commit every batch, changed or not, so that a version never meets its own
    predecessor's folder.  State holds current values only, a few rows per path, so a full copy is cheap.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 32, run: str = "none"):
        self.spark, self.root, self.log, self.keep, self.run = spark, root, f"{root}/committed", keep, run
        # A hidden marker makes the log's folder exist without counting as an entry.
        spark.createDataFrame([], "marker int").write.mode("ignore").parquet(f"{self.log}/_created")

    def entries(self) -> DataFrame:
        return (self.spark.read.schema("number bigint, run string, version bigint").option("ignoreMissingFiles", "true")
                .parquet(self.log))

    def newest(self, before: int | None = None) -> tuple[int, str, int] | None:
        """Number, run and batch of the newest version, leaving out this run's from ``before`` on."""
        log = self.entries()
        if before is not None:
            log = log.where((F.col("run") != self.run) | (F.col("version") < before))
        found = log.agg(F.max(F.struct("number", "run", "version")).alias("top")).first().top
        return tuple(found) if found else None

    def version(self, before: int | None = None) -> int | None:
        found = self.newest(before)
        return found[2] if found else None

    def read(self, before: int | None = None) -> DataFrame:
        """The newest state, or the one that batch ``before`` of this run starts from; empty if there is none."""
        found = self.newest(before)
        if found is None:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.root}/slot={found[0] % self.keep}")

    def commit(self, state: DataFrame, version: int) -> None:
        own = self.entries().where((F.col("run") == self.run) & (F.col("version") == version)).agg(F.max("number")).first()[0]
        newest = self.newest()
        number = own if own is not None else newest[0] + 1 if newest else 0
        slot = f"slot={number % self.keep}"
        state.write.mode("overwrite").parquet(f"{self.root}/{slot}")
        logged = self.spark.range(1).select(F.lit(number).cast("bigint").alias("number"), F.lit(self.run).alias("run"),
                                            F.lit(version).cast("bigint").alias("version"))
        logged.coalesce(1).write.mode("overwrite").parquet(f"{self.log}/{slot}")
