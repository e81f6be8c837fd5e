"""Sums that are kept up to date: a small delta per batch, put together when read.

A table holds, by key and time, sums of some columns and, for columns that are averaged, also the number of their values.  A batch adds
one row for each key and time that it meets, however many rows it has, so what is written follows what has changed.  The deltas are
an `EventTable`: each batch counts once, also when it is repeated, and the log tells a reader which folders to open.  ``merge`` leaves one
row per key and time of a period.

A sum keeps its column's name, and the number of its values is ``n_<name>``; so what sums up rows sums up deltas just as well, and
`functions.averages.mean` is the average of either.

Late rows count, whatever their time; rows without a time are kept apart and are in every unbounded answer.  A table begins with the batch it is first
written in: to begin one beside a table that has rows, write ``kind.delta(rows)`` of these as batch 0 of a run of its own before the job starts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.functions.averages import COUNT
from tidecast.streaming.sinks import BatchWriter, run_of
from tidecast.streaming.tables import EventTable, period_start


@dataclass(frozen=True)
class Kind:
    """What a table adds up.  ``grain``: the period of time that shares a row, which has the newest time of its rows; without one each time has its own."""

    time: str
    keys: tuple[str, ...] = ()
    sums: tuple[str, ...] = ()
    averages: tuple[str, ...] = ()
    grain: str | None = None

    def _added(self, rows: DataFrame, number: str) -> DataFrame:
        values = [F.sum(c).alias(c) for c in (*self.sums, *self.averages)]
        numbers = [(F.count(c) if number == "rows" else F.sum(COUNT + c)).alias(COUNT + c) for c in self.averages]
        if self.grain is None:
            return rows.groupBy(self.time, *self.keys).agg(*values, *numbers)
        period = period_start(F.col(self.time), self.grain).alias("__period")
        return rows.groupBy(period, *self.keys).agg(F.max(self.time).alias(self.time), *values, *numbers).drop("__period")

    def delta(self, rows: DataFrame) -> DataFrame:
        """The sums of rows; partial before its shuffle, so a hot key is a row per task."""
        return self._added(rows, "rows")

    def combined(self, deltas: DataFrame) -> DataFrame:
        """Deltas, one row per key and time."""
        return self._added(deltas, "deltas")


class PartialTable(EventTable):
    """The table of one kind of sums."""

    def __init__(self, spark: SparkSession, root: str, kind: Kind, period: str = "day") -> None:
        if kind.grain not in (None, period):
            raise ValueError(f"sums over a {kind.grain} do not lie in folders of a {period}")
        super().__init__(spark, root, kind.time, None, period)
        self.kind = kind

    def compacted(self, rows: DataFrame) -> DataFrame:
        return self.kind.combined(rows)

    def adder(self, rows_of=lambda batch: batch) -> BatchWriter:
        """A writer that adds ``rows_of(batch)``; a batch that is committed is not computed again."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.write(self.kind.delta(rows_of(batch)), batch_id, run_of(batch))
        return write
