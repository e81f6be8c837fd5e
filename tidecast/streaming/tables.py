"""Tables of events in folders by time, with a log of what has been committed.

    kind=batch/write=<run>-<batch>/event_date=<start of a period>/      what one micro-batch of a run wrote
    kind=merged/write=<name>/event_date=<start of a period>/            batches of a period, put together
    _log/commit=<name>/                                                 a small file per commit
    _staging/<name>/                                                    not yet committed

A batch is written aside, moved into its place as a whole folder and then logged; whichever of these steps a failure comes after, the
repeated batch goes on from there and is in the table once.  A reader takes the folders to read from the log, with the least and greatest time of
each, so it opens only what can hold the times asked for, lists nothing, and never meets a folder that is being written.  A stream may follow
``kind=batch``: folders appear there complete and once.

A table that has been merged holds a folder per period with files of full size.  Merging is one commit that adds the new folders and removes the old;
`fold_log` then replaces the commits so far by one.  One merge or fold runs at a time; batches may be written meanwhile.

Moving a folder has to be atomic, as it is on HDFS and on object stores with a hierarchical namespace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidecast.streaming.sinks import BatchWriter, run_of
from tidecast.workspace import has_files, make_folder, move_folder, remove_folder, subfolders

DATE, WRITE, KIND = "event_date", "write", "kind"
PLACE = f"{DATE} date, {WRITE} string, {KIND} string"
ADD, REMOVE, MARK = "add", "remove", "mark"
ENTRY = "entry string, run string, batch_id bigint, folder string, event_date date, least timestamp, most timestamp, n bigint, columns string"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def period_start(time: Column, period: str) -> Column:
    """The first day of a time's period (``day``, ``week``, ``month``, ``quarter`` or ``year``), counted in UTC whatever the session's zone."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))
    return day if period == "day" else F.trunc(day, period)


class EventTable:
    """``ts_col``: the event time; without one, and for rows whose time is NULL, there is a folder without a date.

    ``schema`` is only needed to read a table into which nothing has been committed.
    """

    def __init__(self, spark: SparkSession, root: str, ts_col: str | None, schema: StructType | None = None, period: str = "day") -> None:
        self.spark, self.root, self.ts_col, self.schema, self.period = spark, root, ts_col, schema, period

    # --- the log

    def entries(self) -> DataFrame:
        """All log rows; one that is in a commit and in its fold counts once."""
        if not subfolders(self.spark, f"{self.root}/_log"):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(f"{self.root}/_log/*").dropDuplicates()

    def live(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """Folders that make up the table, if they can hold times from ``since`` to ``until``.  Rows without a time are in no bounded answer."""
        log = self.entries()
        added = log.where(F.col("entry") == ADD)
        if since is not None:
            added = added.where(F.col("most") >= F.lit(since))
        if until is not None:
            added = added.where(F.col("least") <= F.lit(until))
        gone = log.where(F.col("entry") == REMOVE).select("folder", F.col(DATE).alias("gone_date"))
        return added.join(gone, (added.folder == gone.folder) & added[DATE].eqNullSafe(gone.gone_date), "left_anti")

    def committed(self, run: str, batch_id: int) -> bool:
        """Whether a batch is in the log: as a commit of its own, or below a run's last batch in a fold."""
        if has_files(self.spark, f"{self.root}/_log/commit={run}-{batch_id}", "part-"):
            return True
        folds = [name for name in subfolders(self.spark, f"{self.root}/_log") if name.startswith("commit=fold-")]
        if not folds:
            return False
        marks = self.spark.read.schema(ENTRY).parquet(*(f"{self.root}/_log/{name}" for name in folds))
        return not marks.where((F.col("entry") == MARK) & (F.col("run") == run) & (F.col("batch_id") >= batch_id)).isEmpty()

    def newest(self) -> datetime | None:
        """The greatest time in the table, from the log alone."""
        micros = self.live().agg(F.max(F.unix_micros("most"))).first()[0]
        return None if micros is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)

    def _log(self, name: str, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_log/commit={name}")

    def _added(self, folder: str, schema: StructType) -> DataFrame:
        """Log rows for the periods of a folder that is in its place: only the time column of what was just written is read."""
        written = self.spark.read.schema(StructType(schema.fields).add(DATE, "date")).parquet(f"{self.root}/{folder}")
        time = F.col(self.ts_col) if self.ts_col else F.lit(None).cast("timestamp")
        stats = written.groupBy(DATE).agg(F.min(time).alias("least"), F.max(time).alias("most"), F.count(F.lit(1)).alias("n"))
        return self._rows(stats.withColumns({"entry": F.lit(ADD), "folder": F.lit(folder)}))

    def _rows(self, rows: DataFrame) -> DataFrame:
        """Log rows with NULL for what is not given."""
        given = set(rows.columns)
        kinds = [part.split(" ") for part in ENTRY.split(", ")]
        return rows.select(*(F.col(c).cast(t) if c in given else F.lit(None).cast(t).alias(c) for c, t in kinds))

    # --- writing

    def _place(self, rows: DataFrame, name: str, folder: str) -> None:
        """Write rows aside and move them into their place.  Rebalancing gives periods files of full size, and splits a period that has more rows."""
        time = F.col(self.ts_col) if self.ts_col else F.lit(None).cast("timestamp")
        rows = rows.withColumn(DATE, period_start(time, self.period)).hint("rebalance", DATE)
        rows = rows.sortWithinPartitions(DATE, *([self.ts_col] if self.ts_col else []))
        staged, target = f"{self.root}/_staging/{name}", f"{self.root}/{folder}"
        rows.write.mode("overwrite").partitionBy(DATE).parquet(staged)
        make_folder(self.spark, target.rsplit("/", 1)[0])
        move_folder(self.spark, staged, target)

    def write(self, rows: DataFrame, batch_id: int, run: str | None = None) -> None:
        """Commit one batch of a run; a batch that is in the table is left as it is."""
        run = run or run_of(rows)
        name = f"{run}-{batch_id}"
        folder = f"{KIND}=batch/{WRITE}={name}"
        if self.committed(run, batch_id):
            return
        if not subfolders(self.spark, f"{self.root}/{folder}") and not has_files(self.spark, f"{self.root}/{folder}"):
            self._place(rows, name, folder)
        mark = self.spark.range(1).select(F.lit(MARK).alias("entry"), F.lit(run).alias("run"), F.lit(batch_id).alias("batch_id"), F.lit(rows.schema.json()).alias("columns"))
        self._log(name, self._added(folder, rows.schema).unionByName(self._rows(mark)))

    def writer(self, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
        """A writer that appends ``transform(batch)``; a batch that is committed is not computed again."""
        def write(batch: DataFrame, batch_id: int) -> None:
            self.write(transform(batch) if transform else batch, batch_id, run_of(batch))
        return write

    # --- reading

    def columns(self) -> StructType:
        """The table's columns: as given, or as the last batch had them."""
        if self.schema is not None:
            return self.schema
        found = self.entries().where(F.col("columns").isNotNull()).agg(F.max_by("columns", "batch_id")).first()[0]
        if found is None:
            raise ValueError(f"nothing is committed in {self.root}, and no schema is given")
        return StructType.fromJson(json.loads(found))

    def _paths(self, entries: DataFrame) -> list[str]:
        """Folders to read: at most one for each period and commit that has not been merged."""
        found = entries.select("folder", F.col(DATE).cast("string").alias("d")).collect()
        return sorted(f"{self.root}/{r.folder}/{DATE}={r.d or NO_DATE}" for r in found)

    def read(self, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        """The rows, or those from ``since`` to ``until`` (both included): whole folders are left out by the log and by date, then row groups by time."""
        return self._read(self._paths(self.live(since, until)), since, until)

    def _read(self, paths: list[str], since: datetime | None = None, until: datetime | None = None) -> DataFrame:
        schema = self.columns()
        if not paths:
            return self.spark.createDataFrame([], schema)
        placed = StructType([*schema.fields, *self.spark.createDataFrame([], PLACE).schema.fields])
        rows = self.spark.read.schema(placed).option("basePath", self.root).parquet(*paths)
        if since is not None:
            rows = rows.where((F.col(DATE) >= period_start(F.lit(since), self.period)) & (F.col(self.ts_col) >= F.lit(since)))
        if until is not None:
            rows = rows.where((F.col(DATE) <= period_start(F.lit(until), self.period)) & (F.col(self.ts_col) <= F.lit(until)))
        return rows.select(*schema.names)

    def follow(self, files_per_trigger: int | None = None) -> DataFrame:
        """The batches as a stream; the table may still be empty, but its schema must be known.

        ``files_per_trigger`` bounds the first batch of a reader that has fallen behind.
        """
        place = f"{self.root}/{KIND}=batch"
        make_folder(self.spark, place)
        schema = self.columns()
        reader = self.spark.readStream.schema(StructType([*schema.fields, *self.spark.createDataFrame([], f"{WRITE} string, {DATE} date").schema.fields]))
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        return reader.parquet(place).select(*schema.names)

    # --- upkeep

    def merge(self, before: date | None = None, least: int = 2) -> int:
        """Put the folders of each period together, if it has ``least`` of them and starts before ``before``; returns how many folders went."""
        live = self.live()
        if before is not None:
            live = live.where(F.col(DATE) < F.lit(before))
        many = live.groupBy(DATE).agg(F.count(F.lit(1)).alias("folders")).where(F.col("folders") >= least).select(F.col(DATE).alias("d"))
        old = live.join(many, live[DATE].eqNullSafe(many.d), "left_semi").select("folder", DATE).persist()
        try:
            paths = self._paths(old)
            if not paths:
                return 0
            name, schema = uuid.uuid4().hex, self.columns()
            folder = f"{KIND}=merged/{WRITE}={name}"
            self._place(self.compacted(self._read(paths)), name, folder)
            self._log(f"merge-{name}", self._added(folder, schema).unionByName(self._rows(old.withColumn("entry", F.lit(REMOVE)))))
            return len(paths)
        finally:
            old.unpersist()

    def compacted(self, rows: DataFrame) -> DataFrame:
        """What `merge` writes for the rows of its periods."""
        return rows

    def fold_log(self) -> None:
        """Replace the commits so far by one: the live folders, each run's last batch, and what was removed from commits that still lie there."""
        names = subfolders(self.spark, f"{self.root}/_log")
        if not names:
            return
        log = self.spark.read.schema(ENTRY).parquet(*(f"{self.root}/_log/{n}" for n in names)).dropDuplicates()
        added, removed = log.where(F.col("entry") == ADD), log.where(F.col("entry") == REMOVE)

        def same(a: DataFrame, b: DataFrame) -> Column:
            return (a.folder == b.folder) & a[DATE].eqNullSafe(b[DATE])

        last = log.where(F.col("entry") == MARK).groupBy("run").agg(F.max(F.struct("batch_id", "columns")).alias("m"))
        last = last.select(F.lit(MARK).alias("entry"), "run", "m.batch_id", "m.columns")
        kept = added.join(removed, same(added, removed), "left_anti").unionByName(removed.join(added, same(removed, added), "left_semi"))
        self._log(f"fold-{uuid.uuid4().hex}", kept.unionByName(self._rows(last)))
        for name in names:
            remove_folder(self.spark, f"{self.root}/_log/{name}")

    def vacuum(self, older_than: timedelta) -> int:
        """Remove folders that were merged or never committed, if nothing was written to them for that long; readers and streams must be past them by then."""
        live = {r.folder for r in self.live().select("folder").distinct().collect()}
        gone = 0
        for kind in (f"{KIND}=batch", f"{KIND}=merged", "_staging"):
            for name in subfolders(self.spark, f"{self.root}/{kind}", older_than):
                if f"{kind}/{name}" not in live:
                    remove_folder(self.spark, f"{self.root}/{kind}/{name}")
                    gone += 1
        return gone
