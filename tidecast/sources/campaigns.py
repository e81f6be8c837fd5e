"""Campaign files: flat records in JSON arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType

from tidecast.schemas import CAMPAIGN

#: A string of JSON, which never goes over a line's end, or a character that has a meaning outside of strings.
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|["{}]')
#: What may lie between records: brackets of arrays, commas, white space.
BETWEEN = re.compile(r"[\[\],\s]*")
#: Letters of whole records that a task puts into one row.
TOGETHER = 1 << 16


def read_campaigns(spark: SparkSession, path: str, one_array_per_file: bool) -> DataFrame:
    """Campaign records below ``path``.

    The caller names the layout.  Files with one array per line, and files that are one array over several lines (``one_array_per_file``), can
    both be split between tasks, see `array_records`.  The first reader takes an array over several lines, and both take a file that is no
    JSON, for an error and not for a row of NULLs.
    """
    if not one_array_per_file:
        return spark.read.schema(CAMPAIGN).option("mode", "FAILFAST").json(path)
    records = F.from_json("records", ArrayType(CAMPAIGN), {"mode": "FAILFAST"})
    return array_records(spark, path).select(F.inline(records))


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``records``: the flat records of files that are JSON arrays over several lines, as the text of arrays of some records each.

    A file is read in ranges of lines, as Spark splits text files.  A line's end is never inside a string, so strings are known from any line on; and as
    records hold no records, the first brace of a range says whether it begins within one.  Whole records leave their range at once.
    What is left are the ends of a range: the records cut there are put together from their pieces, at most two a range, in the order of ranges.

    Defined cases: an empty file or array has no records.  A record within a record, anything else but records in the array, a string or a record
    without an end, or an end without a beginning is an error.  Commas and brackets between records are not counted.  A compressed file, or one without line ends, is read by one task.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")
    pieces = lines.mapInArrow(_pieces, "file string, begin long, part int, piece string")
    cut = pieces.where("part > 0").groupBy("file").agg(F.sort_array(F.collect_list(F.struct("begin", "part", "piece"))).alias("cut"))
    mended = cut.select(F.array_join(F.col("cut.piece"), " ").alias("piece")).mapInArrow(_mended, "piece string")
    return pieces.where("part = 0").select("piece").unionByName(mended).select(F.col("piece").alias("records"))


class Range:
    """The records of a range of lines.  ``head`` is what belongs to a record begun before, ``open`` what is of one not yet ended.

    Before its first brace a range does not know whether it began within a record: all it has read is its ``head`` then.
    """

    def __init__(self) -> None:
        self.head: list[str] = []
        self.open: list[str] = []
        self.known, self.inside = False, False

    def read(self, line: str) -> Iterator[str]:
        """The records that end in this line and began in this range."""
        at = 0
        for token in TOKEN.finditer(line):
            mark = token.group()
            if mark == '"':
                raise ValueError(f"malformed array: a string without an end in {line[:200]!r}")
            if mark == "{":
                if self.inside:
                    raise ValueError(f"malformed array: a record within a record in {line[:200]!r}")
                self._between(line[at:token.start()])
                at, self.inside, self.known = token.start(), True, True
            elif mark == "}":
                own = line[at:token.end()]
                at = token.end()
                if self.inside:
                    yield " ".join([*self.open, own])
                elif not self.known:
                    self.head.append(own)
                else:
                    raise ValueError(f"malformed array: an end without a record in {line[:200]!r}")
                self.open, self.inside, self.known = [], False, True
        if self.inside:
            self.open.append(line[at:])
        else:
            self._between(line[at:])

    def _between(self, text: str) -> None:
        """Text outside of records begun here: nothing to keep, unless the record may have begun before."""
        if not self.known:
            self.head.append(text)
        elif not BETWEEN.fullmatch(text):
            raise ValueError(f"malformed array: {text[:200]!r} between records")


def _pieces(batches):
    """Whole records as part 0, several a row; what lies before a range's first record as part 1, its unfinished last record as part 2."""
    place, state, held, letters = None, Range(), [], 0

    def rows(*made: tuple[int, str]):
        return pa.RecordBatch.from_pydict(
            {"file": [place[0]] * len(made), "begin": pa.array([place[1]] * len(made), pa.int64()),
             "part": pa.array([m[0] for m in made], pa.int32()), "piece": pa.array([m[1] for m in made], pa.string())})

    def finished():
        made = [(0, f"[{','.join(held)}]")] if held else []
        return made + [(part, " ".join(text)) for part, text in ((1, state.head), (2, state.open)) if any(map(str.strip, text))]

    for batch in batches:
        for file, begin, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, begin) != place:
                if place and (made := finished()):
                    yield rows(*made)
                place, state, held, letters = (file, begin), Range(), [], 0
            for record in state.read(line):
                held.append(record)
                letters += len(record)
                if letters >= TOGETHER:
                    yield rows((0, f"[{','.join(held)}]"))
                    held, letters = [], 0
    if place and (made := finished()):
        yield rows(*made)


def _mended(batches):
    """Records from the pieces of a file that ranges cut, in order; what lies between them has to be between records."""
    for batch in batches:
        made = []
        for text in batch.column(0).to_pylist():
            state = Range()
            state.known = True
            if records := list(state.read(text)):
                made.append(f"[{','.join(records)}]")
            if state.open:
                raise ValueError(f"malformed array: a record without an end: {state.open[0][:200]!r}")
        yield pa.RecordBatch.from_pydict({"piece": pa.array(made, pa.string())})
