"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed into the phrases of the Lempel-Ziv dictionary (each phrase is the shortest string from here on that the
dictionary lacks).  The phrases are hashed, and the set of hashes is described by one smallest hash in each of ``BINS`` bins;
an empty bin takes the value of the next filled one.  The share of bins that agree estimates how alike two texts' phrase sets are.

``edited`` also fingerprints each text with its last half replaced by the beginning of the next document.  Documents are
dealt by ranges of the key, so the next document is nearly always in the same task; only the first and last document of each
task are joined afterwards.

Defined cases: a NULL text is empty; an empty text has no phrases and an all-zero fingerprint, which is alike only to itself.
Equal texts have equal fingerprints.  Equal keys follow each other in the order of a hash of their text.  A NULL key comes
after all others (descending order).  A single document is its own next one.  Texts are read whole.  Only the key is kept of
the input's columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidecast.llm.common import mix, powers, saved, text_of

BINS = 128
BASE = 0x9E3779B97F4A7C15 | 1
POWERS = powers(BASE, 1 << 12)


def parse(text: str, seen: set[str], starts: list[int], at: int = 0) -> None:
    """Add the phrases of ``text`` to ``seen`` and where each begins, shifted by ``at``, to ``starts``; an unfinished one is left out."""
    begin = 0
    for end in range(1, len(text) + 1):
        phrase = text[begin:end]
        if phrase not in seen:
            seen.add(phrase)
            starts.append(at + begin)
            begin = end
    starts.append(at + begin)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def signature(points: np.ndarray, starts: list[int]) -> np.ndarray:
    """16 bits for each bin; all zero without a phrase."""
    out = np.zeros(BINS, "<u2")
    if len(starts) < 2:
        return out
    begins = np.array(starts, dtype=np.int64)
    lengths = np.diff(begins)
    inside = np.arange(begins[-1]) - np.repeat(begins[:-1], lengths)
    weights = POWERS if lengths.max() <= len(POWERS) else powers(BASE, int(lengths.max()))
    sums = np.add.reduceat((points[:begins[-1]].astype(np.uint64) + np.uint64(1)) * weights[inside], begins[:-1])
    hashes = np.sort(mix(sums + lengths.astype(np.uint64)))
    bins = (hashes >> np.uint64(57)).astype(np.int64)
    first = np.searchsorted(bins, np.arange(BINS))
    filled = first < len(bins)
    filled[filled] = bins[first[filled]] == np.flatnonzero(filled)
    own = np.flatnonzero(filled)
    values = (mix(hashes[first[own]]) % np.uint64(65535)).astype(np.uint16) + 1
    # An empty bin borrows from the next filled one, around the end, and mixes in how far that is.
    take = np.searchsorted(own, np.arange(BINS)) % len(own)
    away = ((own[take] - np.arange(BINS)) % BINS).astype(np.uint32)
    return ((values[take].astype(np.uint32) + 509 * away - 1) % 65535 + 1).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


class Document:
    """A text's parse, kept until the next document is known."""

    def __init__(self, key: object, text: str) -> None:
        self.key, self.text = key, text
        self.cut = len(text) - len(text) // 2
        seen, starts = set(), []
        parse(text[:self.cut], seen, starts)
        # Phrases of the first part serve the text itself and its edited form.
        self.seen, self.head = seen.copy(), starts[:]
        at = starts.pop()
        parse(text[at:], seen, starts, at)
        self.print = signature(code_points(text), starts)

    def row(self, after: "Document") -> tuple:
        changed = self.text[:self.cut] + after.text[:len(self.text) // 2]
        starts = self.head[:]
        at = starts.pop()
        parse(changed[at:], self.seen, starts, at)
        edited = signature(code_points(changed), starts)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        return (self.key, len(self.text), digest, self.print.tobytes(), edited.tobytes(), likeness(self.print, edited), likeness(self.print, after.print))


OUTPUT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, fingerprint of the text, fingerprint of the edited text, and their likeness (see the module's text)."""
    key_type = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))
    rows = rows.repartitionByRange(F.desc("doc_id"), F.xxhash64("text")).sortWithinPartitions(F.desc("doc_id"), F.xxhash64("text"))

    def work(batches):
        task, first, held = TaskContext.get().partitionId(), None, None
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                here = Document(name, words.as_py())
                if held is not None:
                    out.append(held.row(here))
                else:
                    first = here
                held = here
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), [kind, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()])]
                yield pa.RecordBatch.from_arrays(columns + [pa.nulls(len(out), t) for t in (pa.int64(), pa.string(), pa.string())], names=names)
        if held is not None:
            # The text of the task's last document, and of its first, to be joined with those of its neighbours.
            yield pa.RecordBatch.from_arrays([pa.array([held.key], kind), *[pa.nulls(1, t) for t in kinds[1:]], pa.array([task], pa.int64()),
                                              pa.array([held.text]), pa.array([first.text])], names=names)

    kinds = [None, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "task", "last_text", "first_text"]
    found = saved(rows.mapInArrow(work, f"doc_id {key_type}, {OUTPUT}, task long, last_text string, first_text string"), "fingerprints")
    edges = found.where("task is not null")
    tasks = sorted(r.task for r in edges.select("task").collect())  # one number a task
    following = docs.sparkSession.createDataFrame(list(zip(tasks, tasks[1:] + tasks[:1])), "task long, next long")
    pairs = (edges.join(following, "task")
             .join(edges.select(F.col("task").alias("next"), F.col("first_text").alias("next_text")), "next")
             .select("doc_id", "last_text", "next_text"))

    def join(batches):
        for batch in batches:
            out = [Document(k, a).row(Document(None, b)) for k, a, b in zip(*[c.to_pylist() for c in batch.columns])]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t or batch.schema.field(0).type) for c, t in zip(zip(*out), kinds)], names=names[:7])

    inner = found.where("task is null").select(*names[:7])
    return (inner.unionByName(pairs.mapInArrow(join, f"doc_id {key_type}, {OUTPUT}"))
            .withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}))
