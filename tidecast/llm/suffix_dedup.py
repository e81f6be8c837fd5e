"""Removal of repeated byte strings by sorted suffixes.

A byte goes when a string of ``SPAN`` bytes that covers it also starts anywhere else in any document.  All places of one
string have to meet in one shard before suffixes can be sorted there:

1. In every window of ``SPAN`` bytes the smallest hash of a ``GRAM``-byte string is its anchor; equal windows have equal anchors.  Windows that
   share an anchor place follow each other and form a stretch.  Stretches are grouped by their anchor's hash.
2. In a group of one stretch nothing repeats.  In a group of equal stretches every window does.  Only groups of
   different stretches are open; each different stretch goes on once, with its number of copies.
3. Open stretches are cut into blocks by the place of the anchor in the window, and grouped anew by the bytes that all windows of a
   block share; equal windows still meet.  A part alone in its group is done, as are equal parts.  What stays open are
   places where a copy begins or ends.  Groups of more than ``MOST`` different parts are cut on, so a common passage with many
   surroundings falls apart into small groups.
4. Groups are dealt to shards by hash.  A shard sorts the suffixes of its parts by external induced sorting.  A window that has ``SPAN`` bytes in common with a
   neighbour in that order repeats.

Defined cases: a NULL text is empty; an empty or short text keeps all bytes.  Repeated rows remove each other's bytes.  Overlapping
occurrences count, and strings are judged on the input.  Very long texts are read whole, in stretches.  Of the input's columns only key and
text are used; ``clean`` keeps them all.  Bytes that are left of a cut character are kept as they are; ``clean`` drops them from the text.

Passages: ``clean`` can also take out runs of ``SPAN // CODE`` words that start anywhere else too, however few bytes they have.  The same steps find
them in texts that hold a hash of 48 bits, in ``CODE`` bytes, for each word; white space between words does not count.  Words are told apart by these hashes alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidecast.llm.common import GOLDEN, WHITE, byte_view, mix, powers, saved, saved_alone, slices, text_of
from tidecast.llm.induced_sort import suffix_array
from tidecast.llm.tables import are_set, bit_table

SPAN, GRAM = 400, 100
#: Bytes that stand for a word where runs of words are sought, and the bits used of them: the sort takes steps for each pair of letters.
CODE, CODE_BITS = 8, np.uint64(0x3F3F3F3F3F3F3F3F)
#: Sizes of the blocks of anchor places that stretches are cut into, different parts of a group that go to one shard, and bytes aimed at per shard.
BLOCKS = (128, 32)
MOST, SHARD_BYTES = 500, 1 << 20
#: Bytes that one task sorts, shard by shard, and tasks at most.
TASK_BYTES, MOST_TASKS = 16 << 20, 100_000
#: Shares of all stretches that a group may have in one task.
HOT = 20_000
BASE = 0x9E3779B97F4A7C15 | 1
PART = 1 << 19
#: Documents whose stretches a task hands on at once.
TOGETHER = 256
PLACE = np.uint64((1 << 20) - 1)
POWERS, INVERSE = powers(BASE, PART + SPAN), powers(pow(BASE, -1, 1 << 64), PART + SPAN)
View = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
STRETCH = "gram long, d1 long, d2 long, doc long, start long, windows long, lead int"


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one byte of each word; a word ends with its text."""
    word = np.append(~WHITE[data], False)
    first, last = word.copy(), word[:-1].copy()
    first[1:] &= ~word[:-1]
    first[offsets] |= word[offsets]
    last &= ~word[1:]
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    last[ends] |= word[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_view(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As `byte_view`, with ``CODE`` bytes for each word and nothing between them."""
    data, offsets = byte_view(array)
    first, end = word_bounds(data, offsets)
    codes = np.zeros(len(first), np.uint64)
    for a, b in slices(np.append(first, len(data)), 1 << 16):  # small work arrays: a worker keeps what it once took
        begin, piece = first[a:b] - first[a], data[first[a]:end[b - 1]]
        white = WHITE[piece]
        place = np.arange(len(piece)) - np.repeat(begin, np.diff(np.append(begin, len(piece))))
        place[white] = 0
        factors = mix(np.arange(1, (end[a:b] - first[a:b]).max() + 1, dtype=np.uint64) * GOLDEN)
        values = (piece.astype(np.uint64) + np.uint64(1)) * factors[place]
        values[white] = 0
        codes[a:b] = mix(np.add.reduceat(values, begin)) & CODE_BITS
    return codes.view(np.uint8), np.searchsorted(first, offsets) * CODE


def gram_hashes(data: np.ndarray) -> np.ndarray:
    sums = np.append(np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * POWERS[:len(data)], dtype=np.uint64))
    n = len(data) - GRAM + 1
    return mix((sums[GRAM:] - sums[:-GRAM]) * INVERSE[:n])


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, first window, number of windows, and anchor place of each stretch of one piece of text."""
    hashes = gram_hashes(data)
    width = SPAN - GRAM + 1
    key = hashes & ~PLACE | (PLACE - np.arange(len(hashes), dtype=np.uint64))  # of equal hashes the last place is smallest
    least, size = key, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    windows = len(data) - SPAN + 1
    least = np.minimum(least[:windows], least[width - size:width - size + windows])
    anchor = (PLACE - (least & PLACE)).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    return hashes[anchor[first]].view(np.int64), first, np.diff(np.append(first, windows)), anchor[first]


def all_stretches(data: np.ndarray):
    """``gram, start, windows, anchor`` arrays of a whole text, piece by piece; a piece overlaps the next by one window less a byte."""
    for at in range(0, len(data) - SPAN + 1, PART):
        gram, first, count, anchor = stretches(data[at:at + PART + SPAN - 1])
        yield gram, first + at, count, anchor + at


def digest(data: np.ndarray, start: int, windows: int) -> tuple[int, int]:
    d = hashlib.blake2b(data[start:start + windows + SPAN - 1], digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def parts(batches):
    for batch in batches:
        for at in range(0, len(batch), TOGETHER):
            yield batch.slice(at, TOGETHER)


def find_stretches(docs: DataFrame, view: View) -> DataFrame:
    """Stretches of ``doc, text``."""
    def run(batches):
        for batch in parts(batches):
            data, offsets = view(batch.column(1))
            columns: list[list[np.ndarray]] = [[] for _ in range(7)]
            for name, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                text = data[a:b]
                for gram, start, count, anchor in all_stretches(text):
                    d = np.array([digest(text, s, c) for s, c in zip(start.tolist(), count.tolist())], np.int64)
                    for column, values in zip(columns, (gram, d[:, 0], d[:, 1], np.full(len(gram), name), start, count, (anchor - start).astype(np.int32))):
                        column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["gram", "d1", "d2", "doc", "start", "windows", "lead"])

    return docs.mapInArrow(run, STRETCH)


def open_texts(docs: DataFrame, wanted: DataFrame, view: View) -> DataFrame:
    """``gram, d1, d2, doc, start, lead, bytes``: a stretch of each wanted class, with its bytes.

    Which groups are wanted is told by a bit table of fixed size; what it lets through by chance is joined away.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(wanted.select("gram").distinct()))

    def run(batches):
        for batch in parts(batches):
            data, offsets = view(batch.column(1))
            found = {}
            for name, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                text = data[a:b]
                for gram, start, count, anchor in all_stretches(text):
                    own = np.flatnonzero(are_set(shared.value, gram))
                    for g, s, c, p in zip(*(v[own].tolist() for v in (gram, start, count, anchor))):
                        key = (g, *digest(text, s, c))
                        if key not in found:
                            found[key] = (name, s, p - s, text[s:s + c + SPAN - 1].tobytes())
            if found:
                columns = [*zip(*found), *zip(*found.values())]
                types = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["gram", "d1", "d2", "doc", "start", "lead", "bytes"])

    rows = docs.mapInArrow(run, "gram long, d1 long, d2 long, doc long, start long, lead int, bytes binary")
    rows = rows.join(wanted, ["gram", "d1", "d2"])
    least = F.min(F.struct("doc", "start", "lead", "copies", "bytes")).alias("one")
    return rows.groupBy("gram", "d1", "d2").agg(least).select("gram", "d1", "d2", "one.*")


def parts_of(size: int):
    """Cuts each stretch by the place of the anchor in the window, in blocks of ``size``; a part's group is what all windows of its block share."""
    def run(batches):
        for batch in parts(batches):
            out = []
            for row in batch.to_pylist():
                data, lead = row["bytes"], row["lead"]
                windows = len(data) - SPAN + 1
                for low in range(row["low"], min(row["low"] + row["block"], lead + 1), size):
                    # Windows whose anchor is at ``low`` up to ``low + size - 1``; window k has it at lead - k.
                    first, last = max(0, lead - low - size + 1), min(windows - 1, lead - low)
                    if first <= last:
                        core = data[lead - low:max(lead - low, lead - low - size + 1 + SPAN)]
                        mark = hashlib.blake2b(core + f"{row['group']} {size} {low}".encode(), digest_size=8).digest()
                        out.append((int.from_bytes(mark, "little", signed=True), size, low, row["doc"], row["start"] + first, lead - first,
                                    row["copies"], data[first:last + SPAN]))
            if out:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["group", "block", "low", "doc", "start", "lead", "copies", "bytes"])

    return run


def divided(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Parts that are still open, equal ones once, and the windows of those that turned out equal to another one.

    A part that is alone in its group has no window in common with any other.
    """
    parts_ = saved(rows.mapInArrow(parts_of(size), rows.schema).withColumn("hash", F.xxhash64("bytes")), "stretch-parts")
    counted = parts_.groupBy("group", "hash", "bytes").agg(F.sum("copies").alias("copies"), F.min(F.struct("doc", "start", "lead", "block", "low")).alias("one"))
    counted = saved(counted, "stretch-counted")
    equal = parts_.where("copies = 1").join(counted.where("copies > 1").select("group", "hash"), ["group", "hash"], "left_semi")
    company = counted.groupBy("group").agg(F.count("*").alias("rows"), F.min("copies").alias("least")).where("rows > 1 and least = 1").select("group")
    rows = counted.join(company, "group", "left_semi").select("group", "one.block", "one.low", "one.doc", "one.start", "one.lead", "copies", "bytes")
    return saved(rows, "stretch-texts"), equal.select("doc", "start", (F.length("bytes") - SPAN + 1).cast("long").alias("windows"))


def repeated_in(shard: pd.DataFrame) -> pd.DataFrame:
    """Ranges of windows of single stretches that repeat within the shard."""
    texts = shard["bytes"].tolist()
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    data = np.zeros(int((lengths + 1).sum()), np.int64)  # stretches end with the letter 0
    inside = np.ones(len(data), bool)
    inside[begins + lengths] = False
    data[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    at, lcp = suffix_array(data, SPAN)
    same = lcp >= SPAN
    again = np.zeros(len(data) + 1, bool)
    again[at[same | np.append(same[1:], False)]] = True
    row = np.repeat(np.arange(len(texts)), lengths + 1)
    valid = np.arange(len(data)) - begins[row] <= lengths[row] - SPAN  # a window lies within one stretch
    again[:-1] &= valid & (shard["copies"].to_numpy() == 1)[row]
    edge = np.flatnonzero(np.diff(np.append(False, again).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    own = row[first]
    return pd.DataFrame({"doc": shard["doc"].to_numpy()[own], "start": shard["start"].to_numpy()[own] + first - begins[own], "windows": last - first})


def with_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``rows`` joined with one ``lookup`` row per key, of which ``n`` tells how many ``rows`` have it.

    A key that has more than a ``HOT``-th of all rows, which fewer than ``HOT`` keys have, is dealt to as many tasks as it has such shares.
    """
    share = max(rows.count() // HOT, 1)
    hot = lookup.where(F.col(n) > share).select(*keys, F.ceil(F.col(n) / share).cast("bigint").alias("shares"))  # at most HOT rows
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("deal", F.coalesce(F.pmod(F.xxhash64("doc", "start"), "shares"), F.lit(0))).drop("shares")
    shares = F.greatest(F.lit(1), F.ceil(F.col(n) / share)).cast("bigint")
    return dealt.join(lookup.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), shares - 1))).drop(n), [*keys, "deal"]).drop("deal")


def repeated_windows(docs: DataFrame, view: View = byte_view) -> DataFrame:
    """``doc, start, windows``: ranges of windows of ``doc, text``, as bytes that ``view`` gives, that also start elsewhere."""
    places = saved(find_stretches(docs, view), "stretches")
    groups = places.groupBy("gram").agg(F.count("*").alias("n"), F.min("d1").alias("least"), F.max("d1").alias("most")).where("n > 1")
    groups = groups.select("gram", "n", (F.col("least") != F.col("most")).alias("mixed"))
    shared = saved(with_lookup(places, saved(groups, "stretch-anchors"), ["gram"], "n"), "stretch-groups")
    classes = shared.where("mixed").groupBy("gram", "d1", "d2").agg(F.count("*").alias("copies"))
    classes = saved(classes, "stretch-classes")
    copies = with_lookup(shared.where("mixed"), classes.where("copies > 1"), ["gram", "d1", "d2"], "copies").unionByName(shared.where("not mixed"))

    rows = open_texts(docs, classes, view).select(F.col("gram").alias("group"), F.lit(512).alias("block"), F.lit(0).alias("low"), "doc", "start", "lead", "copies", "bytes")
    rows = saved(rows, "stretch-texts")
    copies, ready, size = copies.select("doc", "start", "windows"), [], 512
    for size in BLOCKS:
        rows, equal = divided(rows, size)
        copies = copies.unionByName(equal)
    while True:  # groups that are still large; a block of one place has equal windows only, so this ends
        large = saved(rows.groupBy("group").agg(F.count("*").alias("rows")).where(F.col("rows") > MOST).select("group"), "stretch-large")
        if not large.limit(1).count():
            break
        ready.append(rows.join(large, "group", "left_anti"))
        size //= 2
        rows, equal = divided(rows.join(large, "group", "left_semi"), size)
        copies = copies.unionByName(equal)
    ready.append(rows)
    shards = ready[0]
    for more in ready[1:]:
        shards = shards.unionByName(more)
    total = shards.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    number = max(1, total // SHARD_BYTES)
    tasks = int(max(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"), min(total // TASK_BYTES, MOST_TASKS), key=int))
    # A number that is asked for is kept: tasks that are put together by their bytes would sort for a minute each.
    sorted_out = (shards.withColumn("shard", F.pmod(F.xxhash64("group"), F.lit(number))).repartition(tasks, "shard").groupBy("shard")
                  .applyInPandas(lambda f: repeated_in(f), "doc long, start long, windows long"))
    return copies.unionByName(sorted_out)


def spans(starts: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one byte of maximal runs covered by the windows."""
    order = np.argsort(starts, kind="stable")
    first, end = starts[order], (starts + windows + SPAN - 1)[order]
    reach = np.maximum.accumulate(end)
    new = np.append(True, first[1:] > reach[:-1])
    return first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)]


def covered(text: np.ndarray, starts: np.ndarray, windows: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one byte of what windows of the text, or of its words' codes, take out."""
    first, end = spans(starts, windows)
    if not words:
        return first, end
    begins, ends = word_bounds(text, np.array([0, len(text)]))
    first, end = -(-first // CODE), end // CODE  # a word goes whole or stays
    return begins[first], ends[end - 1]


def cut(docs: DataFrame, key: str, text: str, keep: tuple[str, ...], decoded: bool = False, passages: bool = False) -> DataFrame:
    """Columns ``keep`` of ``docs``, with ``keep_`` before their names, and ``n_bytes, n_removed, n_spans, kept``.

    ``kept`` are bytes, or text without what a cut leaves of a character: texts then pass through one worker only.  With ``passages`` runs of words go too.
    """
    own = F.xxhash64(F.col(key), text_of(text))
    texts = docs.select(own.alias("doc"), text_of(text).alias("text"))
    kinds = [False, True] if passages else [False]
    if passages:  # one search after the other, so that only one has its scratch on disk
        found, more = (saved_alone(docs.sparkSession, lambda v=v: repeated_windows(texts, v), "windows") for v in (byte_view, word_view))
        found = found.withColumn("words", F.lit(False)).unionByName(more.withColumn("words", F.lit(True)))
    else:
        found = repeated_windows(texts).withColumn("words", F.lit(False))
    lists = [F.collect_list(F.when(F.col("words") == words, F.col(c))).alias(f"{c}_{words}") for words in kinds for c in ("start", "windows")]
    found = found.groupBy("doc").agg(*lists)
    wide = docs.select(*[F.col(c).alias(f"keep_{c}") for c in keep], text_of(text).alias("text"), own.alias("doc")).join(found, "doc", "left")
    wide = wide.select(*[f"keep_{c}" for c in keep], "text", *found.columns[1:])

    def run(batches):
        for batch in parts(batches):
            data, offsets = byte_view(batch.column(len(keep)))
            gone, number, kept = [], [], []
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                edge = np.zeros(b - a + 1, np.int32)
                for i, words in enumerate(kinds):
                    s, w = (batch.column(len(keep) + 1 + 2 * i + j)[k] for j in range(2))
                    if s.is_valid and len(s):
                        first, end = covered(data[a:b], s.values.to_numpy(), w.values.to_numpy(), words)
                        edge[first] += 1
                        edge[end] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                gone.append(b - a - int(stay.sum()))
                number.append(int((~stay & np.append(True, stay[:-1])[:b - a]).sum()))
                left = data[a:b][stay].tobytes()
                kept.append(left.decode("utf-8", "ignore") if decoded else left)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(np.diff(offsets)), pa.array(gone, pa.int64()),
                                             pa.array(number, pa.int64()), pa.array(kept, pa.string() if decoded else pa.binary())], names=schema.names)

    from pyspark.sql.types import StructType

    schema = StructType([*wide.schema.fields[:len(keep)], *StructType.fromDDL(f"n_bytes long, n_removed long, n_spans long, kept {'string' if decoded else 'binary'}").fields])
    return wide.mapInArrow(run, schema)


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``n_bytes, n_removed, n_spans, kept`` (the remaining bytes)."""
    out = cut(docs, key, text, keep)
    return out.select(*[F.col(f"keep_{c}").alias(c) for c in keep], "n_bytes", "n_removed", "n_spans", "kept")


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", passages: bool = False) -> DataFrame:
    """``docs`` with the repeated bytes, and repeated ``passages`` if asked for, taken out of their texts.

    What a cut leaves of a character goes too, NULL texts stay NULL.
    """
    own = tuple(c for c in docs.columns if c != text)
    out = cut(docs.withColumn("__null", F.col(text).isNull()), key, text, (*own, "__null"), decoded=True, passages=passages)
    return out.select(*[F.when(~F.col("keep___null"), F.col("kept")).alias(text) if c == text else F.col(f"keep_{c}").alias(c) for c in docs.columns])
