"""Jaccard join of documents on word n-grams.

Documents and n-grams form a sparse incidence matrix; two documents link when their rows overlap by at least ``SHARE`` of
their union.  The product of the matrix with itself is formed in blocks and only where size-derived bounds allow a link:

1. N-grams are ordered from rare to frequent (by counts of all documents in a table of fixed size, then by hash).  Two rows that
   link share at least ``k`` entries among their first ``n - ceil(SHARE * n) + k``, so only these entries form columns; ``k``
   is a twentieth of the smaller row.
2. A column's documents are first multiplied with a few of them alone, in several rounds with other ones each.  That connects
   large groups of near copies by a number of products in proportion to their members.
3. Then all pairs of a column that are not yet connected are multiplied: first in bit tables of a fixed size, which bound the overlap from
   above before a pair becomes a row: one table of the first entries, then one of the whole row.  Pairs that are connected need no
   product: the result is components.

A product is formed over the first entries, and over whole rows only for pairs that share ``k`` of those; a pair whose sizes alone
rule out a link is dropped before.  Documents with equal rows are one row.  Nothing of a size that grows with the documents is collected or broadcast.

Defined cases: a NULL text, or one without words, has no n-gram, links with nothing and is its own component.  A text with
fewer than five words has its whole sequence as the only n-gram.  Repeated rows link with each other.  A NULL key is no
candidate for a component's id unless all its keys are NULL.  Texts are read whole.  Of the input's columns only the key is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.llm.common import WHITE, byte_view, mix, powers, saved, slices
from tidecast.llm.components import components
from tidecast.llm.tables import bit_table, chunk_rows, is_set, merged

WORDS, SHARE_PERCENT = 5, 80
#: Counters of the frequency table, whatever the input's size.
COUNTERS = 1 << 22
WORD_BASE, GRAM_BASE = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
WORD_POWERS = powers(WORD_BASE, 1 << 12)
SLICE = 1 << 20
#: Longs of the bit tables of a row's first entries and of all its entries (powers of two), and blocks before a pair's own that are looked
#: at for the same pair.
BIT_LONGS, ROW_LONGS, EARLIER = 8, 16, 8
#: Ids that a reading task remembers, to send the entries of rows that are equal once.
REMEMBERED = 1 << 18
#: Bits flipped to choose the centers of columns, by round.
SALTS = tuple(tuple(((r * 8 + k) * 0x9E3779B97F4A7C15 + 0x5851F42D4C957F2D) % (1 << 63) - (1 << 62) for k in range(n)) for r, n in enumerate((4, 6, 8)))


def word_hashes(data: np.ndarray, first_of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and their hashes, letters A-Z in lower case; ``first_of_text`` marks bytes that begin a text."""
    solid = ~WHITE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first_of_text[1:]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    inside = np.arange(len(data)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    inside[~solid] = 0
    longest = int(inside.max()) + 1
    weights = WORD_POWERS if longest <= len(WORD_POWERS) else powers(WORD_BASE, longest)
    lower = data | (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    values = (lower.astype(np.uint64) + np.uint64(1)) * weights[inside] * solid
    return starts, mix(np.add.reduceat(values, starts))


def gram_sets(array: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    data, offsets = byte_view(array)
    out: list[np.ndarray] = []
    for first, last in slices(offsets, SLICE):
        base = int(offsets[first])
        part, at = data[base:offsets[last]], offsets[first:last + 1] - base
        mark = np.zeros(len(part) + 1, bool)
        mark[at] = True
        starts, hashes, begin = [], [], 0
        while begin < len(part):  # a long text goes in stretches that end between words
            end = min(len(part), begin + 2 * SLICE)
            while end < len(part) and not WHITE[part[end]]:
                end += 1
            s, h = word_hashes(part[begin:end], mark[begin:end])
            starts.append(s + begin)
            hashes.append(h)
            begin = end
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        bound = np.searchsorted(starts, at)
        gram = hashes[:max(0, len(hashes) - words + 1)]
        for k in range(1, words):
            gram = gram * GRAM_BASE + hashes[k:k + len(gram)]
        gram = mix(gram)
        for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(gram[a:b - words + 1]))
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for i in range(a, b):
                    whole = mix(whole * GRAM_BASE + hashes[i:i + 1])
                out.append(whole)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def frequency_ranks(docs: DataFrame, text: str) -> np.ndarray:
    """For each counter, the magnitude of how often its n-grams occur in all documents."""
    def count(batches):
        table, held, n = np.zeros(COUNTERS, np.uint32), [], 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                grams = gram_sets(batch.column(0).slice(at, 256))
                held += grams
                n += sum(map(len, grams))
                if n > COUNTERS:
                    table += np.bincount(slot(np.concatenate(held)), minlength=COUNTERS).astype(np.uint32)
                    held, n = [], 0
        if held:
            table += np.bincount(slot(np.concatenate(held)), minlength=COUNTERS).astype(np.uint32)
        yield chunk_rows(table, TaskContext.get().partitionId())

    counts = merged(docs.select(text).mapInArrow(count, "chunk long, part long, data binary"), COUNTERS, "<u4", np.add)
    usual = max(1.0, float(counts.mean()))
    return np.maximum(0, np.ceil(np.log2(np.maximum(counts, 1) / (2 * usual)))).astype(np.uint8)


def slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def least_shared(n: int) -> int:
    """Entries that a row of ``n`` shares with any linked row of at least its size, among the first of both."""
    return 1 + n // 20


def prefix_length(n: int) -> int:
    return n - -(-SHARE_PERCENT * n // 100) + least_shared(n)


def needed_shared(n: int, m: int) -> int:
    """Entries that linked rows of ``n`` and ``m`` share among the first of both: all but what the rest of one can hold."""
    least = -(-SHARE_PERCENT * (n + m) // (100 + SHARE_PERCENT))
    return max(least_shared(min(n, m)), least - max(n - prefix_length(n), m - prefix_length(m)))


def row_id(grams: np.ndarray) -> int:
    """A signed 64-bit id that equal rows share."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def row_tables(sets: list[np.ndarray]) -> np.ndarray:
    """For each row ``ROW_LONGS`` longs: a bit is set where an odd number of the row's entries falls on it."""
    width = ROW_LONGS * 64
    place = [k * width + (g & np.uint64(width - 1)).astype(np.int64) for k, g in enumerate(sets)]
    counts = np.bincount(np.concatenate(place), minlength=len(sets) * width) if sets else np.zeros(0, np.int64)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def links(overlap: int, n: int, m: int) -> bool:
    return 100 * overlap >= SHARE_PERCENT * (n + m - overlap)


def read_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id, n, id, prefix, bits``: each document's row number, the entries of its row that form columns, and the row's bit table.

    Of equal rows that a task reads, mostly one has its ``prefix``: a page with a million copies puts one entry a task on each of its columns.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequency_ranks(docs, text))
    key_type = docs.select(key).schema[0].dataType.simpleString()

    def read(batches):
        ranks, sent, nothing = shared.value, set(), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = gram_sets(part.column(1))
                ids, prefixes = [row_id(g) for g in sets], []
                for name, g in zip(ids, sets):
                    fresh = len(g) and name not in sent
                    prefixes.append(g[np.argsort(ranks[slot(g)], kind="stable")[:prefix_length(len(g))]].view(np.int64) if fresh else nothing)
                    sent.add(name)
                if len(sent) > REMEMBERED:
                    sent.clear()
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                table_ends = np.arange(0, (len(sets) + 1) * ROW_LONGS, ROW_LONGS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(g) for g in sets], pa.int64()), pa.array(ids, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes))),
                     pa.ListArray.from_arrays(pa.array(table_ends), pa.array(row_tables(sets)))], names=["doc_id", "n", "id", "prefix", "bits"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text)).mapInArrow(
        read, f"doc_id {key_type}, n long, id long, prefix array<long>, bits array<long>")
    return saved(rows, "gram-rows")


def read_columns(rows: DataFrame) -> DataFrame:
    """``gram, id, n``: the entries of columns with several rows."""
    entries = rows.select(F.explode("prefix").alias("gram"), "id", "n").repartition("gram").sortWithinPartitions("gram", "id")

    def run(batches):
        held = None  # the last entry, not yet known to have company, or already written
        for batch in batches:
            g, i, n = (batch.column(k).to_numpy() for k in range(3))
            fresh = np.append(True, (g[1:] != g[:-1]) | (i[1:] != i[:-1])) if len(g) else np.zeros(0, bool)
            g, i, n = g[fresh], i[fresh], n[fresh]
            if held is not None and len(g) and (g[0], i[0]) == held[:2]:
                g, i, n = g[1:], i[1:], n[1:]
            if not len(g):
                continue
            if held is not None:
                g, i, n = (np.append(v, x) for v, x in zip(held, (g, i, n)))
            same = g[1:] == g[:-1]
            keep = np.append(False, same) | np.append(same, False)
            keep[0] &= held is None or not held[3]
            last = bool(same[-1]) if len(same) else held is not None and held[3]
            held = (g[-1], i[-1], n[-1], last)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (g, i, n)], names=["gram", "id", "n"])

    return saved(entries.mapInArrow(run, "gram long, id long, n long"), "gram-columns")


def labelled(first_entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``gram, id, n, label``: column entries with the component their row is in so far."""
    rows = first_entries if labels is None else first_entries.join(labels, "id", "left")
    label = F.col("id") if labels is None else F.coalesce("label", "id")
    return rows.select(F.explode("grams").alias("gram"), "id", "n", "most", label.alias("label"))


def with_centers(first_entries: DataFrame, labels: DataFrame | None, salts: tuple[int, ...]) -> DataFrame:
    """Pairs ``a, b`` of rows of a column with each of its centers, unless they are connected already.

    A center is the row with the smallest id after its bits are flipped by a salt; ids are hashes, so each salt picks
    another row, and mostly the same one in all columns of a group.
    """
    rows = labelled(first_entries, labels)
    tops = rows.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                    *[F.min(F.col("id").bitwiseXOR(F.lit(s))).alias(f"c{k}") for k, s in enumerate(salts)])
    centers = F.array(*[F.col(f"c{k}").bitwiseXOR(F.lit(s)) for k, s in enumerate(salts)])
    pairs = (rows.join(tops.where("low < high").withColumn("centers", F.array_distinct(centers)), "gram")
             .select("id", F.explode("centers").alias("center")).where("id != center")
             .select(F.least("id", "center").alias("a"), F.greatest("id", "center").alias("b")).distinct())
    if labels is None:
        return pairs
    for side in ("a", "b"):
        pairs = (pairs.join(labels.select(F.col("id").alias(side), F.col("label").alias(f"of_{side}")), side, "left")
                 .withColumn(f"of_{side}", F.coalesce(f"of_{side}", side)))
    return pairs.where("of_a != of_b").select("a", "b")


def all_open(first_entries: DataFrame, labels: DataFrame, read: DataFrame) -> DataFrame:
    """Pairs ``a, b`` that are not connected, meet in a column, and by their bit tables may share enough of their entries.

    Columns with the same smallest row form a block.  A pair of a block is multiplied in bits before it becomes a row: bits that differ
    are entries only one has, so the overlap is at most half of what both hold less these.  That is done with the first entries and with
    whole rows (``bits`` of ``read``).  A pair that also meets in one of the ``EARLIER`` blocks before, by their ids, is left to that one.
    """
    rows = labelled(first_entries, labels)
    tops = rows.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                    F.min(F.struct("id", "label")).alias("block")).where("low < high")
    blocks = rows.join(tops.select("gram", "block"), "gram").groupBy("id").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    known = (first_entries.join(labels, "id", "left")
             .select("id", "n", "most", F.coalesce("label", "id").alias("label"), F.size("grams").alias("held"),
                     *[parity("grams", k).alias(f"bits_{k}") for k in range(BIT_LONGS)]))
    at, earlier = F.col("at"), F.transform("blocks", lambda x: x["id"])
    members = (known.join(blocks, "id").select("*", F.posexplode("blocks").alias("at", "block"))
               .withColumn("earlier", F.slice(earlier, F.greatest(at - EARLIER, F.lit(0)) + 1, F.least(at, F.lit(EARLIER))))
               .select(*known.columns, "earlier", F.col("block.id").alias("block"), F.col("block.label").alias("home")))
    members = saved(members, "gram-open")
    tables = read.join(members.select("id").distinct(), "id", "left_semi").select("id", "bits").dropDuplicates(["id"])
    members = members.join(tables, "id")
    foreign = members.where("label != home").drop("home")
    foreign = foreign.select("block", *[F.col(c).alias(f"{c}_x") for c in foreign.columns if c != "block"])
    differ = sum((F.bit_count(F.col(f"bits_{k}").bitwiseXOR(F.col(f"bits_{k}_x"))) for k in range(1, BIT_LONGS)),
                 F.bit_count(F.col("bits_0").bitwiseXOR(F.col("bits_0_x"))))
    apart = sum((F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("bits_x")[k])) for k in range(1, ROW_LONGS)),
                F.bit_count(F.col("bits")[0].bitwiseXOR(F.col("bits_x")[0])))
    both = F.col("n") + F.col("n_x")
    return (foreign.join(members, "block")
            .where((F.col("label") != F.col("label_x")) & ((F.col("label") == F.col("home")) | (F.col("id_x") < F.col("id")))
                   & may_link("n", "n_x", "most", "most_x") & (F.col("held") + F.col("held_x") - differ >= 2 * needed_column("n", "n_x"))
                   & ((100 + SHARE_PERCENT) * (both - apart) >= 2 * SHARE_PERCENT * both)
                   & ~F.arrays_overlap("earlier", "earlier_x"))
            .select(F.least("id", "id_x").alias("a"), F.greatest("id", "id_x").alias("b")).distinct())


def parity(grams: str, k: int) -> Column:
    """The ``k``-th long of a row's bit table: a bit is set where an odd number of entries falls on it."""
    own = F.filter(grams, lambda g: F.shiftright(g, 6).bitwiseAND(F.lit(BIT_LONGS - 1)) == k)
    return F.aggregate(own, F.lit(0).cast("long"), lambda bits, g: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), g.bitwiseAND(F.lit(63)).cast("int"))))


def needed_column(n: str, m: str) -> Column:
    """``needed_shared`` of two columns."""
    least = f"({SHARE_PERCENT} * ({n} + {m}) + {99 + SHARE_PERCENT}) div {100 + SHARE_PERCENT}"
    rest = [f"(({SHARE_PERCENT} * {x} + 99) div 100 - 1 - {x} div 20)" for x in (n, m)]
    return F.expr(f"greatest(1 + least({n}, {m}) div 20, {least} - greatest({', '.join(rest)}))")


def may_link(n: str, m: str, most_n: str, most_m: str):
    """Whether rows of these sizes can link, if each can share at most so many of its entries."""
    return (100 + SHARE_PERCENT) * F.least(most_n, most_m) >= SHARE_PERCENT * (F.col(n) + F.col(m))


def possible(pairs: DataFrame, first_entries: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose sizes, and entries that no other row has, allow a link."""
    for side in ("a", "b"):
        pairs = pairs.join(first_entries.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("most").alias(f"most_{side}")), side)
    return pairs.where(may_link("n_a", "n_b", "most_a", "most_b")).select("a", "b")


def whole_rows(docs: DataFrame, text: str, ids: DataFrame) -> DataFrame:
    """``id, grams`` of the wanted rows.  A bit table of fixed size says which may be wanted; what it lets through by chance is joined away."""
    ids = saved(ids.select("id").distinct(), "gram-wanted")
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(ids))

    def read(batches):
        wanted = shared.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                found = {}
                for grams in gram_sets(batch.column(0).slice(at, 256)):
                    name = row_id(grams)
                    if is_set(wanted, name):
                        found[name] = grams.view(np.int64)
                if found:
                    ends = np.cumsum([0, *map(len, found.values())]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(np.diff(ends).astype(np.int64)),
                                                      pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(list(found.values()))))],
                                                     names=["id", "n", "grams"])

    found = docs.select(text).mapInArrow(read, "id long, n long, grams array<long>")
    return saved(found.join(ids, "id", "left_semi").dropDuplicates(["id"]), "gram-sets")


def multiplied(pairs: DataFrame, rows: DataFrame, keep) -> DataFrame:
    """Those of the pairs ``a, b`` for which ``keep(overlap, n, m)`` holds; ``rows`` has ``id, n, grams``."""
    def side(name: str) -> DataFrame:
        return rows.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("grams").alias(f"grams_{name}"))

    wide = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "grams_a", "grams_b")

    def multiply(batches):
        for batch in batches:
            (x, x_at), (y, y_at) = ((c.flatten().to_numpy(), (c.offsets.to_numpy() - c.offsets[0].as_py()).tolist()) for c in batch.columns[4:])
            good = []
            for k, (n, m) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                both = np.concatenate([x[x_at[k]:x_at[k + 1]], y[y_at[k]:y_at[k + 1]]])
                both.sort(kind="stable")
                good.append(keep(int((both[1:] == both[:-1]).sum()), n, m))
            found = batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
            if len(found):
                yield found

    return saved(wide.mapInArrow(multiply, "a long, b long"), "gram-pairs")


def likely(pairs: DataFrame, first_entries: DataFrame) -> DataFrame:
    """Those of the pairs that share enough of their first entries."""
    return multiplied(possible(pairs, first_entries), first_entries, lambda overlap, n, m: overlap >= needed_shared(n, m))


def both_ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    rows = read_rows(docs, key, text)
    columns = read_columns(rows)
    # ``most``: entries a row can share at all, as those of its first ones that form no column are its own.
    first = F.col("n") - F.ceil(SHARE_PERCENT * F.col("n") / 100) + 1 + F.floor(F.col("n") / 20)
    first_entries = (columns.groupBy("id").agg(F.first("n").alias("n"), F.collect_list("gram").alias("grams"))
                     .withColumn("most", F.col("n") - first + F.size("grams")))
    first_entries = saved(first_entries.where((F.size("grams") >= 1 + F.floor(SHARE_PERCENT * F.col("n") / 2000))
                                              & (100 * F.col("most") >= SHARE_PERCENT * F.col("n"))), "gram-first")
    pairs = likely(with_centers(first_entries, None, SALTS[0]), first_entries)
    sets = whole_rows(docs, text, both_ids(pairs))
    found = multiplied(pairs, sets, links)
    labels = components(found)
    for salts in SALTS[1:]:  # pairs of rows that are not among ``sets`` wait for the last step
        pairs = likely(with_centers(first_entries, labels, salts), first_entries)
        found = found.unionByName(multiplied(pairs, sets, links))
        labels = components(found)
    pairs = likely(all_open(first_entries, labels, rows), first_entries)
    labels = components(found.unionByName(multiplied(pairs, whole_rows(docs, text, both_ids(pairs)), links)))

    grouped = rows.select("doc_id", "n", "id").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    lowest = grouped.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("lowest"))
    return (grouped.join(lowest, "label", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id")))
