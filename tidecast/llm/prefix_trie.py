"""The prefix trie of all conversations, from adaptive radix trees over fixed-width turn ids.

A turn's id is 16 bytes of a hash of its role and text; a conversation is the ids of its turns, one behind the other, so a sequence of first turns is
a prefix of bytes that ends at a multiple of 16, and bytes compare as ids do (big-endian).  Texts are read once and never shuffled.

Conversations are sorted by these bytes over the cluster and cut into blocks.  A block fills a radix tree (`radix_tree.py`), whose branches and pieces may
end inside an id; only depths at whole turns are nodes of the trie.  A node that is no prefix of the block's first or last key has all its members in the
block, because they lie beside each other in the sorted order: it is final.  What is left of the others, the block's edge, goes up as one
partial sum per path: the members, children, leaves and savings that hang below a node apart from deeper edge nodes.  These sums
are of the same form as conversations, so trees are filled with them in the same way, level by level, until one block holds the rest.  A first turn, or a whole
conversation, that a third of the rows share is therefore spread over many blocks, each of which sends up a few rows.

The ids of conversations that end at a node are hashed as one text in ascending order.  A block hashes those of its final nodes; for its edge
it sends up the text itself, in one row, and the rows of a node are hashed one after the other in the order of their first id.  That chain cannot be
cut, as the digest is of one text; it runs over a stream of long strings and holds one at a time.

Defined cases: a NULL role or text is empty.  A NULL turn number comes first; turns of one number are ordered by role, then by id, and all of them
count.  Rows without a conversation id belong to no conversation and are left out.  A turn's words are counted in its whole text.  Two different turns count as one only
if 128 bits of their SHA-256 agree.  An empty table has no members and gives no nodes.  Other columns are ignored.  The ids of one conversation (20 bytes a turn)
have to fit into a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.llm.common import WORD_PATTERN, saved
from tidecast.llm.radix_tree import Node, RadixTree, common

WIDTH = 16
#: Rows and bytes of keys of a block.
BLOCK_ROWS, BLOCK_BYTES = 50_000, 16 << 20
#: Ids in a row of ends, and rows of an Arrow batch.
ENDS_ROW, ROWS_OUT = 1000, 5000
NODE, PARTIAL, ENDS = 0, 1, 2
MADE = ("kind int, key binary, words array<int>, least long, depth long, n long, children long, leaves long, saved long, "
        "parent_least long, parent binary, id binary, ends_sha256 string, ends string")
ITEM = ["key", "words", "least", "n", "children", "leaves", "saved"]
NO_ENDS = hashlib.sha256().hexdigest()
ARROW = pa.schema([
    ("kind", pa.int32()), ("key", pa.binary()), ("words", pa.list_(pa.int32())), ("least", pa.int64()), ("depth", pa.int64()), ("n", pa.int64()),
    ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("parent_least", pa.int64()), ("parent", pa.binary()), ("id", pa.binary()),
    ("ends_sha256", pa.string()), ("ends", pa.string())])


def turn_id(role: Column, text: Column) -> Column:
    """Hex digits of a turn's id; the role's length keeps role and text apart."""
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)


def sequences(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``key, turns``: each conversation's turns in order, as (id, words)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    one = F.struct(F.col(turn).alias("turn"), role.alias("role"), turn_id(role, text).alias("id"), F.regexp_count(text, F.lit(WORD_PATTERN)).alias("words"))
    rows = turns.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), one.alias("t"))
    return rows.groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("turns")).select(
        "key", F.transform("turns", lambda t: F.struct(t["id"], t["words"])).alias("turns"))


def rebuilt(own: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Conversations whose first turns are those of another: ``key, turns``.

    The first h turns, h = crc32(key) modulo most + 1, come from the conversation whose key is the multiple of ``every`` at or before (towards
    zero) one's own; the rest are one's own from the h-th on.
    """
    own = own.withColumn("h", (F.crc32(F.col("key").cast("string").cast("binary")) % (most + 1)).cast("int")).withColumn("base", F.col("key") - F.col("key") % every)
    heads = own.where(F.col("key") % every == 0).select(F.col("key").alias("base"), F.slice("turns", 1, most).alias("head"))
    first = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(heads, "base", "left").select("key", F.concat(first, rest).alias("turns"))


def keyed(rows: DataFrame) -> DataFrame:
    """Conversations as items of a tree: their ids as bytes, and the words of each turn."""
    zero = F.lit(0).cast("long")
    return rows.select(
        F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"),
        F.col("key").alias("least"), F.lit(1).cast("long").alias("n"), zero.alias("children"), zero.alias("leaves"), zero.alias("saved"))


@dataclass
class Item:
    """What hangs at a key: members and the least of them; nodes directly below, leaves and savings that are final elsewhere; ids that end here."""

    words: list[int]
    least: int
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: list[int] = field(default_factory=list)

    def absorb(self, other: Item) -> None:
        self.least, self.n, self.children = min(self.least, other.least), self.n + other.n, self.children + other.children
        self.leaves, self.saved = self.leaves + other.leaves, self.saved + other.saved
        self.ends += other.ends


@dataclass
class Sums:
    """A subtree: members, the least of them, leaves, savings; nodes nearest to its top (``tops``)."""

    n: int
    least: int
    leaves: int
    saved: int
    tops: int
    words: list[int]


def node_id(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=WIDTH).digest()


def insert(tree: RadixTree, key: bytes, item: Item) -> None:
    slot = tree.slot(key)
    if slot.value is None:
        slot.value = item
    else:
        slot.value.absorb(item)


def sum_up(root: Node) -> None:
    """Fill ``sums`` from the leaves upwards.  Depths count bytes; the piece of a node may hold several turns, which have the same members."""
    order, stack = [], [(root, 0)]
    while stack:
        node, start = stack.pop()
        order.append((node, start))
        stack += [(child, start + len(node.piece)) for child in node.children()]
    for node, start in reversed(order):
        end, below, own = start + len(node.piece), node.children(), node.value
        parts = [child.sums for child in below]
        n = sum(p.n for p in parts) + (own.n if own else 0)
        least = min([p.least for p in parts] + ([own.least] if own else []))
        words = own.words if own else parts[0].words
        leaves, tops = sum(p.leaves for p in parts), sum(p.tops for p in parts)
        saving = sum(p.saved for p in parts) + (own.saved if own else 0)
        if own:
            leaves, tops = leaves + own.leaves, tops + own.children
        whole = end // WIDTH - start // WIDTH  # turns that end within the piece
        if node is root or whole:
            if not tops:
                leaves += 1
            saving += (n - 1) * sum(words[start // WIDTH:end // WIDTH])
            tops = 1
        node.sums = Sums(n, least, leaves, saving, tops, words)


def digest(ends: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest() if ends else NO_ENDS


def block_rows(items: Iterable[tuple[bytes, Item]], first: bytes, last: bytes, whole: bool, with_ends: bool) -> Iterator[tuple]:
    """The rows of `MADE` that one block makes.

    ``whole``: nothing lies outside the block, so it has no edge.  ``with_ends``: the items are conversations and bring the ids that end at them.
    """
    tree, edge = RadixTree(), {}
    for key, item in items:
        insert(tree, key, item)
    sum_up(tree.root)
    # A node, the bytes above it, how many of its first bytes lie on the paths of the first and last key, depth and least member of the turn above.
    stack: list[tuple[Node, bytes, int, int, int, int | None]] = [(tree.root, b"", 0, 0, -1, None)]
    while stack:
        node, above, a, b, parent, parent_least = stack.pop()
        start, key = len(above), above + node.piece
        end, sums, own = len(key), node.sums, node.value
        a += common(node.piece, first[start:end]) if a == start else 0
        b += common(node.piece, last[start:end]) if b == start else 0
        depths = range(start // WIDTH + 1, end // WIDTH + 1) if node is not tree.root else range(1)
        tail = sum(child.sums.saved for child in node.children()) + (own.saved if own else 0)
        saving = {}
        for d in reversed(depths):
            saving[d] = tail = tail + (sums.n - 1) * (sums.words[d - 1] if d else 0)
        for d in depths:
            final = whole or max(a, b) < d * WIDTH
            if final:
                below = 1 if d < depths[-1] else sum(child.sums.tops for child in node.children()) + (own.children if own else 0)
                sha = digest(own.ends if own and d * WIDTH == end else []) if with_ends else None
                pending = node_id(key[:parent * WIDTH]) if parent >= 0 and parent_least is None else None
                yield (NODE, None, None, sums.least, d, sums.n, below, sums.leaves, saving[d], parent_least, pending,
                       None if with_ends else node_id(key[:d * WIDTH]), sha, None)
                if pending:
                    add(edge, key[:parent * WIDTH], Item(sums.words[:parent], sums.least, sums.n, 1, sums.leaves, saving[d]))
            parent, parent_least = d, sums.least if final else None
        if own and not whole and max(a, b) >= end:
            add(edge, key, own)
        stack += [(child, key, a, b, parent, parent_least) for child in node.children()]
    for key, item in edge.items():
        yield (PARTIAL, key, item.words, item.least, None, item.n, item.children, item.leaves, item.saved, None, None, None, None, None)
        ends = sorted(item.ends)
        for at in range(0, len(ends), ENDS_ROW):
            yield (ENDS, None, None, ends[at], None, None, None, None, None, None, None, node_id(key), None, ",".join(map(str, ends[at:at + ENDS_ROW])))


def add(edge: dict[bytes, Item], key: bytes, item: Item) -> None:
    if key in edge:
        edge[key].absorb(item)
    else:
        edge[key] = item


def blocks(batches: Iterator[pa.RecordBatch], whole: bool, with_ends: bool, most: int) -> Iterator[pa.RecordBatch]:
    """Cut sorted items into blocks and send on what they make."""
    rows, items, size = [], [], 0

    def flush(least: int) -> Iterator[pa.RecordBatch]:
        while len(rows) >= least and rows:
            part, rows[:ROWS_OUT] = rows[:ROWS_OUT], []
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), ARROW)], schema=ARROW)

    def fill() -> None:
        nonlocal size
        first, last = items[0][0], items[-1][0]
        rows.extend(block_rows(items, first, last, whole, with_ends))
        items.clear()
        size = 0

    for batch in batches:
        for key, words, least, n, children, leaves, saving in zip(*(c.to_pylist() for c in batch.columns)):
            items.append((key, Item(words, least, n, children, leaves, saving, [least] if with_ends else [])))
            size += len(key)
            if not whole and (len(items) >= most or size >= BLOCK_BYTES):
                fill()
                yield from flush(ROWS_OUT)
    if items:
        fill()
    yield from flush(1)


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, ends_sha256`` from rows sorted by id and first number: the digest of all texts of an id, with commas between."""
    known, state = None, None
    for batch in batches:
        done = []
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if name == known:
                state.update(b",")
            else:
                if state:
                    done.append((known, state.hexdigest()))
                known, state = name, hashlib.sha256()
            state.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["id", "ends_sha256"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([known], pa.binary()), pa.array([state.hexdigest()])], names=["id", "ends_sha256"])


def trie(conversations: DataFrame, most: int = BLOCK_ROWS) -> DataFrame:
    """The nodes of ``key, turns`` (see `sequences`): ``conv_id`` (the least member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``most``: rows of a block.
    """
    items = saved(keyed(conversations), "sequences").repartitionByRange("key", "least").sortWithinPartitions("key", "least")
    made = saved(items.mapInArrow(lambda b: blocks(b, False, True, most), MADE), "blocks")
    parts, nodes, upper, before = made.where(F.col("kind") == PARTIAL).select(ITEM), [made], None, None
    while True:
        left = parts.count()
        last = left <= most or before is not None and 2 * left > before
        n = 1 if last else -(-left // most)
        level = (parts.repartition(1) if last else parts.repartitionByRange(n, "key")).sortWithinPartitions("key")
        level = saved(level.mapInArrow(lambda b, last=last: blocks(b, last, False, most), MADE), "blocks")
        found = level.where(F.col("kind") == NODE)
        upper = found if upper is None else upper.unionByName(found)
        if last:
            break
        parts, before = level.where(F.col("kind") == PARTIAL).select(ITEM), left
    ends = made.where(F.col("kind") == ENDS).select("id", "ends", "least").repartition("id").sortWithinPartitions("id", "least").select("id", "ends")
    ends = ends.mapInArrow(chained, "id binary, ends_sha256 string")
    upper = saved(upper.drop("ends_sha256").join(ends, "id", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "edges")
    nodes = made.where(F.col("kind") == NODE).unionByName(upper)
    above = upper.select(F.col("id").alias("parent"), F.col("least").alias("above"))
    hanging = nodes.where(F.col("parent").isNotNull()).join(above, "parent").withColumn("parent_least", F.col("above"))
    rows = nodes.where(F.col("parent").isNull()).unionByName(hanging.drop("above"))
    return rows.select(
        F.col("least").alias("conv_id"), "depth", F.col("parent_least").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256")
