"""Chat formatting as packed prefix trees.

A turn is written as ``<turn>role``, a line break, the text, ``</turn>`` and a line break; a backslash before every backslash and ``<`` of a text or
role (and a line break of a role) keeps the marks unambiguous and is taken off again when reading.  Conversations that share
their first turns lie beside each other once sorted by the hashes of their turns, so a streaming pass over the sorted
rows walks their prefix tree depth first.  Each turn that differs from the path of the conversation before becomes a node and is emitted once.

A pack is one training sequence: the ids of its nodes in depth-first order, the position of each id (counted along its
own path), the ids under the loss (texts of assistants), each node's parent, and for each node the intervals of its ancestors, which are what it may attend to besides
itself.  A pack ends when the next conversation would make it longer than ``PACK`` ids; the next one repeats the shared turns it needs.
The sort splits large groups anywhere, so neither a common first turn nor a common conversation has to fit into a task.

Defined cases: a NULL text or role is empty.  Turns with equal numbers are ordered by role and text; a NULL number comes
first.  Rows of a NULL conversation id form one conversation.  Equal conversations share all nodes.  A conversation longer than a pack is
alone in one.  An empty table gives no packs.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

PACK, MOST_CONVERSATIONS = 8192, 512
OPEN, CLOSE = "<turn>", "</turn>\n"
LEARNED = "assistant"
PACK_SCHEMA = ("pack_id long, ids array<int>, positions array<int>, loss array<boolean>, starts array<int>, parents array<int>, "
               "attends array<array<int>>, conversations array<{id_type}>, ends array<int>")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation.  Marks are the only places with an unescaped ``<``."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError("not a formatted conversation")
        role_end = formatted.index("\n", at)
        end = role_end + 1
        while formatted[end] != "<":
            stop = min(x for x in (formatted.find("<", end), formatted.find("\\", end)) if x >= 0)
            end = stop if formatted[stop] == "<" else stop + 2
        turns.append((unescape(formatted[at + len(OPEN):role_end]), unescape(formatted[role_end + 1:end])))
        if not formatted.startswith(CLOSE, end):
            raise ValueError("a turn does not end with its mark")
        at = end + len(CLOSE)
    return turns


class Coder:
    """Byte-level tokens of a public vocabulary; any text comes back exactly."""

    def __init__(self, path: str) -> None:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = self.coder.encode_ordinary
        self.fixed = {t: self.encode(t) for t in (CLOSE,)}

    def decode(self, ids: list[int]) -> str:
        return self.coder.decode_bytes(ids).decode("utf-8")

    def turn(self, role: str, text: str) -> tuple[list[int], list[bool]]:
        head = f"{OPEN}{escape_role(role)}\n"
        before = self.fixed.get(head) or self.fixed.setdefault(head, self.encode(head)) if len(self.fixed) < 1000 else self.encode(head)
        body, after = self.encode(escape(text)), self.fixed[CLOSE]
        return before + body + after, [False] * len(before) + [role == LEARNED] * len(body) + [False] * len(after)


class Pack:
    def __init__(self) -> None:
        self.ids, self.positions, self.loss, self.starts, self.parents, self.attends = [], [], [], [], [], []
        self.conversations, self.ends = [], []

    def add(self, parent: int, ids: list[int], loss: list[bool]) -> int:
        start, above = len(self.ids), []
        if parent >= 0:
            above = self.attends[parent] + [self.starts[parent], self.end(parent)]
        first = sum(b - a for a, b in zip(above[::2], above[1::2]))
        self.ids += ids
        self.loss += loss
        self.positions += range(first, first + len(ids))
        self.starts.append(start)
        self.parents.append(parent)
        self.attends.append(above)
        return len(self.starts) - 1

    def end(self, node: int) -> int:
        return self.starts[node + 1] if node + 1 < len(self.starts) else len(self.ids)


def packs(batches: Iterator[pa.RecordBatch], coder: Coder, first_id: int) -> Iterator[pa.RecordBatch]:
    """Packs of conversations that come sorted by their turns."""
    path: list[tuple] = []  # (role, text), node, ids, loss along the conversation before
    pack, made = Pack(), 0

    def row(kind) -> pa.RecordBatch:
        columns = [pack.ids, pack.positions, pack.loss, pack.starts, pack.parents, pack.attends]
        types = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.bool_())] + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(
            [pa.array([first_id + made]), *[pa.array([c], t) for c, t in zip(columns, types)], pa.array([pack.conversations], pa.list_(kind)),
             pa.array([pack.ends], pa.list_(pa.int32()))],
            names=["pack_id", "ids", "positions", "loss", "starts", "parents", "attends", "conversations", "ends"])

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field(0).type
        for name, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            turns = [(t["role"], t["text"]) for t in turns]
            shared = 0
            while shared < min(len(path), len(turns)) and path[shared][0] == turns[shared]:
                shared += 1
            new = [(t, -1, *coder.turn(*t)) for t in turns[shared:]]
            if pack.conversations and (len(pack.ids) + sum(len(n[2]) for n in new) > PACK or len(pack.conversations) >= MOST_CONVERSATIONS):
                yield row(kind)
                pack, made = Pack(), made + 1
                new, shared = path[:shared] + new, 0
            path = path[:shared]
            for turn, _, ids, loss in new:
                path.append((turn, pack.add(path[-1][1] if path else -1, ids, loss), ids, loss))
            pack.conversations.append(name)
            pack.ends.append(path[-1][1])
    if pack.conversations:
        yield row(kind)


def format_chats(turns: DataFrame, vocabulary_path: str, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per pack, see the module's text.  ``ends`` holds the last node of each of ``conversations``."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = turns.select(F.col(key).alias("key"), one.alias("t")).groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    whole = whole.withColumn("path", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])))
    whole = whole.repartitionByRange("path", "key").sortWithinPartitions("path", "key").select("key", "turns")
    id_type = turns.select(key).schema[0].dataType.simpleString()

    def work(batches):
        yield from packs(batches, Coder(vocabulary_path), TaskContext.get().partitionId() << 32)

    return whole.mapInArrow(work, PACK_SCHEMA.format(id_type=id_type))


def read_back(chats: DataFrame, vocabulary_path: str) -> DataFrame:
    """Each conversation as the packs hold it: ``conv_id, turns`` (roles and texts), ``learned`` (texts under the loss), ``formatted_chars``."""
    id_type = chats.schema["conversations"].dataType.elementType.simpleString()

    def work(batches):
        coder = Coder(vocabulary_path)
        for batch in batches:
            kind = batch.schema.field("conversations").type.value_type
            for pack in batch.to_pylist():
                ids, loss, starts = np.array(pack["ids"]), np.array(pack["loss"]), pack["starts"] + [len(pack["ids"])]
                spans = [(a, b) for a, b in zip(starts, starts[1:])]
                nodes = [coder.decode(ids[a:b].tolist()) for a, b in spans]
                under = [unescape(coder.decode(ids[a:b][loss[a:b]].tolist())) for a, b in spans]
                at = {a: k for k, a in enumerate(starts[:-1])}
                rows = []
                for name, end in zip(pack["conversations"], pack["ends"]):
                    way = [at[a] for a in pack["attends"][end][::2]] + [end]
                    formatted = "".join(nodes[k] for k in way)
                    rows.append((name, [{"role": r, "text": t} for r, t in parse(formatted)], [under[k] for k in way], len(formatted)))
                names, turns, learned, chars = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, kind), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                     pa.array(learned, pa.list_(pa.string())), pa.array(chars, pa.int64())], names=["conv_id", "turns", "learned", "formatted_chars"])

    return chats.mapInArrow(work, f"conv_id {id_type}, turns array<struct<role:string,text:string>>, learned array<string>, formatted_chars long")
