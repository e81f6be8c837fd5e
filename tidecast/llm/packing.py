"""Order-preserving packing of documents into sequences of a fixed length.

Documents are laid end to end in input order.  A dynamic program chooses where sequences end: at document ends, at
sentence ends, or, inside long stretches without either, at a regular step.  It minimises padding plus a penalty for each
cut inside a document.  The best earlier cut of every possible end comes from a monotone queue over the window of cuts
that one sequence can reach; cuts at exactly a power of two before are tried as well, as such sequences need no padding.
Each task packs its own partition without a shuffle; all but the unfinished last sequence of a run is final, and the very last
one is cut into powers of two, so a partition leaves no padding at its end.

Defined cases: a NULL or empty text has its end id alone.  Rows are packed in the order of their partition, repeated
rows each for themselves.  A text longer than a sequence goes on in the next ones.  An empty table gives no rows.  Of the
input's columns only the key is kept, under the name ``doc_id``.
"""

from __future__ import annotations

import json
import os
import string
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SIZE = 4096
END_ID = 2
#: Tokens of padding that a cut at a sentence end, or inside a sentence, may save before it is worth it.
SENTENCE_CUT, FORCED_CUT = 16.0, 256.0
#: Sentence ends are considered once in so many tokens, forced cuts every so many.
GRAIN, STRIDE = 32, 512
#: Tokens packed in one run of the program, and words whose ids a worker remembers.
RUN, REMEMBERED = 1 << 19, 100_000
#: Marks that may follow a word's letters, how many at most are looked up by themselves, and how many such endings are kept.
MARKS, LONGEST_MARKS, MARKS_REMEMBERED = string.punctuation, 8, 100_000
#: Letters below this one are Latin and composed.
LATIN_END = "\u0250"
#: A special token that splits any text, and the texts and letters tokenised at once.
BETWEEN, TOGETHER, LETTERS = "<|endoftext|>", 128, 1 << 19
PIECES = ("doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


class LetterIds:
    """Ids of small-letter words by the merges in a tokenizer's file: a pair is merged in the order of the merged token's id.

    That is the file's own order of merges, so ids are those of the tokenizer; ``END`` stands for the mark of a word's end, as
    small-letter words hold no capitals.
    """

    END, SUFFIX = "Z", "</w>"

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the file writes as themselves
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)).difference(shown)))}
        ends = {token: token.endswith(self.SUFFIX) for token in vocabulary}
        ranks = {bytes(map(byte_of.__getitem__, token.removesuffix(self.SUFFIX))) + self.END.encode() * ends[token]: i for token, i in vocabulary.items()}
        self.encoding = tiktoken.Encoding("words", pat_str=f"[^{self.END}]+{self.END}", mergeable_ranks=ranks, special_tokens={})
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if ends[token]]] = True

    def __call__(self, words: list[str]) -> dict[str, bytes]:
        if not words:
            return {}
        ids = np.array(self.encoding.encode_ordinary(self.END.join(words) + self.END), "<u4")
        data, begin, out = ids.tobytes(), 0, {}
        for word, end in zip(words, ((np.flatnonzero(self.is_end[ids]) + 1) * 4).tolist()):
            out[word] = data[begin:end]
            begin = end
        return out


class WordIds:
    """Ids of texts, word by word: pre-tokens of this vocabulary never reach across white space, so words are looked up once.

    New words of plain letters, with or without marks behind them, go through ``LetterIds``.  All others are encoded by the
    tokenizer together, with a special token between them.
    """

    def __init__(self, path: str, between: str = BETWEEN) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer, self.between, self.letters = Tokenizer.from_file(path), between, LetterIds(path)
        self.split_id = self.tokenizer.token_to_id(between)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.is_mark = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.is_mark[np.concatenate([self.encode(m) for m in ".!?"])] = True

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def learn(self, words: set[str]) -> None:
        """Take words from among those met before; encode what remains."""
        stems, other = {}, []
        for word in words:
            if (ids := self.before.get(word)) is not None:
                self.known[word] = ids
            elif plain(stem := word.rstrip(MARKS)) and len(word) - len(stem) <= LONGEST_MARKS:
                stems[word] = stem.lower()
            else:
                other.append(word)
        found = self.letters(list(set(stems.values())))
        for word, stem in stems.items():
            closing = word[len(stem):]
            if closing not in self.marks:
                if len(self.marks) > MARKS_REMEMBERED:
                    self.marks = {"": b""}
                self.marks[closing] = self.encode(closing).tobytes()
            self.known[word] = found[stem] + self.marks[closing]
        for word in [w for w in other if "<|" in w]:
            self.known[word] = self.encode(word).tobytes()
        if other := [w for w in other if "<|" not in w]:
            ids = self.encode(self.between.join(other))
            ends = np.append(np.flatnonzero(ids == self.split_id), len(ids))
            data, begin = ids.tobytes(), 0
            for word, end in zip(other, (ends * 4).tolist()):
                self.known[word] = data[begin:end]
                begin = end + 4

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        split = [text.replace("\n", " ").split(" ") for text in texts]
        found = [list(map(self.known.get, own)) for own in split]
        holes = [[i for i, ids in enumerate(row) if ids is None] for row in found]
        self.learn({own[i] for own, at in zip(split, holes) for i in at})
        for own, row, at in zip(split, found, holes):
            for i in at:
                row[i] = self.known[own[i]]
        return [np.frombuffer(b"".join(row), "<u4") for row in found]


def stretches(text: str, most: int = LETTERS) -> Iterator[str]:
    """The text cut at blanks into stretches of at least ``most`` letters; the blanks at the cuts go, as `WordIds` splits there anyway."""
    begin = 0
    while 0 <= (end := text.find(" ", begin + most)):
        yield text[begin:end]
        begin = end + 1
    yield text[begin:]


def in_groups(column: pa.Array, most: int = LETTERS) -> Iterator[tuple[int, list[str]]]:
    """Texts of a column, with the row of the first: at most ``TOGETHER`` of together about ``most`` letters, a longer one alone."""
    group, letters = [], 0
    for row, value in enumerate(column):
        text = value.as_py() or ""
        if group and (len(group) == TOGETHER or letters + len(text) > most):
            yield row - len(group), group
            group, letters = [], 0
        group.append(text)
        letters += len(text)
    if group:
        yield len(column) - len(group), group


@cache
def word_ids(path: str) -> WordIds:
    """One table of words per Python worker, for all its tasks."""
    return WordIds(path)


def plain(stem: str) -> bool:
    """Whether a word is one pre-token that only has to be put in small letters: ASCII or Latin letters, already composed."""
    return stem.isalpha() and (stem.isascii() or stem < LATIN_END and max(stem) < LATIN_END and "\u0130" not in stem)


def cut_points(lengths: np.ndarray, ids: np.ndarray, is_mark: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Where a sequence may end within documents laid end to end, from 0 to the end of all, and the penalty of each place."""
    ends = np.cumsum(lengths)
    sentences = np.flatnonzero(is_mark[ids]) + 1
    sentences = sentences[np.flatnonzero(np.diff(sentences // GRAIN, append=-1))]
    inner = np.setdiff1d(sentences, ends, assume_unique=True)
    fixed = np.sort(np.concatenate([[0], inner, ends]))
    gaps = np.diff(fixed)
    steps = np.maximum(0, -(-gaps // stride) - 1)
    forced = np.repeat(fixed[:-1], steps) + stride * (1 + np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps))
    at = np.concatenate([[0], ends, inner, forced])
    cost = np.repeat([0.0, SENTENCE_CUT, FORCED_CUT], [1 + len(ends), len(inner), len(forced)])
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def best_cuts(at: list[int], cost: list[float], size: int = SIZE) -> list[int]:
    """Indexes of the chosen ends; ``at`` ascends from 0 by steps of at most ``size``."""
    powers = [p for p in (size, size // 2, size // 4) if p and p & (p - 1) == 0]
    best, came, index = [0.0] * len(at), [0] * len(at), {at[0]: 0}
    queue = deque([(float(at[0]), 0)])
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0][1]] < here - size:
            queue.popleft()
        least, i = queue[0]
        least += size - here
        for p in powers:
            k = index.get(here - p)
            if k is not None and best[k] <= least:
                least, i = best[k], k
        best[j], came[j], index[here] = least + cost[j], i, j
        value = best[j] + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    out, j = [], len(at) - 1
    while j:
        out.append(j)
        j = came[j]
    return out[::-1]


def split_powers(first: int, last: int) -> Iterator[tuple[int, int]]:
    """The range in pieces whose lengths are powers of two."""
    while first < last:
        step = 1 << ((last - first).bit_length() - 1)
        yield first, first + step
        first += step


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", size: int = SIZE,
         run: int = RUN) -> DataFrame:
    """A row per piece: the ids (little-endian unsigned 32-bit) that one document has in one sequence, and their place.

    ``sequence_id`` is the task's partition in the upper bits and the sequence's number below.
    """
    def work(batches):
        encode, task = word_ids(tokenizer_path), TaskContext.get().partitionId() << 32
        made, end = 0, np.array([END_ID], "<u4")
        waiting: list[tuple] = []  # key, ids not yet packed, start of these in the document, length of the document

        def rows(windows: list[tuple[int, int]], upto: int):
            """Pieces of the windows; what lies beyond ``upto`` goes on waiting."""
            nonlocal made, waiting
            out, k, left, place = [], 0, [], 0
            for name, ids, start, total in waiting:
                done = 0
                while done < len(ids) and place + done < upto:
                    while windows[k][1] <= place + done:
                        k += 1
                    first, last = windows[k]
                    take = min(len(ids) - done, last - place - done)
                    out.append((name, start + done, take, ids[done:done + take].tobytes(), total, task + made + k, place + done - first))
                    done += take
                if done < len(ids):
                    left.append((name, ids[done:], start + done, total))
                place += len(ids)
            waiting, made = left, made + len(windows)
            return out

        def settle(final: bool):
            at, cost = cut_points(np.array([len(w[1]) for w in waiting]), np.concatenate([w[1] for w in waiting]), encode.is_mark, min(STRIDE, size))
            at = at.tolist()
            chosen = [0] + [at[i] for i in best_cuts(at, cost.tolist(), size)]
            windows = list(zip(chosen, chosen[1:]))
            if final and windows:
                windows[-1:] = split_powers(*windows[-1])
            elif not final:
                windows.pop()
            return rows(windows, windows[-1][1] if windows else 0)

        def batch_of(out):
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_arrow), *[pa.array(c, pa.binary() if i == 2 else pa.int64()) for i, c in enumerate(columns[1:])]],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        held = 0
        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for first, texts in in_groups(batch.column(1)):
                encoded = encode(texts) if len(texts) > 1 else [np.concatenate([encode([part])[0] for part in stretches(texts[0])])]
                for name, ids in zip(batch.column(0).slice(first, len(texts)).to_pylist(), encoded):
                    waiting.append((name, np.append(ids, end).astype("<u4"), 0, len(ids) + 1))
                    held += len(ids) + 1
                    if held >= run:
                        if out := settle(False):
                            yield batch_of(out)
                        held = sum(len(w[1]) for w in waiting)
        if waiting and (out := settle(True)):
            yield batch_of(out)

    id_type = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(work, PIECES.format(id_type=id_type))
