"""Suffix array and capped common-prefix values of one shard, by external induced sorting.

Suffixes that are smaller than their right neighbour but follow a larger one (LMS suffixes) are sorted first; all others
are induced from them: a sweep from the smallest letter up yields the larger-than-neighbour suffixes, a sweep down the rest.  The
sweeps move suffixes through one priority queue.  It is keyed by letter and, within a letter, by arrival, as a sweep meets its
suffixes in order; so it is a row of first-in-first-out runs that go to an anonymous scratch file when they outgrow memory and
come back run by run.  Each entry carries its suffix and the common prefix with the entry before it; a letter's next common
prefix is one more than the least value met since its last entry.

The reduced string of LMS substrings has too many letters for such runs; its suffixes are sorted by doubling of ranks, until
they differ or agree for ``cap`` bytes, which is all that callers need.  Beyond that, order and prefix values are not defined.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Bytes of queue entries kept in memory by one sort.
MEMORY = 64 << 20
#: Entries that induce their neighbours at once.
STEP = 1 << 18
#: Values whose ranges are read as they are, without a table.
SHORT = 2048
ENTRY = np.dtype([("at", "<i8"), ("lcp", "<u2")])
BASE = np.uint64(0x9E3779B97F4A7C15)


class Runs:
    """The queue: entries by letter in the order they came, on disk beyond ``memory`` bytes."""

    def __init__(self, letters: int, memory: int = MEMORY) -> None:
        self.of: list[list] = [[] for _ in range(letters)]
        self.held, self.memory, self.file = 0, memory, None

    def push(self, letter: int, entries: np.ndarray) -> None:
        if self.held + entries.nbytes > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # private to this attempt; gone when closed
            self.of[letter].append((self.file.seek(0, 2), len(entries)))
            self.file.write(entries.tobytes())
        else:
            self.held += entries.nbytes
            self.of[letter].append(entries)

    def pop(self, letter: int):
        """The runs of a letter, oldest first; runs pushed meanwhile wait for the next call."""
        runs, self.of[letter] = self.of[letter], []
        for run in runs:
            if isinstance(run, tuple):
                self.file.seek(run[0])
                run = np.frombuffer(self.file.read(run[1] * ENTRY.itemsize), ENTRY)
            else:
                self.held -= run.nbytes
            yield run

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def range_min(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each range, ends included."""
    if len(values) <= SHORT:
        bounds = np.empty(2 * len(first), np.int64)
        bounds[::2], bounds[1::2] = first, last + 1
        return np.minimum.reduceat(np.append(values, values[-1:]), bounds)[::2]
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        step = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][first[own]], table[k][last[own] - (1 << k) + 1])
    return out


class Sweep:
    """One pass over the letters: entries in sorted order, and the entries they induce.  A ``cap`` of 0 leaves common prefixes out."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, letters: int, cap: int, memory: int) -> None:
        self.text, self.wanted, self.cap, self.queue = text, wanted, cap, Runs(letters, memory)
        self.since = np.full(letters, -1, np.int64)  # least value since the letter's last entry; -1 before its first

    def induce(self, entries: np.ndarray) -> None:
        for k in range(0, len(entries), STEP):
            self.step(entries[k:k + STEP])

    def step(self, entries: np.ndarray) -> None:
        """Queue the left neighbours of entries that come next in order, where they are of the wanted type."""
        at, lcp = entries["at"], entries["lcp"].astype(np.int32) if self.cap else ()
        chosen = np.flatnonzero((at > 0) & self.wanted[at - 1])
        letters = self.text[at[chosen] - 1]
        order = np.argsort(letters, kind="stable")
        chosen, letters = chosen[order], letters[order].astype(np.int64)
        heads = np.flatnonzero(np.append(True, letters[1:] != letters[:-1])) if len(letters) else np.zeros(0, np.int64)
        present = letters[heads]
        if not self.cap:
            out = np.zeros(len(chosen), ENTRY)
            out["at"] = at[chosen] - 1
            for letter, a, b in zip(present.tolist(), heads.tolist(), np.append(heads[1:], len(letters)).tolist()):
                self.queue.push(letter, out[a:b])
        elif len(chosen):
            before = np.append(-1, chosen[:-1])
            before[heads] = -1
            least = range_min(lcp, before + 1, chosen)
            least[heads] = np.minimum(least[heads], self.since[present])
            out = np.empty(len(chosen), ENTRY)
            out["at"], out["lcp"] = at[chosen] - 1, np.minimum(least + 1, self.cap)
            ends = np.append(heads[1:], len(letters))
            self.since = np.minimum(self.since, lcp.min())
            tail = chosen[ends - 1]
            after = np.full(len(present), self.cap, np.int64)
            some = tail + 1 < len(lcp)
            after[some] = range_min(lcp, tail[some] + 1, np.full(some.sum(), len(lcp) - 1))
            self.since[present] = after
            for letter, a, b in zip(present.tolist(), heads.tolist(), ends.tolist()):
                self.queue.push(letter, out[a:b])
        elif len(lcp):
            self.since = np.minimum(self.since, lcp.min())


def common(text: np.ndarray, a: int, b: int, cap: int) -> int:
    if not cap:
        return 0
    n = min(cap, len(text) - max(a, b))
    other = np.flatnonzero(text[a:a + n] != text[b:b + n])
    return int(other[0]) if len(other) else n


def sweep(text: np.ndarray, wanted: np.ndarray, seeds: list[np.ndarray], up: bool, cap: int, memory: int) -> list[np.ndarray]:
    """Entries of the wanted type by letter, in the order met.  ``seeds``: the other entries of each letter, which come after them."""
    run = Sweep(text, wanted, len(seeds), cap, memory)
    if up:
        last = np.zeros(1, ENTRY)
        last["at"] = len(text)
        run.induce(last)
    out: list[np.ndarray] = [np.zeros(0, ENTRY)] * len(seeds)
    for letter in range(len(seeds)) if up else range(len(seeds) - 1, -1, -1):
        met = []
        while run.queue.of[letter]:
            for entries in run.queue.pop(letter):
                if not met and len(entries):
                    entries = entries.copy()
                    entries["lcp"][0] = 0
                met.append(entries)
                run.induce(entries)
        if met:
            out[letter] = np.concatenate(met)
        own = seeds[letter]
        if len(own):
            own = own.copy()
            own["lcp"][0] = common(text, int(out[letter]["at"][-1]), int(own["at"][0]), cap) if met else 0
            run.induce(own)
    run.queue.close()
    return out


def by_letter(text: np.ndarray, at: np.ndarray, lcp: np.ndarray, letters: int) -> list[np.ndarray]:
    entries = np.empty(len(at), ENTRY)
    entries["at"], entries["lcp"] = at, lcp
    bound = np.searchsorted(text[at], np.arange(letters + 1))
    return [entries[a:b] for a, b in zip(bound[:-1], bound[1:])]


def induced(text: np.ndarray, is_s: np.ndarray, at: np.ndarray, lcp: np.ndarray, letters: int, cap: int, memory: int) -> np.ndarray:
    """All suffixes in order with common-prefix values, from sorted LMS suffixes."""
    large = sweep(text, ~is_s, by_letter(text, at, lcp, letters), True, cap, memory)
    down = []
    for own in large:  # the sweep down meets them backwards; each value then belongs to the entry after it
        back = own[::-1].copy()
        back["lcp"][1:] = own["lcp"][:0:-1]
        down.append(back)
    small = sweep(text, is_s, down, False, cap, memory)
    out = []
    for high, low in zip(large, small):
        low_up = low[::-1].copy()
        if len(low):
            low_up["lcp"][1:] = low["lcp"][:0:-1]
            low_up["lcp"][0] = common(text, int(high["at"][-1]), int(low_up["at"][0]), cap) if len(high) else 0
        out += [high, low_up]
    return np.concatenate(out)


def suffix_array(data: np.ndarray, cap: int, memory: int = MEMORY) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``data`` (small integers) in order, and how much each has in common with the one before, up to ``cap``."""
    text = data.astype(np.int64)
    n, letters = len(text), int(text.max()) + 1 if len(text) else 0
    if n < 2:
        return np.arange(n), np.zeros(n, np.int64)
    narrow = text.astype(np.uint16) if letters <= 1 << 16 else text  # 16-bit letters are sorted by counting
    # A suffix is small if the first letter that differs from its own is larger; the end counts as smallest.
    step = np.append(np.sign(text[1:] - text[:-1]), -1)
    known = np.flatnonzero(step)
    is_s = step[known[np.searchsorted(known, np.arange(n))]] > 0
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    none = np.zeros(0, np.int64)
    if not len(lms):
        entries = induced(narrow, is_s, none, none, letters, cap, memory)
        return entries["at"], entries["lcp"].astype(np.int64)
    # LMS substrings in order: induce from LMS positions sorted by their letter only.
    first = lms[np.argsort(narrow[lms], kind="stable")]
    rough = induced(narrow, is_s, first, np.zeros(len(first)), letters, 0, memory)["at"]
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = rough[is_lms[rough]]
    index = np.zeros(n, np.int64)
    index[lms] = np.arange(len(lms))
    ends = np.append(lms[1:], n - 1)
    inside = np.arange(lms[0], n) - np.repeat(lms, np.diff(np.append(lms, n)))
    power = np.multiply.accumulate(np.append(np.uint64(1), np.full(int(inside.max()), BASE)))
    code = np.add.reduceat((text[lms[0]:].astype(np.uint64) + np.uint64(1)) * power[inside], lms - lms[0])
    same = np.stack([code, (ends - lms).astype(np.uint64), text[ends].astype(np.uint64)])[:, index[order]]
    rank = np.empty(len(lms), np.int64)
    rank[index[order]] = np.cumsum(np.append(False, (same[:, 1:] != same[:, :-1]).any(axis=0)))
    reach = 1
    while rank.max() + 1 < len(rank) and reach < cap:  # a name spans two letters at least
        key = rank * (len(rank) + 1) + np.append(rank[reach:] + 1, np.zeros(min(reach, len(rank)), np.int64))[:len(rank)]
        by = np.argsort(key, kind="stable")
        rank[by] = np.cumsum(np.append(False, key[by][1:] != key[by][:-1]))
        reach *= 2
    at = lms[np.argsort(rank, kind="stable")]
    entries = induced(narrow, is_s, at, adjacent_common(text, at, cap), letters, cap, memory)
    return entries["at"], entries["lcp"].astype(np.int64)


def adjacent_common(text: np.ndarray, at: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix and the one before it, up to ``cap``, four letters a step."""
    wide = np.concatenate([text + 1, np.zeros(4, np.int64)]).astype(np.uint64)
    packed = wide[:-3] << np.uint64(48) | wide[1:-2] << np.uint64(32) | wide[2:-1] << np.uint64(16) | wide[3:]
    out, open_ = np.zeros(len(at), np.int64), np.arange(1, len(at))
    for step in range(0, cap, 4):
        a, b = at[open_] + step, at[open_ - 1] + step
        inside = np.maximum(a, b) < len(text)
        equal = np.zeros(len(open_), bool)
        equal[inside] = packed[a[inside]] == packed[b[inside]]
        for row, x, y in zip(*(v[~equal & inside] for v in (open_, a, b))) if (~equal & inside).sum() < 64 else ():
            out[row] = step + common(text, int(x), int(y), 4)
        if (~equal & inside).sum() >= 64:
            rows, x, y = (v[~equal & inside] for v in (open_, a, b))
            off = packed[x] ^ packed[y]
            out[rows] = step + (off < 1 << 48) * 1 + (off < 1 << 32) * 1 + (off < 1 << 16) * 1
        out[open_[~inside]] = step
        open_ = open_[equal]
        out[open_] = step + 4
        if not len(open_):
            break
    return np.minimum(out, cap)
