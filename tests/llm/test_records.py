"""Archives, the filter audit and the prefix trie against brute force."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidecast.llm import filter_audit, prefix_trie, warc
from tidecast.llm.radix_tree import Direct, Indexed, RadixTree, Sorted
from tidecast.workspace import new_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- archives

PAGES = [
    (1, "http://a/ü x", "<p>one</p>\n"), (2, None, None), (3, "u\r\nx", ""), (4, "http://b", "<p>one</p>\n"), (4, "http://b", "<p>one</p>\n"), (None, "n", "<p>one</p>\n"),
    (5, "l", "é" * 5000), (6, "l", "é" * 5000), (7, "crlf", "a\r\n\r\nWARC/1.0\r\n\r\n" * 40), (8, "b", "x" * 64), (9, "b", "x" * 65), (10, "%41+", "\n" * 200), (None, None, None),
    (11, "m", "\x00﻿\r" * 99),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "y", 0) for p in PAGES], "page_id long, url string, html string, record string, chunk int").repartition(3)


def expected_records(rows, least):
    first = {}
    for key, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", key)
    out, seen = [], Counter()
    for key, _, html in rows:
        body = (html or "").encode()
        seen[key, body] += 1
        response = len(body) < least or first[html or ""] == key and seen[key, body] == 1
        out.append((key, "response" if response else "revisit", len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), None if response else first[html or ""]))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 20])
def test_archives(spark, pages, least):
    path = warc.write_archives(pages, new_folder(spark, "test-archives"), "page_id", "url", "html", least_bytes=least, chunk_bytes=64)
    chunks = warc.read_archives(spark, path, chunk_bytes=64)
    got = Counter((None if r.key is None else int(r.key), r.record_type, r.payload_bytes, r.payload_digest, None if r.refers_to is None else int(r.refers_to))
                  for r in warc.records(chunks).collect())
    assert got == expected_records(PAGES, least)
    assert {(r.key, r.uri) for r in warc.records(chunks).collect()} == {(None if k is None else str(k), u) for k, u, _ in PAGES}
    payloads, types = defaultdict(bytes), {}
    for r in chunks.orderBy("record_id", "chunk").collect():
        payloads[r.record_id] += bytes(r.data)
        assert len(r.data) <= 64 and r.bytes == len(payloads[r.record_id]) and r.sha1 == hashlib.sha1(payloads[r.record_id]).digest()
        if r.last:
            types[r.record_id] = r.headers["warc-type"]
    assert Counter(payloads[k] for k, t in types.items() if t == "response") == Counter(
        r[2].encode() if r[2] else b"" for r, n in [((k, u, h), 1) for k, u, h in responses(PAGES, least)])
    assert not any(payloads[k] for k, t in types.items() if t == "revisit")
    narrow = warc.read_archives(spark, path, with_data=False)
    assert narrow.where("data IS NOT NULL OR NOT last").count() == 0 and narrow.count() == len(PAGES)


def responses(rows, least):
    seen, out = set(), []
    for key, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if len((html or "").encode()) < least or (html or "") not in seen:
            out.append((key, url, html))
        seen.add(html or "")
    return out


def test_archive_bytes_are_plain_warc(spark, pages, tmp_path):
    """A reader that knows only the file format finds the same records."""
    path = warc.write_archives(pages.where("page_id IN (5, 7, 8)").coalesce(1), str(tmp_path / "a"), "page_id", "url", "html", chunk_bytes=64)
    data = b"".join(gzip.open(f).read() for f in sorted((tmp_path / "a").glob("part-*.gz")))
    found = {}
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block, end, data = rest[:int(fields["Content-Length"])], rest[int(fields["Content-Length"]):][:4], rest[int(fields["Content-Length"]) + 4:]
        assert end == b"\r\n\r\n" and head.startswith(b"WARC/1.0")
        http, _, body = block.partition(b"\r\n\r\n")
        if b"chunked" in http:
            plain = b""
            while body:
                size, _, body = body.partition(b"\r\n")
                plain, body = plain + body[:int(size, 16)], body[int(size, 16) + 2:]
            body = plain
        found[int(fields["X-Row-Key"])] = body
    assert found == {k: h.encode() for k, _, h in PAGES if k in (5, 7, 8)} and path


def test_broken_archives(spark, tmp_path):
    good = warc.record_head(1, "1", None, 3, hashlib.sha1(b"abc").digest(), None, None, 64)
    for k, data in enumerate([good + b"abd\r\n\r\n", good + b"ab", b"junk\r\n", good + b"abcd\r\n\r\n"]):
        (tmp_path / f"{k}.txt.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="digest|ends within|no record|longer"):
            warc.read_archives(spark, str(tmp_path / f"{k}.txt.gz")).collect()
    (tmp_path / "other.txt.gz").write_bytes(gzip.compress(  # records of another kind, members of their own
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n") + gzip.compress(good + b"abc\r\n\r\n"))
    assert [r.record_type for r in warc.records(warc.read_archives(spark, str(tmp_path / "other.txt.gz"))).collect()] == ["warcinfo", "response"]


def test_no_pages(spark, pages):
    path = warc.write_archives(pages.limit(0), new_folder(spark, "test-archives"), "page_id", "url", "html")
    assert warc.read_archives(spark, path).count() == 0


# --- filter audit

def brute_audit(docs, labels):
    good, toxic, first = {d for d, q, _ in labels if q == 1} - {None}, {d for d, _, t in labels if t == 1} - {None}, {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    fails = []
    for d, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        f = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
             "D": bool(re.search(r"[#$%&*|]", text)), "E": d is not None and first[text] < d}
        fails.append((lang or "", {k for k, v in f.items() if v}, d in good, d in toxic))
    out = {}
    for part in {f[0] for f in fails}:
        own, removed_by = [f for f in fails if f[0] == part], Counter()
        rows = {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                removed_by[letter] += len(gone)
                rows[order, step] = [len(left), len(gone), sum(letter in f[1] for f in own) - len(gone), sum(f[1] == {letter} for f in own),
                                     sum(f[2] for f in gone), sum(f[3] for f in gone)]
        out |= {(part, *k): (*v, removed_by[k[0][k[1] - 1]]) for k, v in rows.items()}
    return out


def test_audit(spark):
    rng = random.Random(8)
    texts = [None, "", " \n\x0b\x85", "ABC", "a#", "w " * 120, " ".join(map(str, range(150))), " ".join(map(str, range(150))) + " %", "É" * 30 + "AAAA", "x y　z " * 60, "ß" * 90000]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["en", "fr", None, ""])) for _ in range(400)]
    docs += [(k, "hot text", "hot") for k in range(300)] + [docs[3], docs[3]]
    labels = [(rng.randint(0, 70), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(80)] + [(None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, n int, mask string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(spark, filter_audit.labelled_counts(filter_audit.failures(frame), marks)).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(rows) == len(got) and got == brute_audit(docs, labels)
    none = filter_audit.failures(frame.limit(0))
    assert filter_audit.audit(spark, filter_audit.labelled_counts(none, marks)).count() == 0
    assert filter_audit.audit(spark, filter_audit.labelled_counts(filter_audit.failures(frame), marks.limit(0))).where("good_lost + toxic_lost > 0").count() == 0


def test_intervals_cover_each_mask_once():
    """Added up, the intervals of a mask hold each order exactly once, at the step of its first failing letter."""
    orders = list(permutations(range(5)))
    for mask in range(1, 32):
        at = defaultdict(int)
        for m, step, rank, sign in filter_audit.interval_ends():
            if m == mask:
                at[step, rank] += sign
        for step in range(1, 6):
            inside = 0
            for rank, order in enumerate(orders):
                inside += at[step, rank]
                assert inside == (next(k for k, x in enumerate(order, 1) if mask >> x & 1) == step)


# --- radix tree and prefix trie

def test_radix_tree_holds_what_was_put():
    rng = random.Random(5)
    keys = {bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 9))) for _ in range(500)} | {bytes([k]) + b"xyz" for k in range(256)} | {b"q" * 3000, b"q" * 2999 + b"r"} | {bytes([200, k]) for k in range(10)}
    keys, tree = sorted(keys, key=lambda k: rng.random()), RadixTree()
    for k in keys:
        assert tree.slot(k).value is None
        tree.slot(k).value = k
    found, layouts, stack = [], set(), [(tree.root, b"")]
    while stack:
        node, above = stack.pop()
        key = above + node.piece
        layouts.add((type(node.below), getattr(node.below, "room", 0)))
        assert node is tree.root or node.value is not None or len(node.children()) > 1
        if node.value is not None:
            assert node.value == key
            found.append(key)
        stack += [(c, key) for c in reversed(node.children())]
    assert found == sorted(keys)
    assert {(Sorted, 4), (Sorted, 16), (Direct, 0)} <= layouts
    node = RadixTree()
    for k in range(40):
        node.slot(bytes([k]))
    assert type(node.root.below) is Indexed


def brute_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c - (abs(c) % 20) * (1 if c >= 0 else -1))
        rebuilt[c] = own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    out = {}
    for path, convs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        out[min(convs), len(path)] = (
            min(members[path[:-1]]) if path else None, len(convs), sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p),
            hashlib.sha256(",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(path)))).encode()).hexdigest())
    return out


@pytest.mark.parametrize("most", [3, 40, 50_000])
def test_trie(spark, most):
    rng = random.Random(most)
    rows = []
    for c in [*range(-45, 300), 10**12]:
        n = rng.choice([1, 1, 2, 3, 5, 9])
        rows += [(c, rng.choice([None, k]) if c % 7 == 0 else k, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", "c  d\te", "a\x85b"])) for k in range(n)]
    rows += [(c, k, "user", "same thing") for c in range(300, 500) for k in range(4)]  # one conversation many times
    rows += [(700, k, "user", f"{k % 3}") for k in range(300)]  # a long one
    rows += [(None, 1, "user", "nobody's"), (40, 2, None, None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn int, role string, text string, least string").repartition(5)
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
           for r in prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(frame)), most).collect()}
    want = brute_trie(tied(rows))
    assert got.keys() == want.keys() and got == want
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(frame.limit(0)))).count() == 0


def tied(rows):
    """Rows with whole numbers that put turns of one number in the order of role and id, as the operator does."""
    def place(r):
        role, text = r[2] or "", r[3] or ""
        return (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32])

    return [(r[0], k, r[2], r[3]) for k, r in enumerate(sorted(rows, key=place))]


def test_turn_ids_keep_role_and_text_apart(spark):
    ids = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "abc"), ("1:", "x"), ("1", ":x")], "role string, text string").select(
        prefix_trie.turn_id(F.col("role"), F.col("text")).alias("id")).collect()
    assert len({r.id for r in ids}) == 5 and all(len(r.id) == 32 for r in ids)
