"""Suffix dedup, n-gram join and neighbours against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidecast.llm import induced_sort, neighbours, ngram_join, suffix_dedup
from tidecast.llm.components import components
from tidecast.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_removed int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, base = words(rng, 130), words(rng, 220)
    out = [None, "", "one", "One", "one two three", "a\tb c\nd", "x" * 900, "ab" * 700, passage]
    out += [f"{words(rng, 20)} {passage} {words(rng, 30)}" for _ in range(7)]
    for k in range(14):
        edited = base.split()
        for _ in range(k // 2):
            edited[rng.randrange(len(edited))] = words(rng, 1)
        out.append(" ".join(edited))
    return out + [base, base, out[10], words(rng, 30000) + " " + passage] + [words(rng, rng.randint(1, 80)) for _ in range(10)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, None if k % 3 else "en", f"s{k % 4}" if k % 5 else None, 9) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[12]], DOCS).repartition(3)


def repeated(texts, span):
    """Per text: which bytes a string of ``span`` bytes covers that starts at another place too."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + span] for t in data for i in range(len(t) - span + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone[i:i + span] = True
        out.append(gone)
    return data, out


@pytest.mark.parametrize("memory", [0, 300, 1 << 20])
def test_suffix_array(memory):
    rng = random.Random(memory)
    for _ in range(120):
        data = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 50))] * rng.randint(1, 3)
        order = sorted(range(len(data)), key=lambda i: data[i:])
        at, lcp = induced_sort.suffix_array(np.array(data), 200, memory)
        assert at.tolist() == order
        for k in range(1, len(order)):
            a, b = data[order[k - 1]:], data[order[k]:]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("most", [2, 500])
def test_suffix_dedup(docs, texts, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = suffix_dedup.removed(docs, keep=("doc_id",)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).collect()
    data, gone = repeated(texts + [texts[12]], suffix_dedup.SPAN)
    want = Counter()
    for k, (t, g) in enumerate(zip(data, gone)):
        spans = int((np.diff(np.append(0, g.astype(int))) == 1).sum())
        want[k if k < len(texts) else 12, len(t), int(g.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~g])).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows) == want


def test_suffix_clean(docs, texts):
    out = {r.doc_id: r for r in suffix_dedup.clean(docs).collect()}
    assert set(out) == set(range(len(texts))) and out[0].text is None and out[1].text == "" and out[1].n_removed == 9
    assert out[6].text == "" and out[4].text == "one two three"


def test_suffix_dedup_without_rows(docs):
    assert suffix_dedup.removed(docs.limit(0), keep=("doc_id",)).count() == 0


def word_runs(texts, n):
    """Each text without the bytes of runs of ``n`` words, or of 400 bytes, that start anywhere else too."""
    data, gone = repeated(texts, 400)
    own = [list(re.finditer(rb"[^\x20\x09-\x0D]+", t)) for t in data]
    runs = Counter(tuple(m[0] for m in w[k:k + n]) for w in own for k in range(len(w) - n + 1))
    for w, g in zip(own, gone):
        for k in range(len(w) - n + 1):
            if runs[tuple(m[0] for m in w[k:k + n])] > 1:
                g[w[k].start():w[k + n - 1].end()] = True
    return [bytes(np.frombuffer(t, np.uint8)[~g]).decode("utf-8", "ignore") for t, g in zip(data, gone)]


def test_repeated_passages(spark):
    rng = random.Random(8)
    short = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (49, 50, 70)]
    out = [None, "", " \t ", "x" * 900, "ab " * 60, words(rng, 300)]
    for k, passage in enumerate([*short, short[1].replace(" ", "\n"), words(rng, 55), words(rng, 150)]):
        out += [f"{words(rng, 20 + k)} {passage} {words(rng, 30)}", f"{passage}\n{words(rng, 9)}", f" {words(rng, 70)}{passage}é {passage}"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(out)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in suffix_dedup.clean(docs, passages=True).collect()}
    assert got.pop(0) is None
    want = word_runs(out, 50)
    assert got == dict(enumerate(want[1:], 1)) and want[5] == out[5] and sum(a != b for a, b in zip(out, want)) > 12
    assert suffix_dedup.clean(docs.limit(0), passages=True).count() == 0


def test_words_as_bytes():
    texts = [None, "ab cd\tab", "", "ab", "\n", "cdab " + "z" * 70 + "é", "z" * 70 + "é"]
    data, offsets = suffix_dedup.word_view(pa.array(texts).slice(0))
    ids = [data[a:b].view(np.uint64).tolist() for a, b in zip(offsets, offsets[1:])]
    assert [len(i) for i in ids] == [0, 3, 0, 1, 0, 2, 1] and ids[1][0] == ids[1][2] == ids[3][0] and ids[5][1] == ids[6][0]
    assert len({c for i in ids for c in i}) == 4
    few = suffix_dedup.word_view(pa.array(texts).slice(3, 3))
    assert few[0].tobytes() == data[offsets[3]:offsets[6]].tobytes() and few[1].tolist() == [0, 8, 8, 24]


def grams(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(own[k:k + 5]) for k in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} if own else set()


def groups(texts):
    sets, root = [grams(t) for t in texts], list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return [(k, len(s), r) for k, (s, r) in enumerate(zip(sets, root))]


def test_ngram_join(docs, texts):
    want = groups(texts)
    assert sorted(map(tuple, ngram_join.similar_groups(docs).collect())) == sorted(want + [want[12]])


def test_ngram_join_without_rows(docs):
    assert ngram_join.similar_groups(docs.limit(0)).count() == 0


def test_ngram_join_on_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    got = sorted(map(tuple, QUERIES["op6_ngram_join"](spark, SF_DIR).collect()))
    assert got == [(rows[k].doc_id, n, rows[r].doc_id) for k, n, r in groups([r.text for r in rows])]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 102), (101, 102)], "a long, b long")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def test_suffix_dedup_on_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    data, gone = repeated([r.text for r in rows], 400)
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in QUERIES["op1_suffix_dedup"](spark, SF_DIR).collect()}
    assert got == {r.doc_id: (len(t), int(g.sum())) for r, t, g in zip(rows, data, gone)}


def brute(vectors, k):
    out = []
    for q, v in vectors:
        if q % 100 == 0:
            far = sorted((float(np.sqrt(((np.float64(v) - np.float64(w)) ** 2).sum())), i) for i, w in vectors if i != q)
            out += [(q, n + 1, i, d) for n, (d, i) in enumerate(far[:k])]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    good = [(int(i), [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(330)]
    good += [(1000 + i, good[0][1]) for i in range(20)] + [(500, good[7][1])]
    odd = [(600, None), (601, [0.0] * 6), (700, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (701, [float("nan")] * 6), (702, [float("inf")] * 6), (800, [1.0]), (None, good[3][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in good + odd] + [(*good[5], "y")], "vec_id long, embedding array<float>, rank string")
    got = sorted(map(tuple, neighbours.nearest(df, lambda i: i % 100 == 0).collect()))
    want = sorted(brute(good, 10))
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-12)
    assert neighbours.nearest(df.limit(0), lambda i: i % 100 == 0).count() == 0
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2)"), lambda i: i % 100 == 0)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2]


def test_recall_with_a_small_search(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(20, 16)) * 3
    vectors = [(i, (centers[i % 20] + rng.normal(size=16)).tolist()) for i in range(6000)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(df, lambda i: i % 100 == 0, search=2500).collect()}
    want = {(q, i) for q, _, i, _ in brute(vectors, 10)}
    assert len(got & want) >= 0.9 * len(want)


def test_search_grows_with_the_table(spark, tmp_path):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(150_000, 64)).astype(np.float32)
    column = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, 64, dtype=np.int32), vectors.reshape(-1))
    pq.write_table(pa.table({"vec_id": np.arange(len(vectors)), "embedding": column}), tmp_path / "vectors.parquet", row_group_size=20_000)
    found = neighbours.nearest(spark.read.parquet(str(tmp_path)), lambda i: i % 10_000 == 0).collect()
    want = set()
    for q in range(0, len(vectors), 10_000):
        far = ((vectors.astype(float) - vectors[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        want |= {(q, int(i)) for i in np.argsort(far)[:10]}
    assert len(found) == len(want) and len({(r.query_id, r.vec_id) for r in found} & want) >= 0.9 * len(want)


def test_needed_entries_in_columns(spark):
    pairs = [(n, m) for n in [*range(1, 60), 99, 100, 101, 5000] for m in [*range(1, 60), 80, 100, 4000, 4001]]
    got = spark.createDataFrame(pairs, "n long, m long").select("n", "m", ngram_join.needed_column("n", "m").alias("needed")).collect()
    assert all(r.needed == ngram_join.needed_shared(r.n, r.m) for r in got)


def test_bit_tables_never_show_more_differences_than_there_are(spark):
    draw = np.random.default_rng(5)
    rows = []
    for size in (0, 1, 40, 3000):
        common = draw.integers(-1 << 62, 1 << 62, size)
        rows.append((*(np.concatenate([common, draw.integers(-1 << 62, 1 << 62, size // 3)]).tolist() for _ in range(2)), 2 * (size // 3)))
    table = spark.createDataFrame(rows, "x array<long>, y array<long>, differ int")
    bits = [F.bit_count(ngram_join.parity("x", k).bitwiseXOR(ngram_join.parity("y", k))) for k in range(ngram_join.BIT_LONGS)]
    got = table.select("differ", sum(bits[1:], bits[0]).alias("seen")).collect()
    assert all(r.seen <= r.differ for r in got) and got[2].seen >= got[2].differ / 2  # two entries may fall on one bit
