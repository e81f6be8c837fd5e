"""Mixing, chats, fingerprints, packing, quality, token counts and language against brute force, round trips and held-out rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidecast.llm import chat, fingerprint, language_id, mixing, packing, quality, token_counts
from tidecast.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, PROBE, QUERIES, WORD_VOCABULARY

SF_DIR = "/root/testdata/sf0.01"
ODD = [None, "", " \n\t", "123 .", "Ünïted. nations, isn't <|endoftext|> ok", "a" * 5000, "same text here.", "same text here.", "ΑΣ ΣΑΣ. İx"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    long = " ".join("".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) + rng.choice(["", "", ".", ","]) for _ in range(9000))
    rows = [(k, t, "b" if k % 2 else None, "x", 1) for k, t in enumerate(ODD + [long])] + [(None, "no key", "a", None, 2)]
    return spark.createDataFrame(rows + [rows[4]], "doc_id long, text string, source string, lang string, score int").repartition(2)


def test_targets():
    assert mixing.targets([("a", 100), ("b", 100), ("c", 800)]) == pytest.approx([300, 300, 400])
    assert mixing.targets([("a", 10), (None, 0)]) == pytest.approx([10, 0]) and mixing.targets([]) == []


def test_meet_keeps_words():
    rng = random.Random(1)
    for _ in range(500):
        x, y, s, t = rng.random(), rng.random(), rng.randint(1, 50), rng.randint(1, 50)
        a, b = mixing.meet(x, s, y, t, rng.random())
        assert a * s + b * t == pytest.approx(x * s + y * t, abs=1e-6) and (a in (0, 1) or b in (0, 1)) and 0 <= min(a, b) <= max(a, b) <= 1


def test_mixture(spark):
    rows = QUERIES["op2_mix_sources"](spark, SF_DIR).collect()
    again = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(7)
    assert Counter((r.doc_id, r.taken) for r in rows) == Counter((r.key, r.copies * r.size) for r in mixing.copies(again).collect())
    for name in {r.source for r in rows}:
        own = [r for r in rows if r.source == name]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.03 * own[0].target
        assert sum(r.size for r in own) == own[0].source_size and all(r.taken <= 3 * r.size for r in own)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(r.size for r in rows))


def test_mixture_of_odd_rows(docs):
    counts = {}
    for r in mixing.copies(docs).collect():
        counts.setdefault(r.key, []).append(r)
    assert len(counts[4]) == 2 and counts[0][0].size == 0 and counts[5][0].size == 1
    out = mixing.mix(docs)
    want = Counter()
    for rows in counts.values():
        for r in rows:
            want[r.key] += r.copies
    assert out.columns == docs.columns and Counter(r.doc_id for r in out.collect()) == Counter({k: n for k, n in want.items() if n})
    assert mixing.copies(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_chats(spark):
    rng = random.Random(4)
    first = [(0, "system", "be <kind> \\"), (1, "user", "hi </turn>\n<turn>assistant\n\\n")]
    turns = {k: first[:rng.randint(0, 2)] + [(2 + j, rng.choice(["user", "assistant", "rôle\nx"]), rng.choice(["", "yes\\", "<", "é" * 9])) for j in range(rng.randint(1, 4))]
             for k in range(40)}
    turns[-7] = [r[1:] for r in PROBE]
    turns[99] = [(0, None, None), (0, "assistant", "x"), (0, "assistant", "x")]
    rows = [(k, *t, "extra") for k, own in turns.items() for t in own]
    path = public_tokenizers.path(BYTE_VOCABULARY)
    packs = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, ids string").repartition(3), path)
    got = {r.conv_id: r for r in chat.read_back(packs, path).collect()}
    assert set(got) == set(turns)
    for k, own in turns.items():
        own = [(r or "", t or "") for _, r, t in own]
        assert [(t.role, t.text) for t in got[k].turns] == own
        assert "".join(got[k].learned) == "".join(t for r, t in own if r == "assistant")
    for p in packs.collect():
        ends = p.starts[1:] + [len(p.ids)]
        for node, (a, b) in enumerate(zip(p.starts, ends)):
            above = [(p.starts[x], ends[x]) for x in iter_parents(p.parents, node)]
            assert list(zip(p.attends[node][::2], p.attends[node][1::2])) == above
            depth = sum(y - x for x, y in above)
            assert p.positions[a:b] == list(range(depth, depth + b - a))
    nodes = sum(len(p.starts) for p in packs.collect())
    assert nodes < len(rows)  # shared turns are there once
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], "conv_id long, turn int, role string, text string"), path), path).count() == 0


def iter_parents(parents, node):
    out = []
    while parents[node] >= 0:
        node = parents[node]
        out.append(node)
    return out[::-1]


def test_chat_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect() + PROBE
    own = {}
    for conv, turn, role, text in rows:
        own.setdefault(conv, []).append((turn, role or "", text or ""))
    want = set()
    for conv, turns in own.items():
        turns.sort()
        said, learned = "".join(f"{r}\n{t}\n" for _, r, t in turns), "".join(t for _, r, t in turns if r == "assistant")
        want.add((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    assert {tuple(r)[:5] for r in QUERIES["op4_chat_format"](spark, SF_DIR).collect()} == want


def phrases(text):
    seen, begin = set(), 0
    for end in range(1, len(text) + 1):
        if text[begin:end] not in seen:
            seen.add(text[begin:end])
            begin = end
    return seen


def test_fingerprints(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    keys, off = sorted(texts, reverse=True), []
    got = {r.doc_id: r for r in QUERIES["op5_phrase_fingerprints"](spark, SF_DIR).collect()}
    assert set(got) == set(texts)
    for k, after in zip(keys, keys[1:] + keys[:1]):
        text, half = texts[k], len(texts[k]) // 2
        edited = text[:len(text) - half] + texts[after][:half]
        assert got[k].n_chars == len(text) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[k].near_next == np.mean([got[k].fingerprint[i:i + 4] == got[after].fingerprint[i:i + 4] for i in range(0, 512, 4)])
        if k % 20 == 0:
            a, b = phrases(text), phrases(edited)
            off.append(got[k].near_edited - len(a & b) / max(1, len(a | b)))
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.08
    same = {}
    for k, t in texts.items():
        same.setdefault(t, set()).add(got[k].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_fingerprints_of_odd_rows(docs):
    rows = fingerprint.fingerprints(docs).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() and by[0].fingerprint == by[1].fingerprint == "0" * 512 and by[6].fingerprint == by[7].fingerprint
    assert fingerprint.fingerprints(docs.limit(0)).count() == 0
    alone = fingerprint.fingerprints(docs.where("doc_id = 6")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


@pytest.mark.parametrize("size, run", [(4096, 1 << 20), (512, 600)])
def test_packing(docs, size, run):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path(WORD_VOCABULARY)).encode
    rows = packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY), size=size, run=run).collect()
    whole = {r.doc_id: encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    seen, sequences = Counter(), {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == whole[r.doc_id][r.start:r.start + r.length] and len(ids) == r.length > 0 and r.doc_tokens == len(whole[r.doc_id])
        seen[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert seen == Counter({k: len(v) * (2 if k == 4 else 1) for k, v in whole.items()})
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist() and sum(n for _, n in pieces) <= size
    assert packing.pack(docs.limit(0), public_tokenizers.path(WORD_VOCABULARY)).count() == 0


def test_best_cuts_are_best():
    rng = random.Random(3)
    for _ in range(60):
        at = np.cumsum([0] + [rng.randint(1, 9) for _ in range(rng.randint(1, 14))]).tolist()
        cost = [0.0] + [rng.choice([0.0, 2.0, 7.0]) for _ in at[1:]]
        size = 16
        def price(i, j):
            n = at[j] - at[i]
            return (0 if n in (16, 8, 4) else size - n) + cost[j]
        best = [0.0] + [float("inf")] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(best[i] + price(i, j) for i in range(j) if at[j] - at[i] <= size)
        chosen = [0] + packing.best_cuts(at, cost, size)
        assert sum(price(i, j) for i, j in zip(chosen, chosen[1:])) == pytest.approx(best[-1])


def test_quality(spark, docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op8_quality_scores"](spark, SF_DIR).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.held_out == (r in held) for r in rows[:50]) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    good, bad = ([r.predicted == labels[r.doc_id] for r in held if labels.get(r.doc_id) == k] for k in (1, 0))
    assert np.mean(good) > 0.9 and np.mean(bad) > 0.8
    none = quality.score(docs, None).collect()
    assert {r.score for r in none} == {0.5} and len(none) == docs.count()
    model = {"good": b"a" * 999, "bad": b"", "slope": 9.0, "offset": 1.0}
    odd = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert odd[0] == odd[1] == pytest.approx(1 / (1 + np.exp(-1))) and odd[6] == odd[7]
    assert quality.fit(docs.limit(0), docs.limit(0), label="score") is None


def test_quality_of_long_texts_that_differ_late(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]
    same = " ".join(words[:1200])[:8192]
    late = {1: words[1200:2100], 0: words[2100:]}
    rows = [(k, k % 2, same + " ".join(rng.choices(late[k % 2], k=1500))) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, quality int, text string")
    model = quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "quality"), label="quality")
    fresh = spark.createDataFrame([(k, " ".join(rng.choices(late[k % 2], k=300))) for k in range(20)], "doc_id long, text string")
    assert all(r.predicted == r.doc_id % 2 for r in quality.score(fresh, model).collect())
    assert len(quality.pieces(b"x" * 10**6, -1)) == 8192 and quality.pieces(b"short", 3) == b"short"


def test_token_counts(docs):
    path = public_tokenizers.path(PIECE_VOCABULARY)
    pieces = token_counts.unigram(path)

    def best(word):
        score, count = [0.0], [0]
        for end in range(1, len(word) + 1):
            own = len(word[end - 1].encode())
            options = [(score[end - 1] + own * token_counts.BYTE_SCORE, -count[end - 1] - own)]
            options += [(score[b] + pieces[word[b:end]], -count[b] - 1) for b in range(end) if word[b:end] in pieces]
            s, c = max(options)
            score.append(s)
            count.append(-c)
        return count[-1]

    short = docs.where("doc_id != 5 or doc_id is null").where("doc_id != 9 or doc_id is null")
    for r in token_counts.token_counts(short, path).collect():
        own = token_counts.WORDS.findall(r.text or "")
        assert (r.n_words, r.n_tokens) == (len(own), sum(best("▁" + w) for w in own))
    assert token_counts.token_counts(docs.limit(0), path).count() == 0


def test_language(spark, docs):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op10_language_id"](spark, SF_DIR).collect()
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out and langs[r.doc_id]]
    assert np.mean(held) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    assert [odd[k].lang_pred for k in (0, 1, 2, 3)] == ["und"] * 4 and odd[6].lang_pred == "x" and odd[0].score == 0
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit(docs.limit(0))).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), None).count() == 0


def test_word_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_VOCABULARY)
    texts = ["", " ", "don't I'll we've 's", "Straße, ÉCOLE!! İstanbul ΣΑΣ ﬁn ǅ ª º x² 12ab a1, it's... Z zZ ZZZ", "éa é",
             "á!! <|endoftext|>x <|startoftext|> a<| b|>", "\x00Z\x00 a\tb c　d e" + "!" * 5000 + " ab" + "?" * 3000, "日本語 русский µ ſ ŉ Ĳ Ⱥ",
             "aaaa" * 5000, "Z" * 100, "word, word. WORD$$$ wörd%%%"]
    found = packing.WordIds(path)(texts)
    assert [f.tolist() for f in found] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_languages_of_repeated_rows(spark):
    """However often a row repeats, its language is learned, and the sample stays bounded."""
    words = {"en": "the house and the garden of this town", "fr": "la maison et le jardin de cette ville", "de": "ein Wort"}
    rows = [(1, words["en"], "en")] * 4000 + [(2, words["fr"], "fr")] * 4000 + [(3, words["de"], "de")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8))
    assert model["names"] == ["de", "en", "fr"]
    asked = spark.createDataFrame([(k, t) for k, t in words.items()], "want string, text string")
    assert all(r.want == r.lang_pred for r in language_id.identify(asked, model).collect())


def test_word_ids_of_stretches():
    path = public_tokenizers.path(WORD_VOCABULARY)
    ids, text = packing.WordIds(path), " two  blanks, a\nline <|endoftext|> İx and " * 40 + "z" * 300 + " end "
    for most in (1, 7, 100, 5000):
        parts = list(packing.stretches(text, most))
        assert " ".join(parts) == text and (most > len(text)) == (len(parts) == 1)
        assert np.array_equal(np.concatenate([ids([p])[0] for p in parts]), ids.encode(text))
    assert list(packing.stretches("", 3)) == [""]


def test_texts_in_groups():
    texts = [None, "abc", "", "x" * 50, "de", "f" * 9, "g"]
    for most in (1, 10, 1000):
        groups = list(packing.in_groups(pa.array(texts), most))
        assert [t for _, group in groups for t in group] == [t or "" for t in texts]
        assert [first for first, _ in groups] == np.cumsum([0, *[len(group) for _, group in groups]])[:-1].tolist()
        assert all(len(group) == 1 or sum(map(len, group)) <= most for _, group in groups)
