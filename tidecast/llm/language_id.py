"""Language identification by hierarchical discrimination.

A text is described by the square roots of the shares of its hashed byte bigrams and trigrams.  Languages whose mean
descriptions are alike form a family.  One linear support vector machine per family (one against the rest) names the
family; inside a family, one machine per pair of languages votes.  Only the features of a bounded sample of labelled
rows reach the driver; the model has a fixed size per language and family.

Defined cases: a NULL text or one without a letter is ``und`` with score 0.  Without any labelled row every text is ``und``.
With one learned language every text with a letter gets it.  Texts that differ only in case, or repeat, are described alike.
Ties between languages go to the smaller name.  Very long texts are read whole.  An input column named like an output
is replaced.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidecast.llm.common import byte_view, mix, slices, with_columns

#: Labelled rows of each language that training uses, about; hashed features; training steps and margin weight.
SAMPLE_PER_LANGUAGE = 400
FEATURES = 2048
STEPS, REGULAR = 200, 1e-4
UNKNOWN = "und"


def features(array: pa.Array, size: int = FEATURES) -> np.ndarray:
    """A unit vector per text; zero for texts shorter than two bytes."""
    data, offsets = byte_view(array)
    out = np.zeros((len(offsets) - 1, size), dtype=np.float32)
    pair_slot = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(size)).astype(np.int32)
    for first, last in slices(offsets):
        base, at = offsets[first], offsets[first:last + 1] - offsets[first]
        part = data[base:offsets[last]]
        if len(part) < 2:
            continue
        part = part | (((part >= 65) & (part <= 90)).astype(np.uint8) << 5)
        row = np.repeat(np.arange(last - first, dtype=np.int32), np.diff(at))
        pairs = part[:-1].astype(np.int32) << 8 | part[1:]
        inside = row[1:] == row[:-1]
        slots = pair_slot[pairs]
        counts = np.bincount((row[1:] * size + slots)[inside], minlength=(last - first) * size)
        three = inside[1:] & inside[:-1]
        slots = (slots[:-1] * 31 + pair_slot[pairs[1:]] * 17 + part[2:]) % size
        counts = counts + np.bincount((row[2:] * size + slots)[three], minlength=(last - first) * size)
        out[first:last] = np.sqrt(counts.reshape(last - first, size))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def machine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and bias of a linear support vector machine (squared hinge, both classes weighed alike)."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w, ahead = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(STEPS):
        lack = np.maximum(0, 1 - y * (x @ ahead))
        grad = REGULAR * ahead - 2 * x.T @ (share * y * lack)
        new = ahead - 0.25 * grad
        ahead, w = new + step / (step + 3) * (new - w), new
    return w


def families(means: np.ndarray) -> list[list[int]]:
    """Languages joined, most alike first, until about the square root of their number is left."""
    groups = [[i] for i in range(len(means))]
    wanted = int(np.ceil(np.sqrt(len(means))))
    alike = means @ means.T
    while len(groups) > wanted:
        a, b = max(combinations(range(len(groups)), 2), key=lambda ab: np.mean(alike[np.ix_(groups[ab[0]], groups[ab[1]])]))
        groups[a] = sorted(groups[a] + groups.pop(b))
    return groups


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id",
        per_language: int = SAMPLE_PER_LANGUAGE) -> dict | None:
    """The model, from rows with a text and a language; ``order`` chooses the sample, it is no feature."""
    rows = labelled.select(F.xxhash64(order, text).alias("draw"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Two numbers a language: the driver holds the whole model of each anyway.
    known = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    if not known:
        return None
    steps = F.create_map(*[F.lit(v) for r in known for v in (r.lang, max(1, r.n // per_language))])
    least = F.create_map(*[F.lit(v) for r in known for v in (r.lang, r.least)])
    # One row in so many, and one at any rate; equal rows have equal draws and count once.
    sample = rows.where((F.pmod("draw", steps[F.col("lang")]) == 0) | (F.col("draw") == least[F.col("lang")])).dropDuplicates(["lang", "draw"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    sample = sample.withColumn("place", place).where(F.col("place") <= 3 * per_language).select("lang", "text")
    taken = with_columns(sample, "vector binary", lambda c: [pa.array([v.tobytes() for v in features(c[0])], pa.binary())],
                         ["text"]).select("lang", "vector").collect()
    if not taken:
        return None
    taken.sort(key=lambda r: (r.lang, bytes(r.vector)))
    names = sorted({r.lang for r in taken})
    x = np.frombuffer(b"".join(bytes(r.vector) for r in taken), np.float32).reshape(len(taken), -1)
    y = np.array([names.index(r.lang) for r in taken])
    means = np.stack([x[y == i].mean(0) for i in range(len(names))])
    means = means - means.mean(0)
    groups = families(means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-9))
    top = [machine(x, np.where(np.isin(y, g), 1, -1)) for g in groups] if len(groups) > 1 else []
    pairs = {(a, b): machine(x[m], np.where(y[m] == a, 1, -1))
             for g in groups for a, b in combinations(g, 2) for m in [(y == a) | (y == b)]}
    return {"names": names, "groups": groups, "top": top, "pairs": pairs}


def predict(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language of each row, and a confidence between 0 and 1."""
    def margins(w: np.ndarray) -> np.ndarray:
        return x @ w[:-1] + w[-1]

    def sure(m: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-4 * np.clip(m, -30, 30)))

    groups, n = model["groups"], len(x)
    by_family = np.stack([margins(w) for w in model["top"]], 1) if model["top"] else np.zeros((n, 1))
    family = by_family.argmax(1) if n else np.zeros(0, int)
    score = sure(by_family.max(1)) if model["top"] else np.ones(n)
    best = np.array([g[0] for g in groups])[family]
    for k, group in enumerate(groups):
        rows = np.flatnonzero(family == k)
        if len(group) == 1 or not len(rows):
            continue
        votes, least = np.zeros((len(rows), len(group))), np.ones((len(rows), len(group)))
        for i, j in combinations(range(len(group)), 2):
            m = margins(model["pairs"][group[i], group[j]])[rows]
            votes[:, i] += m >= 0
            votes[:, j] += m < 0
            least[:, i], least[:, j] = np.minimum(least[:, i], sure(m)), np.minimum(least[:, j], sure(-m))
        win = votes.argmax(1)
        best[rows] = np.array(group)[win]
        score[rows] *= least[np.arange(len(rows)), win]
    return best, score


def identify(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred string`` and ``score double``."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: FEATURES weights a machine

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        texts, known = columns[0], np.array(columns[1], dtype=bool)
        names, langs, scores = shared.value["names"], [], []
        for at in range(0, len(texts), 500):
            best, score = predict(shared.value, features(texts.slice(at, 500)))
            ok = known[at:at + 500]
            langs += [names[b] if k else UNKNOWN for b, k in zip(best, ok)]
            scores.append(np.where(ok, score, 0.0))
        return [pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]

    has_letter = "__has_letter"
    marked = docs.withColumn(has_letter, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    return with_columns(marked, "lang_pred string, score double", run, [text, has_letter], twice=False).drop(has_letter)
