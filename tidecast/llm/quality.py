"""Quality scores from compression.

Two zstandard dictionaries are built from bounded samples of good and of bad labelled texts: of a text up to 8 KB all bytes, of
a longer one eight pieces of 1 KB, one from each eighth of the text at a place a hash chooses.  A text is compressed with
either; by how much smaller the good dictionary makes it, relative to its compressed size, is its margin.  Texts are
compressed piece by piece, so that a dictionary matters throughout a long text.  A logistic curve fitted on other
labelled rows than those in the dictionaries turns the margin into a score between 0 and 1.

Defined cases: a NULL or empty text has margin 0 and the score the curve has there.  Repeated rows get equal scores.  Without labelled
rows of both kinds every score is 0.5.  Labels that are NULL are not learned from.  Very long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tidecast.llm.common import byte_view, mix, with_columns

#: Labelled texts of each kind in the sample, pieces of each text that may enter a dictionary and their bytes, and a dictionary's size.
SAMPLE, SAMPLE_PIECES, SAMPLE_BYTES, DICTIONARY = 1500, 8, 1024, 112_640
PIECE, LEVEL = 512, 3
STEPS = 500


def pieces(text: bytes, seed: int) -> bytes:
    """What of a text may enter a dictionary: all of it, or a piece from each of ``SAMPLE_PIECES`` equal stretches."""
    if len(text) <= SAMPLE_PIECES * SAMPLE_BYTES:
        return text
    ends = np.arange(SAMPLE_PIECES + 1, dtype=np.uint64) * np.uint64(len(text)) // np.uint64(SAMPLE_PIECES)
    at = ends[:-1] + mix(np.arange(SAMPLE_PIECES, dtype=np.uint64) + np.uint64(seed % 2**63)) % (np.diff(ends) - np.uint64(SAMPLE_BYTES - 1))
    return b"".join(text[i:i + SAMPLE_BYTES] for i in at.tolist())


def dictionary(texts: list[bytes]) -> bytes:
    """A dictionary of the pieces of texts; few or tiny texts are used as they are."""
    parts = [t[i:i + SAMPLE_BYTES] for t in texts for i in range(0, len(t), SAMPLE_BYTES)]
    try:
        return zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY:]


class Margins:
    def __init__(self, good: bytes, bad: bytes) -> None:
        self.of = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
                   if d else zstandard.ZstdCompressor(level=LEVEL) for d in (good, bad)]

    def __call__(self, text: bytes | memoryview) -> float:
        if not len(text):
            return 0.0
        small, large = ([len(c.compress(text[i:i + PIECE])) for i in range(0, len(text), PIECE)] for c in self.of)
        return (sum(large) - sum(small)) / (sum(large) + sum(small))


def margins(array: pa.Array, of: Margins) -> np.ndarray:
    data, offsets = byte_view(array)
    view = memoryview(data)
    return np.array([of(view[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], dtype=np.float64)


def curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve; both classes weigh alike, so 0.5 is the even point."""
    scale = float(np.std(x)) or 1.0
    z, a, b = x / scale, 1.0, 0.0
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, w = share * (p - y), share * p * (1 - p)
        hess = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, [(g * z).sum() + 1e-6 * a, g.sum()])
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return a / scale, b


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label",
        sample: int = SAMPLE) -> dict | None:
    """The model, from the texts of rows labelled 1 (good) or 0 (bad); ``key`` joins the two and chooses the sample, it is no feature.

    The sample is chosen among the labels, before any text is read, and has at most ``4 * sample`` rows.
    """
    rows = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    # Rows with an even hash build dictionaries, the others fit the curve.
    pick = F.xxhash64(F.col("key"), F.lit("quality"))
    step = F.when(F.col("label") == 1, max(1, counts[1] // (2 * sample))).otherwise(max(1, counts[0] // (2 * sample)))
    chosen = rows.where(F.pmod(pick, step) == 0).withColumn("half", F.pmod(F.xxhash64(pick), F.lit(2)))
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("key")).limit(4 * sample))  # bounded by the parameter
    taken = (docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") > 0).join(chosen, "key")
             .select("label", "half", "text", F.col("key").alias("order")))
    built = with_columns(taken.where("half = 0").select("label", "order", "text", F.xxhash64("order", F.lit("pieces")).alias("seed")), "bytes binary",
                         lambda c: [pa.array([pieces(t.encode(), s) for t, s in zip(c[0].to_pylist(), c[1].to_pylist())], pa.binary())],
                         ["text", "seed"]).select("label", "order", "bytes").collect()
    built.sort(key=lambda r: (r.order is None, r.order, bytes(r.bytes)))
    good, bad = (dictionary([bytes(r.bytes) for r in built if r.label == k]) for k in (1, 0))
    measured = with_columns(taken.where("half = 1").select("label", "text"), "margin double",
                            lambda c: [pa.array(margins(c[0], Margins(good, bad)))], ["text"]).select("label", "margin").collect()
    if len({r.label for r in measured}) < 2:
        return {"good": good, "bad": bad, "slope": 100.0, "offset": 0.0}
    slope, offset = curve(np.array([r.margin for r in measured]), np.array([r.label for r in measured]))
    return {"good": good, "bad": bad, "slope": slope, "offset": offset}


def score(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score double`` and ``predicted int``."""
    if model is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a fixed size
    held: list[Margins] = []

    def run(columns: list[pa.Array]) -> list[pa.Array]:
        m = shared.value
        if not held:
            held.append(Margins(m["good"], m["bad"]))
        x = margins(columns[0], held[0])
        p = 1 / (1 + np.exp(-np.clip(m["slope"] * x + m["offset"], -30, 30)))
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    return with_columns(docs, "score double, predicted int", run, [text])
