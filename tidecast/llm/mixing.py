"""Mixing sources to target weights by pivotal dependent rounding.

A source's target divided by its size is the number of copies each of its documents should get on average.  The whole part
is given to all; the fraction is rounded so that words stay in place: two documents meet, words move from one to the
other, in a random direction that keeps both expectations, until one of them is taken wholly or not at all.  The other meets
the next document.  Documents meet within small buckets first and what is left of each bucket meets in ever fewer
buckets, so the reduction is a tree and a hot source is spread over many tasks.  Documents only meet others of about their own length,
so at the root one document of each length class is left; these few are settled together, as near to the source's target as
they allow.

Every draw is a hash of the two documents, so reruns agree whatever the partitions are.

Defined cases: a NULL or empty text has size 0 and takes nothing.  NULL is a source of its own and comes last.  A source
without words has target 0.  Rows that are repeated are rounded each for themselves.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tidecast.llm.common import WORD_PATTERN, saved, text_of
from tidecast.llm.tables import looked_up

WEIGHTS, CAP = (5, 2, 1), 3
#: Rows that meet in a bucket of the lowest level, and buckets that one of the next level takes in.
BUCKET_ROWS, FAN_IN = 2048, 32
SNAP = 1e-9
TOGETHER = 16


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> list[float]:
    """Targets of sources given in their order: shares of all words by weight, none above ``cap`` times its size."""
    total, out = float(sum(s for _, s in sizes)), [0.0] * len(sizes)
    open_ = {i: weights[i % len(weights)] for i in range(len(sizes))}
    left = total
    while open_:
        scale = left / sum(open_.values())
        full = [i for i, w in open_.items() if w * scale > cap * sizes[i][1]]
        if not full:
            for i, w in open_.items():
                out[i] = w * scale
            break
        for i in full:
            out[i] = float(cap * sizes[i][1])
            left -= out[i]
            del open_[i]
    return out


def draw(a: int, b: int) -> float:
    """A number in [0, 1) that only depends on the two documents."""
    x = (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) & 0xFFFFFFFFFFFFFFFF
    return ((x ^ (x >> 31)) >> 11) / 2.0**53


def meet(x: float, s: int, y: float, t: int, u: float) -> tuple[float, float]:
    """Two fractions of documents with ``s`` and ``t`` words after words moved between them; one is then 0 or 1."""
    to_x, to_y = min((1 - x) * s, y * t), min(x * s, (1 - y) * t)
    if u * (to_x + to_y) < to_y:
        x, y = x + to_x / s, y - to_x / t
    else:
        x, y = x - to_y / s, y + to_y / t
    return tuple(0.0 if v < SNAP else 1.0 if v > 1 - SNAP else v for v in (x, y))


def reduce_buckets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by group: all but at most one of each group leave with ``part`` 0 or 1."""
    key = kept = None
    for frame in frames:
        part, lone = frame["part"].to_numpy(copy=True), []
        keys = list(zip(frame["bucket"], frame["place"], frame["band"]))
        sizes, draws = frame["size"].tolist(), frame["draw"].tolist()
        out = []
        for i, here in enumerate(keys):
            if here != key:
                if kept is not None:
                    out.append(kept)
                key, kept = here, None
            if part[i] in (0.0, 1.0):
                continue
            row = frame.iloc[i].to_dict() if kept is None else None
            if kept is None:
                kept, lone = row, [*lone, i]
                continue
            held, part[i] = meet(kept["part"], kept["size"], part[i], sizes[i], draw(kept["draw"], draws[i]))
            kept["part"] = held
            if held in (0.0, 1.0):
                out.append(kept)
                kept = None
                if part[i] not in (0.0, 1.0):
                    kept, lone = {**frame.iloc[i].to_dict(), "part": part[i]}, [*lone, i]
        frame = frame.assign(part=part).drop(frame.index[lone])
        if out:
            frame = pd.concat([frame, pd.DataFrame(out)[frame.columns].astype(frame.dtypes.to_dict())])
        if len(frame):
            yield frame
    if kept is not None:
        yield pd.DataFrame([kept])[frame.columns].astype(frame.dtypes.to_dict())


def settle(rows: pd.DataFrame) -> pd.DataFrame:
    """The last documents of one source, at most one of each length class, settled together towards the source's target.

    The longest go towards what is missing, one by one; of the ``TOGETHER`` shortest the subset that comes nearest is taken.
    """
    rows = rows.sort_values(["band", "draw"], ascending=False)
    sizes, missing, parts = rows["size"].tolist(), 0.0, []
    alone = max(0, len(rows) - TOGETHER)
    for part, size in zip(rows["part"][:alone], sizes[:alone]):
        wanted = part * size + missing
        parts.append(1.0 if wanted >= size / 2 else 0.0)
        missing = wanted - parts[-1] * size
    wanted = missing + float((rows["part"] * rows["size"])[alone:].sum())
    sums = np.zeros(1)
    for size in sizes[alone:]:
        sums = np.concatenate([sums, sums + size])
    best = int(np.abs(sums - wanted).argmin())
    return rows.assign(part=parts + [float(best >> i & 1) for i in range(len(rows) - alone)])


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
           weights: Sequence[float] = WEIGHTS, cap: float = CAP, carry: str | None = None) -> DataFrame:
    """A row per document: key, size, source and its size and target, copies, and ``nth``, its number among rows that agree in key, source and size.

    ``carry``: a column that goes along.
    """
    along = [carry] if carry else []
    words = F.regexp_count(text_of(text), F.lit(WORD_PATTERN)).cast("long")
    rows = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), words.alias("size"), F.xxhash64(text_of(text)).alias("draw"), *along)
    rows = saved(rows, "mix-sizes")
    known = [(r.source, r.size, r.n) for r in rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()]
    known.sort(key=lambda r: (r[0] is None, r[0] or ""))
    goal = targets([(s, n) for s, n, _ in known], weights, cap)
    spark, schema = docs.sparkSession, "source string, place int, source_size long, target double, whole int, fraction double"
    plan = []
    for place, ((name, size, _), target) in enumerate(zip(known, goal)):
        ratio = min(target / size, cap) if size else 0.0
        whole = int(ratio + SNAP)
        plan.append((name, place, size, target, whole, max(0.0, ratio - whole) if ratio - whole > SNAP else 0.0))
    same = Window.partitionBy("key", "source", "size").orderBy("draw")
    buckets = max(1, -(-sum(n for *_, n in known) // BUCKET_ROWS))
    state = (rows.withColumn("nth", F.row_number().over(same))
             .join(spark.createDataFrame(plan, schema).withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
             .withColumns({"draw": F.xxhash64("key", "draw", "nth"), "band": F.when(F.col("size") > 0, F.floor(F.log2(F.greatest("size", F.lit(1))))).otherwise(-1).cast("int"),
                           "part": F.when(F.col("size") > 0, F.col("fraction")).otherwise(0.0)})
             .withColumn("bucket", F.pmod("draw", F.lit(buckets))))
    group, done = ["bucket", "place", "band"], []
    while True:
        state = saved(state.repartition(*group).sortWithinPartitions(*group, "draw").mapInPandas(reduce_buckets, state.schema), "mix-level")
        integral = F.col("part").isin(0.0, 1.0)
        done.append(state.where(integral))
        state = state.where(~integral)
        if buckets == 1:
            break
        buckets = -(-buckets // FAN_IN)
        state = state.withColumn("bucket", F.floor(F.col("bucket") / FAN_IN))
    done.append(state.groupBy("place").applyInPandas(settle, state.schema))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*along, "key", "nth", "source", "size", "source_size", "target", (F.col("whole") + F.col("part").cast("int")).alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    columns = docs.columns
    numbered = saved(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    taken = saved(copies(numbered, key, text, source, weights, cap, carry="__row").select("__row", F.col("copies").alias("__copies")), "mix-taken")
    rows = looked_up(numbered, taken, "__row", "__copies")
    return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))).select(*columns)
