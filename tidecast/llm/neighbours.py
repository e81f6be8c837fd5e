"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree halves a bounded sample again and again: a direction between two random sample vectors, cut at the median.  All vectors are
sent down all trees, so every row is indexed.  A query enters all trees at once: one priority queue holds the branches not
taken in any tree, nearest cut first, and leaves are opened until they hold ``SHARE`` of all places (a vector has one in each tree), and
``SEARCH`` at least.  The search so grows with the table, as does the number of vectors about as near as the tenth.  Trees need not deepen
with it: the share is met in many leaves of each tree at the greatest depth already.  The vectors of an opened leaf meet the queries that
opened it in one task, where exact distances rank them; each leaf gives its best and the best of all are kept.

Equal vectors are one entry that carries the smallest ids of its group, as many as can be reported; a leaf that is still large is
cut into slices.

Defined cases: vectors that are NULL, zero, or hold a NULL or non-finite component take no part, nor do rows without an id or
with another number of components than most.  Equal distances go to the smaller id.  Repeated rows (id and vector) count once.  With
fewer candidates than asked for, all are returned.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidecast.llm.common import saved

#: Vectors the forest is fitted on, trees, rows aimed at per leaf, rows of a leaf that one task takes.
SAMPLE, TREES, LEAF, BLOCK = 20_000, 8, 200, 4096
#: Share of all places that a query opens, and places it opens at least.
SHARE, SEARCH = 0.08, 32_000
SALT_ROWS = 1 << 16
#: Random directions of which a node takes the one along which its sample spreads widest.
DIRECTIONS = 16


class Forest:
    """Complete binary trees: ``cuts[tree, node]`` and ``levels[tree, node]``, children of ``k`` at ``2k + 1`` and ``2k + 2``."""

    def __init__(self, sample: np.ndarray, rows: int, seed: int = 7, trees: int = TREES) -> None:
        rng = np.random.default_rng(seed)
        self.depth = max(0, min(int(np.ceil(np.log2(max(1, rows / LEAF)))), int(np.log2(max(1, len(sample) / 8)))))
        inner, dim = 2 ** self.depth - 1, sample.shape[1]
        self.cuts, self.levels = np.zeros((trees, inner, dim)), np.zeros((trees, inner))
        for t in range(trees):
            parts = [np.arange(len(sample))]
            for node in range(inner):
                own = parts[node]
                some = sample[rng.choice(own if len(own) > 1 else len(sample), (2, DIRECTIONS))]
                ways = some[0] - some[1] + 1e-9 * rng.normal(size=(DIRECTIONS, dim))
                ways /= np.linalg.norm(ways, axis=1, keepdims=True)
                along = sample[own] @ ways.T
                widest = int(along.var(axis=0).argmax()) if len(own) else 0
                way, along = ways[widest], along[:, widest]
                level = float(np.median(along)) if len(own) else 0.0
                self.cuts[t, node], self.levels[t, node] = way, level
                parts += [own[along < level], own[along >= level]]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree."""
        out = np.zeros((len(self.cuts), len(x)), np.int64)
        for t in range(len(self.cuts)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                right = np.einsum("ij,ij->i", x, self.cuts[t][node]) >= self.levels[t][node]
                node = 2 * node + 1 + right
            out[t] = node - (2 ** self.depth - 1)
        return out

    def open(self, q: np.ndarray, counts: np.ndarray, search: int) -> list[tuple[int, int]]:
        """Leaves to open for one vector, from all trees by one queue."""
        margins = np.einsum("tnd,d->tn", self.cuts, q) - self.levels
        inner, queue, out, held = 2 ** self.depth - 1, [(0.0, t, 0) for t in range(len(self.cuts))], [], 0
        while queue and held < search:
            far, t, node = heapq.heappop(queue)
            while node < inner:
                m = float(margins[t, node])
                heapq.heappush(queue, (far + m * m, t, 2 * node + 1 + (m < 0)))
                node = 2 * node + 1 + (m >= 0)
            if counts[t, node - inner]:
                out.append((t, node - inner))
                held += int(counts[t, node - inner])
        return out


def places_to_open(entries: int) -> int:
    """Places a query opens in a forest of so many different vectors."""
    return max(SEARCH, int(np.ceil(SHARE * entries * TREES)))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vec`` of the rows that take part."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec")).where("id is not null and vec is not null")
    rows = rows.where(F.forall("vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("vec", lambda v: v != 0))
    usual = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    return rows.where(F.size("vec") == (usual[0].dim if usual else 0))


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10, search: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean distance): the ``k`` nearest found of each row for which ``is_query(id)`` holds.

    ``search`` replaces the number of places a query opens.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector).withColumn("rep", F.xxhash64("vec"))
    salts = max(1, rows.count() // SALT_ROWS)
    smallest = lambda ids: F.slice(F.array_sort(F.array_distinct(ids)), 1, k + 1)
    entries = (rows.groupBy("rep", "vec", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
               .agg(smallest(F.collect_list("id")).alias("ids"), F.max(is_query(F.col("id"))).alias("asks"))
               .groupBy("rep", "vec").agg(smallest(F.flatten(F.collect_list("ids"))).alias("ids"), F.max("asks").alias("asks")))
    entries = saved(entries, "vectors")
    n = entries.count()
    search = places_to_open(n) if search is None else search
    sample = entries.orderBy(F.xxhash64("rep")).limit(SAMPLE).select("vec").toPandas()["vec"]
    forest = Forest(np.stack([np.asarray(v, np.float64) for v in sample]) if len(sample) else np.zeros((0, 1)), n)
    shared = spark.sparkContext.broadcast(forest)  # a fixed number of trees of at most SAMPLE / 8 leaves

    def index(batches):
        for batch in batches:
            if len(batch):
                leaves = shared.value.leaves(matrix(batch.column(1)))
                for t, own in enumerate(leaves):
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(own), t, np.int64)), pa.array(own)], names=["rep", "tree", "leaf"])

    places = saved(entries.select("rep", "vec").mapInArrow(index, "rep long, tree long, leaf long"), "vector-leaves")
    counts = np.zeros((TREES, 2 ** forest.depth), np.int64)
    for r in places.groupBy("tree", "leaf").count().collect():  # one number a leaf
        counts[r.tree, r.leaf] = r["count"]
    sizes = spark.sparkContext.broadcast(counts)

    def ask(batches):
        for batch in batches:
            out = [(r, t, leaf, s) for r, q in zip(batch.column(0).to_pylist(), matrix(batch.column(1)) if len(batch) else [])
                   for t, leaf in shared.value.open(q, sizes.value, search) for s in range(-(-int(sizes.value[t, leaf]) // BLOCK))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["query", "tree", "leaf", "slice"])

    asked = entries.where("asks").select("rep", "vec")
    probes = (asked.mapInArrow(ask, "query long, tree long, leaf long, slice long")
              .join(asked.select(F.col("rep").alias("query"), F.col("vec").alias("query_vec")), "query"))
    slices = F.create_map(*[F.lit(x) for t, leaf in np.argwhere(counts > BLOCK) for x in (int(t) << 32 | int(leaf), -(-int(counts[t, leaf]) // BLOCK))]) \
        if (counts > BLOCK).any() else None
    slice_of = F.lit(0) if slices is None else F.pmod(F.col("rep"), F.coalesce(slices[F.shiftleft("tree", 32).bitwiseOR(F.col("leaf"))], F.lit(1)))
    stored = places.withColumn("slice", slice_of.cast("long")).join(entries.select("rep", "vec", "ids"), "rep")

    def rank(queries: pd.DataFrame, leaf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(leaf):
            x, reps, ids = np.stack(leaf["vec"]).astype(np.float64), leaf["rep"].to_numpy(), leaf["ids"].tolist()
            least = np.array([i[0] for i in ids])
            for query, q in zip(queries["query"], queries["query_vec"]):
                far = np.sqrt(((x - np.asarray(q, np.float64)) ** 2).sum(axis=1))
                best = np.argpartition(far, k)[:k + 1] if len(far) > k + 1 else np.arange(len(far))
                best = np.flatnonzero(far <= far[best].max())
                best = best[np.lexsort((least[best], far[best]))][:k + 1]
                out += [(query, reps[b], far[b], ids[b]) for b in best]
        return pd.DataFrame(out, columns=["query", "rep", "score", "ids"])

    place = ["tree", "leaf", "slice"]
    found = (probes.groupBy(*place).cogroup(stored.groupBy(*place)).applyInPandas(rank, "query long, rep long, score double, ids array<long>")
             .dropDuplicates(["query", "rep"]))
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", F.col("ids")[0]))).where(F.col("place") <= k + 1)
    queries = rows.where(is_query(F.col("id"))).select(F.col("id").alias("query_id"), F.col("rep").alias("query")).distinct()
    each = queries.join(best, "query").select("query", "query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    order = Window.partitionBy("query", "query_id").orderBy("score", "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
