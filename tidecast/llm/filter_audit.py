"""How quality filters interact: what each removes in every order in which they can be applied.

A document is described by the set of filters it fails, its mask.  In an order of the filters it is removed at the first step whose letter is
in the mask.  Orders are ranked as in a dictionary (their Lehmer rank), so all orders that begin with the same letters lie beside each
other: the orders in which a mask is removed at a given step are a few intervals of ranks.  Documents are counted per part and mask first, which is the only
work that grows with them.  Each count is then added at the first rank of its mask's intervals and taken off behind the last one, and a running
sum over the ranks gives what is removed at that step in each order.

Defined cases: a NULL text is empty, and an empty text fails ``A`` alone (and ``E``, if a smaller key has one too).  A NULL part is
the empty string.  A row without a key is compared with no other, so it never fails ``E``, and has no label; rows of one key do not fail it for each other.  Every row
counts, repeated or not.  Labels of one key are put together: one that says 1 is enough.  An empty table has no parts and gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidecast.llm.common import saved, text_of

LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10  # words; percent of words; percent of characters
GAPS, SYMBOLS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"
COUNTS = ("n", "good", "toxic")


def own_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text only.  ``words`` is split once; gaps at either end leave an empty word, which is taken out."""
    words = F.col("words")
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > MOST_CAPITALS * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``key, part, mask`` of each row; bit k of the mask is letter k.

    A text is read once.  Equal texts are found by their hash and length; only groups of several keys are joined back, in rows
    without texts, so a text that a third of the rows share is a skewed join of narrow rows, which adaptive execution splits.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_of(text).alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", GAPS), ""))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(own_failures(F.col("text")).values())), F.lit(0))
    rows = saved(rows.select("key", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("same"), F.length("text").alias("length")), "masks")
    first = rows.groupBy("same", "length").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").drop("last")
    first = saved(first, "repeated")  # an aggregate below it would keep the join from being split
    later = F.when(F.col("first") < F.col("key"), 1 << LETTERS.index("E")).otherwise(0)
    return rows.join(first, ["same", "length"], "left").select("key", "part", (F.col("mask") + later).alias("mask"))


def labelled_counts(masks: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: rows, and those whose label says good or toxic."""
    marks = labels.groupBy(F.col(key).alias("key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.where("good = 1 OR toxic = 1")
    counted = [F.count(F.lit(1)).alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic"))]
    return masks.join(marks, "key", "left").groupBy("part", "mask").agg(*counted)


def interval_ends(letters: str = LETTERS) -> list[tuple[int, int, int, int]]:
    """``mask, step, rank, sign`` at which the intervals of each mask begin (1) and behind which they end (-1).

    The orders that begin with the i-th prefix of a length have the ranks from i * (the orders of the rest).  Intervals that touch are one.
    """
    rows, n = [], len(letters)
    for mask in range(1, 1 << n):
        for step in range(1, n + 1):
            width, ends = factorial(n - step), {}
            for i, prefix in enumerate(permutations(range(n), step)):
                if mask >> prefix[-1] & 1 and not any(mask >> k & 1 for k in prefix[:-1]):
                    for rank, sign in ((i * width, 1), ((i + 1) * width, -1)):
                        ends[rank] = ends.get(rank, 0) + sign
            rows += [(mask, step, rank, sign) for rank, sign in ends.items() if sign]
    return rows


def removals(spark: SparkSession, counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part, rank, step`` and how many of ``n, good, toxic`` go there, zeros included.

    The interval ends are a table of fixed size that depends on the number of filters alone.
    """
    orders, measures = factorial(len(letters)), [F.sum(c).alias(c) for c in COUNTS]
    ends = spark.createDataFrame(interval_ends(letters), "mask int, step int, rank int, sign int")
    changes = counts.join(F.broadcast(ends), "mask").select("part", "step", "rank", *((F.col("sign") * F.col(c)).alias(c) for c in COUNTS))
    grid = counts.select("part").distinct().withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters))))).withColumn(
        "rank", F.explode(F.sequence(F.lit(0), F.lit(orders - 1)))).select("part", "step", "rank", *(F.lit(0).cast("long").alias(c) for c in COUNTS))
    changes = changes.where(F.col("rank") < orders).unionByName(grid).groupBy("part", "step", "rank").agg(*measures)
    so_far = Window.partitionBy("part", "step").orderBy("rank")  # one row per rank
    return changes.select("part", "rank", "step", *(F.sum(c).over(so_far).alias(c) for c in COUNTS))


def audit(spark: SparkSession, counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order and step; see the module's text for the method and `labelled_counts` for what comes in."""
    orders = F.array(*(F.lit("".join(order)) for order in permutations(letters)))
    letter, place = F.substring("filter_order", F.col("step"), F.lit(1)), F.expr(f"locate(letter, '{letters}')")
    of = [F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n"))), F.lit(0)) for k in range(len(letters))]
    alone = [F.coalesce(F.sum(F.when(F.col("mask") == 1 << k, F.col("n"))), F.lit(0)) for k in range(len(letters))]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.array(*of).alias("fails"), F.array(*alone).alias("alone"))
    steps = Window.partitionBy("part", "rank").orderBy("step")  # a row per filter
    rows = removals(spark, counts, letters).join(parts, "part")
    rows = rows.withColumn("filter_order", F.element_at(orders, F.col("rank") + 1)).withColumn("letter", letter).withColumn("place", place)
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("n").over(steps)).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("place")) - F.col("n")).alias("redundant"), F.element_at("alone", F.col("place")).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "letter")).alias("shapley"),  # a row per order
    )
