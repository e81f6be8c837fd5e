"""Sentiment scores from a word-valence lexicon, optionally blended with a classifier.

The polarity formula is the published lexicon-and-normalise one without its negation, booster, idiom and
"but" rules: those need capitals, punctuation and stop words, which cleaning has already removed.

Valences are added up as whole millionths, so a score does not depend on the order of the additions.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidecast.functions.rounding import round_half_up
from tidecast.functions.text import strip_markup, tokens
from tidecast.operators.skew import lookup_join
from tidecast.schemas import SENTIMENT

MICROS = 1_000_000
# The classifier's share, and the constant that bends the valence sum into (-1, 1).
LEXICON_SHARE = 0.7
CLASSIFIER_SHARE = 0.3
COMPOUND_ALPHA = 15.0
POSITIVE_LABEL = "POSITIVE"

# Up to this many entries the lexicon may travel inside the plan; `inline_lexicon` refuses more.
MAX_INLINE_ENTRIES = 50_000
# A joined lexicon's filter: half a million words at some one in a hundred false answers.
FILTER_BITS, FILTER_HASHES = 1 << 22, 3
# Stands for a stop word; no valence comes near it.
STOP = -(2 ** 62)


def lexicon_micros(lexicon: DataFrame) -> DataFrame:
    """``(token, valence)`` to one ``(token, micros)`` row per token; the highest valence of a token wins."""
    micros = F.round(F.col("valence").cast("double") * MICROS).cast("bigint")
    known = lexicon.where(F.col("token").isNotNull() & F.col("valence").isNotNull())
    return known.groupBy("token").agg(F.max(micros).alias("micros"))


@dataclass(frozen=True)
class InlineLexicon:
    """A lexicon and stop list small enough for the plan: an array of small maps, indexed by a hash of the token.

    Looking a token up in one big map column scans the whole map; here it scans one bucket.  A stop word has
    the marker `STOP` for its valence.
    """

    buckets_json: str
    n_buckets: int

    def micros(self, token: Column) -> Column:
        table = F.from_json(F.lit(self.buckets_json), "array<map<string, bigint>>")
        bucket = F.pmod(F.xxhash64(token), F.lit(self.n_buckets)).cast("int")
        return F.element_at(F.get(table, bucket), token)


def inline_lexicon(lexicon: DataFrame, stop_words: Sequence[str] = (),
                   max_entries: int = MAX_INLINE_ENTRIES) -> InlineLexicon:
    """Read the lexicon into a plan literal; one with more than ``max_entries`` is refused and has to be joined.

    A word in both lists is a stop word.
    """
    listed = lexicon_micros(lexicon).limit(max_entries + 1)
    if stop_words:
        stops = lexicon.sparkSession.range(1).select(F.explode(F.lit(list(stop_words))).alias("token"))
        listed = listed.unionByName(stops.select("token", F.lit(STOP).alias("micros")))
    # Spark computes the hashes, so that they agree with the lookup.
    rows = listed.select("token", "micros", F.xxhash64("token").alias("hash")).collect()
    if sum(row.micros != STOP for row in rows) > max_entries:
        raise ValueError(f"more than {max_entries} entries: pass the frame itself, it is then joined")
    buckets: list[dict[str, int]] = [{} for _ in range(max(1, len(rows)))]
    for row in rows:
        bucket = buckets[row.hash % len(buckets)]
        bucket[row.token] = min(row.micros, bucket.get(row.token, row.micros))
    return InlineLexicon(json.dumps(buckets, ensure_ascii=False), len(buckets))


def valence_sums(words: Column, lexicon: InlineLexicon) -> Column:
    """One pass over the words of a row: positive, negative and net valence, words with a valence, stop words."""
    known = F.filter(F.transform(words, lexicon.micros), lambda v: v.isNotNull() & (v != 0))
    zero = F.lit(0).cast("bigint")
    start = F.struct(*[zero.alias(name) for name in ("gain", "loss", "net", "hits", "stops")])

    def add(acc: Column, v: Column) -> Column:
        stop = v == STOP
        return F.struct(
            (acc["gain"] + F.when(v > 0, v + MICROS).otherwise(0)).alias("gain"),
            (acc["loss"] + F.when((v < 0) & ~stop, MICROS - v).otherwise(0)).alias("loss"),
            (acc["net"] + F.when(stop, 0).otherwise(v)).alias("net"),
            (acc["hits"] + F.when(stop, 0).otherwise(1)).alias("hits"),
            (acc["stops"] + F.when(stop, 1).otherwise(0)).alias("stops"),
        )
    return F.aggregate(known, start, add)


def polarity(sums: Column, n_words: Column) -> dict[str, Column]:
    """pos, neu, neg (3 decimals) and compound (4 decimals); all zero for a text without words."""
    neutral = (n_words - sums["hits"]) * MICROS
    total = (sums["gain"] + sums["loss"] + neutral).cast("double")
    net = sums["net"].cast("double") / F.lit(float(MICROS))
    scores = {
        "pos": round_half_up(sums["gain"].cast("double") / total, 3),
        "neu": round_half_up(neutral.cast("double") / total, 3),
        "neg": round_half_up(sums["loss"].cast("double") / total, 3),
        "compound": round_half_up(net / F.sqrt(net * net + F.lit(COMPOUND_ALPHA)), 4),
    }
    return {name: F.when(n_words > 0, score).otherwise(F.lit(0.0)).alias(name) for name, score in scores.items()}


def classifier_score(label: Column, score: Column) -> Column:
    """Orient a (label, score) answer so that 1 means positive."""
    return F.when(label == POSITIVE_LABEL, score).when(label.isNotNull(), F.lit(1.0) - score)


def combine_sentiment(pos: Column, neu: Column, neg: Column, compound: Column,
                      classifier: Column | None = None) -> Column:
    """Blend lexicon and classifier into the sentiment struct.

    Without a classifier score the lexicon's scores are kept, also when only this row's score is missing:
    treating a failed classifier as the score 0 would push the text towards negative.
    """
    if classifier is None:
        blended = {"positive": pos, "neutral": neu, "negative": neg}
    else:
        share, rest = F.lit(CLASSIFIER_SHARE), F.lit(LEXICON_SHARE)
        up = pos * rest + classifier * share
        down = neg * rest + (F.lit(1.0) - classifier) * share
        flat = neu * rest
        total = up + down + flat
        # An empty text has no lexicon share at all and stays at zero.
        use = classifier.isNotNull() & (pos + neu + neg > 0)
        blended = {
            "positive": F.when(use, F.when(total > 0, up / total).otherwise(up)).otherwise(pos),
            "neutral": F.when(use, F.when(total > 0, flat / total).otherwise(flat)).otherwise(neu),
            "negative": F.when(use, F.when(total > 0, down / total).otherwise(down)).otherwise(neg),
        }
    parts = [F.coalesce(score, F.lit(0.0)).cast("float").alias(name) for name, score in blended.items()]
    parts.append(F.coalesce(compound, F.lit(0.0)).cast("float").alias("compound"))
    return F.struct(*parts).cast(SENTIMENT)


Classifier = Callable[[Sequence[str]], tuple[Sequence[str], Sequence[float]]]


def classifier_column(text: Column, make_classifier: Callable[[], Classifier], max_chars: int = 512,
                      pieces_per_call: int = 256) -> Column:
    """Score texts with a model: ``make_classifier()`` is called once per task and its result takes a list of
    texts and returns their labels and scores.

    Models take a limited input.  A longer text is cut into pieces of ``max_chars`` and gets the mean of the
    pieces' scores, weighted by their lengths, so all of it counts.  The model sees at most ``pieces_per_call`` pieces at once.  NULL text, or a NaN score on any piece,
    gives NULL.
    """

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        classify = make_classifier()
        for texts in batches:
            pieces, owner = [], []
            for row, text in enumerate(texts):
                for at in range(0, len(text) if text else 0, max_chars):
                    pieces.append(text[at:at + max_chars])
                    owner.append(row)
            if not pieces:
                yield pd.Series(np.full(len(texts), np.nan))
                continue
            parts = []
            for at in range(0, len(pieces), pieces_per_call):
                labels, scores = classify(pieces[at:at + pieces_per_call])
                scores = np.asarray(scores, dtype="float64")
                parts.append(np.where(np.asarray(labels) == POSITIVE_LABEL, scores, 1.0 - scores))
            oriented = np.concatenate(parts)
            weight = np.asarray([len(p) for p in pieces], dtype="float64")
            total = np.bincount(owner, weights=weight, minlength=len(texts))
            summed = np.bincount(owner, weights=weight * oriented, minlength=len(texts))
            yield pd.Series(np.divide(summed, total, out=np.full(len(texts), np.nan), where=total > 0))

    answer = score(text)
    return F.when(~F.isnan(answer), answer)


def lexicon_sentiment(df: DataFrame, text_col: str, lexicon: InlineLexicon) -> DataFrame:
    """Add n_words, pos, neu, neg and compound to each row, without a shuffle; batch or streaming."""
    words = df.withColumn("_words", tokens(strip_markup(F.col(text_col))))
    sums = words.select(*df.columns, F.size("_words").alias("_n"), valence_sums(F.col("_words"), lexicon).alias("_sums"))
    counted = sums.select(*df.columns, (F.col("_n") - F.col("_sums.stops")).alias("n_words"), "_sums")
    return counted.select(*df.columns, "n_words", *polarity(F.col("_sums"), F.col("n_words")).values())


class WordFilter:
    """A Bloom filter of a lexicon's words, in the plan: a word it does not hold has no valence.

    Its bits are an array of whole numbers of a fixed length, so the plan does not grow with the lexicon; one with more words than `FILTER_BITS`
    allows for lets more words through, which only costs.
    """

    def __init__(self, lexicon: DataFrame) -> None:
        places = F.explode(F.array(*self._places(F.col("token"))))
        words = lexicon.select(places.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
        table = [0] * (FILTER_BITS // 64)
        for row in words.collect():  # at most FILTER_BITS / 64 rows
            table[row.word] = row.bits
        self.bits = F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), "array<bigint>")

    @staticmethod
    def _places(token: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(token, F.lit(k)), F.lit(FILTER_BITS)) for k in range(FILTER_HASHES)]

    def may_hold(self, token: Column) -> Column:
        tests = [F.getbit(F.get(self.bits, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1 for at in self._places(token)]
        return reduce(lambda a, b: a & b, tests)


def lexicon_sentiment_joined(df: DataFrame, text_col: str, lexicon: DataFrame,
                             stop_words: Sequence[str] = ()) -> DataFrame:
    """The same scores for a lexicon too large for the plan, by joins; batch only.

    Texts stay where they are: a text is named by 128 bits of its hash, and what is shuffled is (name, word, number) for the words that a Bloom filter of the
    lexicon lets through, counted within each task first.  Copies of a text are added up with it and divided out again by their number, which is the
    number of first words.  A text without such a word goes along as a word of its own.  Adaptive execution splits the joins of frequent words, and of texts
    with many copies.
    """
    words = lexicon_micros(lexicon)
    may_hold = WordFilter(words).may_hold
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = df.withColumn("_key", F.substring(F.unhex(F.sha2(text, 256)), F.lit(1), F.lit(16)))
    split = keyed.select("_key", tokens(strip_markup(F.col(text_col)), stop_words).alias("_words"))
    split = split.select("_key", F.size("_words").alias("n_words"), F.posexplode_outer(F.filter("_words", may_hold)).alias("_at", "token"))
    counted = split.groupBy("_key", F.coalesce("token", F.concat(F.lit("\0"), F.hex("_key"))).alias("token")).agg(
        F.count("token").alias("n"), F.count_if(F.coalesce("_at", F.lit(0)) == 0).alias("first"), F.max("n_words").alias("n_words"))
    v, n = F.col("micros"), F.col("n")

    def of_one(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    sums = lookup_join(counted, words, "token").groupBy("_key").agg(
        F.sum("first").alias("copies"), F.max("n_words").cast("bigint").alias("n_words"),
        of_one(F.when(v > 0, (v + MICROS) * n)).alias("gain"), of_one(F.when(v < 0, (MICROS - v) * n)).alias("loss"),
        of_one(v * n).alias("net"), of_one(F.when(v != 0, n)).alias("hits"),
    )
    sums = sums.select("_key", "n_words", F.struct(*[F.expr(f"{c} div copies").alias(c) for c in ("gain", "loss", "net", "hits")]).alias("_sums"))
    scored = lookup_join(keyed, sums, "_key")
    return scored.select(*df.columns, "n_words", *polarity(F.col("_sums"), F.col("n_words")).values())


def score_sentiment(df: DataFrame, text_col: str, lexicon: DataFrame | InlineLexicon,
                    stop_words: Sequence[str] = (), classifier: Column | None = None,
                    output_col: str = "sentiment") -> DataFrame:
    """Add the sentiment struct to every row.

    ``classifier`` is a column with the classifier's score (see `classifier_column`), or None.  The caller chooses the
    form: an `InlineLexicon`, which brings its own stop words, is looked up in the row; a lexicon frame of any size is
    joined.  The scores are the same.  On a stream a frame is joined batch by batch: call this inside ``foreachBatch``.
    """
    scratch = ("pos", "neu", "neg", "compound", "n_words")
    if clash := set(df.columns) & set(scratch):
        raise ValueError(f"rename the columns {sorted(clash)} first")
    if classifier is not None:
        df = df.withColumn("_classifier", classifier)
    if isinstance(lexicon, InlineLexicon):
        scored = lexicon_sentiment(df, text_col, lexicon)
    elif df.isStreaming:
        raise ValueError("a lexicon frame is joined per batch: score inside foreachBatch, or pass an InlineLexicon")
    else:
        scored = lexicon_sentiment_joined(df, text_col, lexicon, stop_words)
    score = combine_sentiment(F.col("pos"), F.col("neu"), F.col("neg"), F.col("compound"),
                              F.col("_classifier") if classifier is not None else None)
    return scored.withColumn(output_col, score).drop(*scratch, "_classifier")


def collect_words(stop_list: DataFrame, max_entries: int = 10_000) -> list[str]:
    """A stop list ``(token)`` as Python strings; refuses a list that is no stop list."""
    rows = stop_list.select("token").distinct().limit(max_entries + 1).collect()
    if len(rows) > max_entries:
        raise ValueError(f"stop list has more than {max_entries} words")
    return sorted(row.token for row in rows if row.token is not None)

