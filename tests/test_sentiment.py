import math

import pytest
from pyspark.sql import functions as F

from tidecast.functions.sentiment import (
    WordFilter, classifier_column, classifier_score, collect_words, combine_sentiment, inline_lexicon, lexicon_sentiment,
    lexicon_sentiment_joined, score_sentiment,
)

WORDS = {"good": 1.9, "great": 3.1, "bad": -2.5, "zero": 0.0, "été": 0.7}


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(WORDS.items()), "token string, valence double")


def half_up(x, digits):
    return math.floor(x * 10 ** digits + 0.5) / 10 ** digits


def brute_force(words):
    if not words:
        return 0.0, 0.0, 0.0, 0.0
    values = [WORDS.get(w, 0.0) for w in words]
    gain = sum(v + 1 for v in values if v > 0)
    loss = sum(1 - v for v in values if v < 0)
    flat = sum(1 for v in values if v == 0)
    total, net = gain + loss + flat, sum(values)
    return (half_up(gain / total, 3), half_up(flat / total, 3), half_up(loss / total, 3),
            half_up(net / math.sqrt(net * net + 15), 4))


TEXTS = ["good bad table", "GREAT #great @good http://bad.x", "the the the", "", None, "zero été chair", "bad " * 500]
KEPT = [["good", "bad", "table"], ["great", "great"], [], [], [], ["zero", "été", "chair"], ["bad"] * 500]


@pytest.mark.parametrize("joined", [False, True])
def test_lexicon_scores_match_brute_force(spark, lexicon, joined):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    if joined:
        scored = lexicon_sentiment_joined(df, "t", lexicon, ["the"])
    else:
        scored = lexicon_sentiment(df, "t", inline_lexicon(lexicon, ["the"]))
    rows = scored.orderBy("i").collect()
    for row, words in zip(rows, KEPT):
        assert row.n_words == len(words)
        assert (row.pos, row.neu, row.neg, row.compound) == pytest.approx(brute_force(words), abs=1e-12)


def test_joined_scores_keep_every_copy_of_a_text(spark, lexicon):
    """Ids repeat and a third of the rows is one text: each row keeps its own score."""
    df = spark.range(900).select((F.col("id") % 7).alias("id"), F.when(F.col("id") % 3 == 0, F.lit("good copy"))
                                 .otherwise(F.concat(F.lit("bad "), F.col("id").cast("string"))).alias("t"))
    joined = lexicon_sentiment_joined(df, "t", lexicon).groupBy("t", "pos", "neg").count()
    inline = lexicon_sentiment(df, "t", inline_lexicon(lexicon)).groupBy("t", "pos", "neg").count()
    assert sorted(joined.collect()) == sorted(inline.collect())
    assert joined.agg(F.sum("count")).first()[0] == 900


def test_lexicon_beyond_the_bound_is_joined(spark, lexicon):
    with pytest.raises(ValueError):
        inline_lexicon(lexicon, max_entries=4)
    assert inline_lexicon(lexicon, max_entries=5) is not None
    assert inline_lexicon(lexicon.limit(0), ["a"]) is not None
    assert inline_lexicon(lexicon.limit(0)) is not None


def test_a_stop_word_in_the_lexicon_does_not_count(spark, lexicon):
    df = spark.createDataFrame([("good bad",)], "t string")
    row = lexicon_sentiment(df, "t", inline_lexicon(lexicon, ["good"])).first()
    assert (row.n_words, row.pos, row.neg) == (1, 0.0, 1.0)
    row = lexicon_sentiment(df, "t", inline_lexicon(lexicon, ["good", "bad"])).first()
    assert (row.n_words, row.pos, row.neu, row.neg, row.compound) == (0, 0.0, 0.0, 0.0, 0.0)


def test_repeated_token_takes_its_highest_valence(spark):
    twice = spark.createDataFrame([("ok", 1.0), ("ok", 2.0)], "token string, valence double")
    df = spark.createDataFrame([("ok",)], "t string")
    assert lexicon_sentiment(df, "t", inline_lexicon(twice)).first().compound == half_up(2 / math.sqrt(19), 4)


def blend(spark, pos, neu, neg, compound, h):
    df = spark.createDataFrame([(pos, neu, neg, compound, h)], "p double, u double, n double, c double, h double")
    return df.select(combine_sentiment(*[F.col(c) for c in "punch"[:3]], F.col("c"), F.col("h")).alias("s")).first().s


def test_blend(spark):
    s = blend(spark, 0.2, 0.5, 0.3, 0.1, 0.9)
    up, down, flat = 0.2 * 0.7 + 0.27, 0.3 * 0.7 + 0.03, 0.35
    total = up + down + flat
    assert (s.positive, s.neutral, s.negative) == pytest.approx((up / total, flat / total, down / total), abs=1e-6)
    assert s.compound == pytest.approx(0.1)
    assert s.positive + s.neutral + s.negative == pytest.approx(1, abs=2e-3)


def test_missing_classifier_keeps_lexicon_scores_and_empty_text_stays_zero(spark):
    s = blend(spark, 0.2, 0.5, 0.3, 0.1, None)
    assert (s.positive, s.neutral, s.negative) == pytest.approx((0.2, 0.5, 0.3))
    assert tuple(blend(spark, 0.0, 0.0, 0.0, 0.0, 0.9)) == (0.0, 0.0, 0.0, 0.0)
    assert tuple(blend(spark, None, None, None, None, None)) == (0.0, 0.0, 0.0, 0.0)


def test_classifier_orientation(spark):
    df = spark.createDataFrame([("POSITIVE", 0.8), ("NEGATIVE", 0.8), (None, None)], "l string, s double")
    got = [r[0] for r in df.select(classifier_score(F.col("l"), F.col("s"))).collect()]
    assert got == [0.8, pytest.approx(0.2), None]


def test_classifier_hook_reads_whole_texts(spark):
    def make():
        def classify(texts):
            assert all(0 < len(t) <= 10 for t in texts)
            return ["POSITIVE" if "a" in t else "NEGATIVE" for t in texts], [1.0] * len(texts)
        return classify
    df = spark.createDataFrame([(0, "bbbbb"), (1, "b" * 10 + "a" * 5), (2, ""), (3, None), (4, "b" * 25 + "a")], "i int, t string")
    scored = df.withColumn("h", classifier_column(F.col("t"), make, max_chars=10)).orderBy("i").collect()
    assert [r.h for r in scored] == [0.0, pytest.approx(1 / 3), None, None, pytest.approx(6 / 26)]


def test_score_sentiment_adds_one_column(spark, lexicon):
    df = spark.createDataFrame([("a", "good", 0.9), ("b", "bad", None)], "id string, text string, h double")
    out = score_sentiment(df, "text", lexicon, (), F.col("h"))
    assert out.columns == ["id", "text", "h", "sentiment"]
    got = {r.id: r.sentiment for r in out.collect()}
    assert got["a"].positive > got["b"].positive == 0.0
    with pytest.raises(ValueError):
        score_sentiment(df.withColumn("pos", F.lit(1)), "text", lexicon)


def test_stop_list_has_a_bound(spark):
    stops = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "token string")
    assert collect_words(stops) == ["a", "b"]
    with pytest.raises(ValueError):
        collect_words(spark.range(20).selectExpr("cast(id as string) token"), 10)


def test_joined_lexicon_ships_no_texts(spark, lexicon, tmp_path):
    """Below the last join an exchange carries names, words and numbers only; words outside the lexicon do not reach one."""
    rows = [("good good day " + "filler " * 50 + str(k % 3),) for k in range(300)] + [(None,), ("",), ("nothing here",)]
    spark.createDataFrame(rows, "t string").write.parquet(str(tmp_path / "t"))
    scored = lexicon_sentiment_joined(spark.read.parquet(str(tmp_path / "t")), "t", lexicon, ["the"]).select("n_words", "pos", "compound")
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("t#" in line.split("Exchange")[1].split("[plan_id")[0].replace("count#", "").replace("bit#", "") for line in exchanges)
    assert "first(" not in plan
    inline = lexicon_sentiment(spark.read.parquet(str(tmp_path / "t")), "t", inline_lexicon(lexicon, ["the"])).select("n_words", "pos", "compound")
    assert sorted(scored.collect()) == sorted(inline.collect())


def test_word_filter_holds_the_whole_lexicon(spark):
    words = spark.range(20_000).select(F.concat(F.lit("w"), "id").alias("token"))
    may_hold = WordFilter(words).may_hold
    assert words.where(~may_hold(F.col("token"))).count() == 0
    others = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("token"))
    assert others.where(may_hold(F.col("token"))).count() < 100
