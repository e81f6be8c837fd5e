import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidecast.functions.text import clean_text, contains_any, filtered_text, keyword_tags, tokens


def column(spark, values, make):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("t"))).collect()]


def test_cleaning(spark):
    texts = [None, "", "   ", "http://a.b/c", "www.x.org @me", "Hi @Zoë! #Été_2024 is  ON now\n", "a#b", "mail@x y", "#@ab#c @#d #@e@f #www.x @http://y",
             "A B　C", "see https://t.co/x?y=1, ok"]
    expected = ["", "", "", "", "", "hi ! été_2024 is on now", "ab", "mail y", "#c @d # # @","a b c", "see ok"]
    assert column(spark, texts, clean_text) == expected


def plain_python_clean(text):
    text = re.sub(r"https?://\S+|www\.\S+", "", text.lower())
    text = re.sub(r"#(\w+)", r"\1", re.sub(r"@\w+", "", text))
    return re.sub(r"\s+", " ", text).strip()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aZé@#_ \n\t  ́नाhtps:/.w1!İß", max_size=40), min_size=20, max_size=40))
def test_cleaning_agrees_with_python_regexes(spark, texts):
    assert column(spark, texts, clean_text) == [plain_python_clean(t) for t in texts]


def test_combining_marks_end_a_mention_but_not_a_token(spark):
    assert column(spark, ["@नाम ok"], clean_text) == ["ाम ok"]
    assert column(spark, ["नाम ét"], tokens) == [["नाम", "ét"]]


def test_tokens_drop_stop_words_and_punctuation(spark):
    assert column(spark, ["the end, of: it!"], lambda t: filtered_text(t, ["the", "of"])) == ["end it"]
    many = [f"w{i}" for i in range(40)]
    assert column(spark, ["w1 x w39 y"], lambda t: filtered_text(t, many)) == ["x y"]


def test_keywords(spark):
    words = ["Cup", "FINAL", "x y"]
    texts = ["the cup final", "X Y cupboard", "none", None]
    assert column(spark, texts, lambda t: keyword_tags(t, words)) == [["Cup", "FINAL"], ["Cup", "x y"], [], []]
    assert column(spark, texts[:3], lambda t: contains_any(t, words)) == [True, True, False]
    assert column(spark, texts[:1], lambda t: keyword_tags(t, [])) == [[]]
    assert column(spark, texts[:1], lambda t: contains_any(t, [])) == [False]
