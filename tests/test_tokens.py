import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.functions.arrays import l2_normalized, term_bag
from textloom.functions.stopwords import ENGLISH_STOP_WORDS
from textloom.operators import vectors as V


def run(spark, text, tokenizer=X.tokenize):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(tokenizer(F.col("text"))).first()[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("see http://a.com/x now", "see"),
        ("covid19", ""),
        ("state-of-the-art", "state art"),
        ("don't", ""),
        ("John's", "john"),
        ("don’t John’s", "john"),
        ("visit paper.com/today please", "visit please"),
        ("www.x.org", ""),
        ("end.Start next", "end start next"),
        ("U.S. economy", "u economy"),
        ("", ""),
    ],
)
def test_default_tokenizer(spark, text, expected):
    assert " ".join(run(spark, text)) == expected


def test_stop_words_are_sparks_list(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_raw_tokens_keep_everything(spark):
    assert run(spark, "The cat, don't!", X.raw_tokens) == ["the", "cat", ",", "don", "'", "t", "!"]


def test_case_is_kept_on_demand(spark):
    kept = run(spark, "The Cat", lambda c: X.surface_tokens(c, lower_first=False))
    assert kept == ["Cat"]


def test_bag_counts_and_empty_bag(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,)], "t array<string>")
    bags = [[tuple(e) for e in r[0]] for r in df.select(term_bag(F.col("t"))).collect()]
    assert bags == [[("a", 1), ("b", 2)], [], []]


def test_unit_norm_or_zero(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([],), ([0.0],)], "v array<double>")
    assert [r[0] for r in df.select(l2_normalized(F.col("v"))).collect()] == [[0.6, 0.8], [], [0.0]]


def test_lemmas_keep_order_and_repeats(spark):
    df = spark.createDataFrame(
        [(1, "x", ["cats", "ran", "cats"]), (2, "y", [])],
        "id int, category string, tokens array<string>",
    )
    lemmas = spark.createDataFrame([("cats", "Cat"), ("ran", "run")], "surface string, lemma string")
    rows = {r["id"]: r for r in V.lemmatize(df, lemmas).collect()}
    assert rows[1]["tokens"] == ["cat", "run", "cat"] and rows[1]["category"] == "x"
    assert rows[2]["tokens"] == []
    assert V.lemmatize(df, None).filter("id = 1").first()["tokens"] == ["cats", "ran", "cats"]
