"""The near-dedup and language stages of the pipeline on rows without or with repeated ids."""

import os
import random
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline as pipeline  # noqa: E402


def test_null_and_repeated_ids_keep_unrelated_texts(spark):
    pick = random.Random(8)
    texts = [" ".join(f"w{pick.randrange(9000)}" for _ in range(400)) for _ in range(6)]
    near = texts[0] + " tail"
    rows = [(None, texts[0], "a"), (None, near, "a"), (None, texts[1], "b"), (None, texts[1], "a")]
    rows += [(5, texts[2], "a"), (5, texts[3], "a"), (7, texts[3], "a"), (None, texts[3], "a")]
    rows += [(5, texts[4], "b"), (5, texts[4], "a"), (None, texts[5], "a"), (9, texts[5], "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in pipeline.drop_near_duplicates(spark, docs, "").collect()]
    first = [r for r in got if r[1] in (texts[0], near)]
    assert len(first) == 1
    rest = {(None, texts[1], "a"), (5, texts[2], "a"), (5, texts[3], "a"), (5, texts[4], "a"), (9, texts[5], "a")}
    assert len(got) == 6 and set(got) - set(first) == rest


def test_without_a_language_texts_with_letters_stay(spark):
    rows = [(1, "clean words", None), (2, "12 !? ___", None), (3, None, "en"), (4, "", None), (None, "été", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {tuple(r) for r in pipeline.identify_language(spark, docs, "").collect()}
    assert got == {rows[0], rows[4]}
