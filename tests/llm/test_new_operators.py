"""SentencePiece rounds, collocations and exact clusters against plain versions."""

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from test_operators import EXTRA, awkward  # noqa: E402

from textloom.llm import centroids, phrases, sentencepieces  # noqa: E402
from textloom.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


def result(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.tokenizer_path())


@pytest.fixture(scope="module")
def model():
    return sentencepieces.pieces_of(sentencepieces.tokenizer_path())


def odd_texts(library):
    pick = random.Random(1)
    names = [library.id_to_piece(i) for i in range(3, library.get_piece_size())]
    parts = "a e t in the é 日本 語 😀 한 <s> </s> <unk> <0x41> . , ' \x00 \x85   ​ ing Ver 1 23 ﬁ � ́".split(" ")
    parts += [" ", "  ", "▁", "\n", "\t"]
    for _ in range(1500):
        some = (pick.choice(parts) if pick.random() < 0.5 else pick.choice(names).replace("▁", " ") for _ in range(pick.randrange(1, 50)))
        yield "".join(some)
    for letters in ("etaoinshrdlu", "abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/"):
        for _ in range(30):
            yield "".join(pick.choice(letters) for _ in range(pick.randrange(1, 1500)))
    for n in [*range(70), 1000, 1009, 20_000]:
        yield from (" " * n, "a" + " " * n + "x", " " * n + "😀", "the" * n, "a" * n)


def test_sentencepiece_rounds_equal_the_library(library, model):
    texts = list(odd_texts(library))
    want = [[1, *ids, 2] for ids in library.encode(texts)]
    got = model.encode(texts)
    assert [x.tolist() for x in got] == want
    assert [model.decode(x) for x in got] == [library.decode(x) for x in want]
    pick = random.Random(2)
    for _ in range(2000):
        ids = [pick.randrange(32000) if pick.random() < 0.6 else pick.randrange(262) for _ in range(pick.randrange(12))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids)


def test_sentencepiece_without_the_rule_for_runs(library, model):
    for cut, texts in ((0, [" " * n + "x" for n in range(60)]), (model.run, [" " * 500])):
        own = sentencepieces.Pieces(sentencepieces.tokenizer_path())
        own.run = cut
        assert [x.tolist() for x in own.encode(texts)] == [[1, *ids, 2] for ids in library.encode(texts)]


def test_sentencepiece_query(spark, library):
    rows = [*awkward(), (None, "null id"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA}).repartition(3)
    ids = [(i, [1, *library.encode(t or ""), 2]) for i, t in rows]
    want = [(i, len(x), brute.sha(np.array(x, "<u4").tobytes()), brute.sha(library.decode(x))) for i, x in ids]
    assert result(sentencepieces.op11(docs)) == sorted(want, key=repr)
    back = sentencepieces.decode_pieces(sentencepieces.encode_pieces(docs))
    assert result(back) == sorted(((i, t or "") for i, t in rows), key=repr)
    given = table(spark, SF, "documents")
    assert sentencepieces.op11(given).count() == given.count()
    assert sentencepieces.op11(docs.limit(0)).count() == 0


def phrase_rows():
    pick = random.Random(4)
    rows = []
    for lang in ("a", "b\tc", None, "und"):
        words = [f"W{lang}{i}é" for i in range(25)]
        for _ in range(40):
            text = "".join(pick.choice(words[: pick.choice((3, 8, 25))]) + pick.choice((" ", " ", "\t", "  ", ", ", ".\n", "\r")) for _ in range(60))
            rows.append((lang, text))
    return [*rows, ("a", None), ("a", ""), (None, None), ("none", " .,"), ("one", "x"), *[("tie", "p q r. q r s. t u")] * 10, ("a", "x " * 30_000)]


def test_phrases(spark):
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    docs = docs.withColumns({c: F.lit("x") for c in [*EXTRA, "rank", "a", "x", "cut"]}).repartition(3)
    for limit, first in ((2000, None), (5, 1), (40, 3)):
        assert result(phrases.best_phrases(docs, limit=limit, first=first)) == sorted(brute.op12(rows, limit=limit), key=repr)
    assert phrases.op12(docs.limit(0)).count() == phrases.op12(docs.filter("lang = 'none'")).count() == 0


def test_phrases_of_a_table(spark):
    given = table(spark, SF, "documents")
    rows = [(r.lang, r.text) for r in given.collect()]
    assert result(phrases.op12(given)) == sorted(brute.op12(rows), key=repr)


def test_phrase_counts_beyond_64_bits(spark):
    big = 10**14
    frame = spark.createDataFrame([(big, big, 3 * big), (10, 3, 7)], "a long, l long, r long")
    got = [r[0] for r in frame.select(phrases.quotient("a", "l", "r").alias("q")).collect()]
    assert got == [10**6 * a * a // (x * y) for a, x, y in ((big, big, 3 * big), (10, 3, 7))]


def vector_rows():
    pick = np.random.default_rng(6)
    rows = [(int(i), (pick.standard_normal(64) * pick.choice([0.01, 1, 40])).tolist()) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[9][1]), (None, rows[3][1]), (None, rows[5][1])] + [(900 + i, rows[0][1]) for i in range(40)]
    bad = [None, [], [0.0] * 63, [0.0] * 65, [None] + [0.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    return rows + [(500 + i, v) for i, v in enumerate(bad)] + [(600, [0.0] * 64), (601, [-0.0] * 64)]


def test_centroids(spark):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.withColumns({c: F.lit(1) for c in ("cluster", "distance", "v", "away", "label")}).repartition(3)
    assert result(centroids.op13(frame)) == sorted(brute.op13(rows), key=repr)
    few = frame.filter("vec_id IN (7, 900, 901)")
    assert result(centroids.op13(few)) == sorted(brute.op13([r for r in rows if r[0] in (7, 900, 901)]), key=repr)
    same = frame.filter("vec_id >= 900")  # no two distinct pivots
    assert result(centroids.op13(same)) == sorted(brute.op13([r for r in rows if r[0] is not None and r[0] >= 900]), key=repr)
    assert centroids.op13(frame.limit(0)).count() == 0
    with pytest.raises(Exception, match="64 bits"):
        centroids.op13(spark.createDataFrame([(1, [1e300] * 64)], "vec_id long, embedding array<double>")).collect()


def test_bounds_hold_and_save_work():
    pick = np.random.default_rng(8)
    middle = pick.integers(-4000, 4000, (8, 64))
    rows = middle[pick.integers(0, 8, 3000)] + pick.integers(-300, 300, (3000, 64))
    for points in (middle, rows[:8], np.repeat(rows[:4], 2, axis=0)):
        pivots = centroids.pivots_of(points)
        away = centroids.distances(rows, pivots)
        real = np.stack([centroids.squared(rows, c) for c in points], 1)
        assert (centroids.lower_bounds(away, points, pivots) <= real).all()
        who, best, checked = centroids.nearest(rows, away, points, pivots)
        assert (who == real.argmin(1)).all() and (best == real.min(1)).all()
        assert checked < real.size
    huge = np.array([[(1 << 27) - 1] * 64, [1 - (1 << 27)] * 64])
    assert centroids.squared(huge, huge[0]).tolist() == [0, 64 * ((1 << 28) - 2) ** 2]
