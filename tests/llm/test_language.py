"""Forward sums over words of any length, and no label in any prediction."""

import itertools
import os
import sys
import zlib

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textloom.llm import language, toxicity  # noqa: E402

PIECES = sorted(["▁", "▁a", "a", "b", "ab", "bab", "▁ab", "abababababababab"])


def log_total(word, chance):
    """Logarithm of the sum over all segmentations, position by position in logarithms."""
    sums = [np.zeros(chance.shape[1])]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(end):
            part = word[start:end]
            i = PIECES.index(part) if part in PIECES else len(PIECES) if len(part) == 1 else None
            if i is not None:
                ways.append(sums[start] + np.log(chance[i]))
        sums.append(np.logaddexp.reduce(ways))
    return sums[-1]


def test_long_words_are_summed_whole():
    chance = np.random.default_rng(1).random((len(PIECES) + 1, 3)) * 1e-6
    words = ["▁" + "ab" * 200, "▁" + "bab" * 100 + "x", "▁" + "ab" * 8, "▁b"]
    got = language.word_scores(words, language.Lattice(PIECES), chance)
    assert np.allclose(got, [log_total(w, chance) for w in words])


def test_expected_pieces():
    chance = np.random.default_rng(2).random((len(PIECES) + 1, 2)) * 1e-4
    sizes = np.array([*map(len, PIECES), 1])
    long = "▁" + "abbab" * 60
    for words in (["▁abab", "▁ab"], [long]):
        counts = np.arange(1, 2 * len(words) + 1).reshape(-1, 2).astype(float)
        uses = language.expected_pieces(words, counts, language.Lattice(PIECES), chance)
        letters = (counts * np.array([[len(w)] for w in words])).sum(axis=0)
        assert np.allclose(sizes @ uses, letters)  # every segmentation covers the word once
    word, want = "▁abab", np.zeros_like(chance)
    ways = []
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(word)]
        parts = [word[a:b] for a, b in zip([0, *ends], ends)]
        if all(p in PIECES for p in parts):
            ways.append([PIECES.index(p) for p in parts])
    chances = np.array([chance[w].prod(axis=0) for w in ways])
    for way, share in zip(ways, chances / chances.sum(axis=0)):
        np.add.at(want, way, share)
    got = language.expected_pieces([word], np.ones((1, 2)), language.Lattice(PIECES), chance)
    assert np.allclose(got, want)


def test_whole_vocabulary():
    pieces = language.load_pieces(language.vocabulary_path())
    assert max(map(len, pieces)) == language.Lattice(pieces).longest > 12


def test_held_out_labels_change_nothing(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    held = language.held_out("doc_id", 4, 2)
    other = table.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    rows = [sorted(map(tuple, language.op6(t).collect())) for t in (table, other)]
    assert [r[:3] for r in rows[0]] == [r[:3] for r in rows[1]]
    assert np.allclose([r[3] for r in rows[0]], [r[3] for r in rows[1]])
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in rows[0])
    found = language.op6(table.withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(found) == table.count() and not any(r.held_out for r in found)


def test_held_out_toxicity_labels_change_nothing(spark):
    path = "/root/testdata/sf0.001/{}.parquet"
    table = spark.read.parquet(path.format("documents"))
    labels = spark.read.parquet(path.format("labels"))
    held = language.held_out("doc_id", 3, 1)
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = [sorted(tuple(r) for r in toxicity.op9(table, given).collect()) for given in (labels, other)]
    assert [r[:2] for r in rows[0]] == [r[:2] for r in rows[1]]
    assert np.allclose([r[2] for r in rows[0]], [r[2] for r in rows[1]])
    assert all(r[1] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in rows[0])
