import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import vectors as V


@pytest.fixture(scope="module")
def bags(spark):
    rows = [(i % 40, " ".join(f"w{chr(97 + (i * j) % 26)}{chr(97 + j % 7)}" for j in range(i % 9))) for i in range(80)]
    rows += [(None, "waa wbb waa"), (None, "waa wbb waa")]
    return V.stored_bags(spark.createDataFrame(rows, "id long, text string").repartition(3))


def plan(df):
    return df._jdf.queryExecution().toString()


def test_entries_are_neither_spread_out_nor_regrouped(bags, monkeypatch):
    """One path for vocabularies of any size: distinct terms of a block travel, entries do not."""
    vocabulary = V.fit_vocabulary(bags)
    monkeypatch.setattr(V, "lookup_join", None)
    given = vocabulary.table.select("term", F.array(F.lit(1.0), F.col("idf")).cast("array<float>").alias("vector"))
    rows, means = V.sparse_rows(bags, vocabulary), V.mean_vectors(bags, given, 2)
    for found in (rows, means):
        assert "collect_set" not in plan(found) and "FlatMapCoGroupsInArrow" in plan(found)
        assert found.count() == bags.count()
    assert rows.filter("id IS NULL AND size(indices) = 2").count() == 2


@pytest.mark.parametrize("at_once", [2, 1 << 16])
def test_means_of_long_documents_are_summed_in_parts(bags, monkeypatch, at_once):
    vocabulary = V.fit_vocabulary(bags)
    given = vocabulary.table.select("term", F.array(F.lit(2.0), F.col("term_id")).cast("array<float>").alias("vector"))
    codes = {r["term"]: r["term_id"] for r in vocabulary.table.collect()}
    want = []
    for r in bags.collect():
        n = sum(e["tf"] for e in r["bag"])
        known = [(e["tf"], codes[e["term"]]) for e in r["bag"] if e["term"] in codes]
        want.append((2 * sum(t for t, _ in known) / n, sum(t * c for t, c in known) / n) if n else (0.0, 0.0))
    monkeypatch.setattr(V, "ENTRIES_AT_ONCE", at_once)
    got = [tuple(r["vector"]) for r in V.mean_vectors(bags, given, 2).collect()]
    assert np.array(sorted(got)) == pytest.approx(np.array(sorted(want)))


def test_vectors_travel_once_per_word_of_a_task_and_bags_as_bytes(spark):
    """Neither more rows of the same words nor their strings add to what is shuffled."""
    rows = spark.range(9000).selectExpr("id", "array('cat', 'dog', 'cat') AS tokens").coalesce(1)
    bags = V.bags(rows)
    stored, codes = V.packed_bags(bags, ["id"])
    assert sorted(r["term"] for r in codes.collect()) == ["cat", "dog"]
    assert dict(stored.dtypes)[V.CODES] == "binary" and stored.count() == 9000
    given = spark.createDataFrame([("cat", [3.0]), ("dog", [6.0])], "term string, vector array<float>")
    means = V.mean_vectors(bags, given, 1)
    assert "Aggregate" not in plan(means) and "struct<term" not in plan(means)
    assert means.filter("abs(vector[0] - 4) < 1e-12").count() == 9000


def test_small_packs_and_batches_give_the_same_means(spark, bags, monkeypatch):
    vocabulary = V.fit_vocabulary(bags)
    given = vocabulary.table.select("term", F.array(F.lit(2.0), F.col("term_id")).alias("vector"))
    rows = bags.unionByName(spark.createDataFrame([(7, [(None, 2), ("waa", 1)]), (8, []), (8, None)], bags.schema))

    def means():
        return np.array(sorted(r["vector"] for r in V.mean_vectors(rows, given, 2).collect()))

    want = means()
    assert len(want) == 85
    monkeypatch.setattr(V, "ENTRIES_PER_PACK", 5)
    monkeypatch.setattr(V, "WORDS_PER_ROW", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert V.packed_bags(rows, ["id"])[0].select(V.BLOCK).distinct().count() > 10
        assert means() == pytest.approx(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_words_with_several_vectors_enter_with_each(spark):
    bags = V.stored_bags(spark.createDataFrame([(1, "cat dog dog")], "id long, text string"))
    rows = [("dog", [3.0]), ("dog", [5.0]), ("cat", None)]
    given = spark.createDataFrame(rows, "term string, vector array<float>")
    assert V.mean_vectors(bags, given, 1).first()["vector"] == pytest.approx([16 / 5])
    broken = spark.createDataFrame([("dog", [None])], "term string, vector array<float>")
    with pytest.raises(Exception, match="null component"):
        V.mean_vectors(bags, broken, 1).collect()


def test_lemmas_are_looked_up_per_block_and_added_there(spark):
    rows = [(1, ["ab", "abs", "xs", "ab"]), (None, ["xs"]), (None, ["xs"]), (3, []), (4, None)]
    bags = V.bags(spark.createDataFrame(rows, "id long, tokens array<string>").repartition(2))
    given = [("abs", "AB"), ("xs", "x"), ("xs", "y"), ("ab", None)]
    found = V.lemma_bags(bags, spark.createDataFrame(given, "surface string, lemma string"))
    assert "collect_list" not in plan(found) and "FlatMapCoGroupsInArrow" in plan(found)
    got = sorted(((r["id"], [tuple(e) for e in r["bag"]]) for r in found.collect()), key=str)
    both = [("x", 1), ("y", 1)]
    assert got == sorted([(1, [("ab", 3), *both]), (None, both), (None, both), (3, []), (4, [])], key=str)


def test_scored_vectors_do_not_pass_through_text(bags):
    vocabulary = V.fit_vocabulary(bags)
    found = V.lazy_ml_vectors(V.sparse_rows(bags, vocabulary), vocabulary.n_terms)
    assert "json" not in plan(found).lower()
    assert found.filter("id IS NULL").first()["features"].numNonzeros() == 2
