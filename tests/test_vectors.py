import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import ranking, sequences, vectors as V


@pytest.fixture(scope="module")
def fitted(spark, small_corpus):
    bags = V.stored_bags(small_corpus)
    return bags, V.fit_vocabulary(bags)


def python_bags(df):
    stop = {"the", "and", "of"}
    return {r["id"]: Counter(w for w in r["text"].split() if w not in stop) for r in df.collect()}


def test_vocabulary_is_sorted_and_pruned(spark, small_corpus, fitted):
    bags, vocabulary = fitted
    df = Counter(w for bag in python_bags(small_corpus).values() for w in bag)
    rows = vocabulary.table.orderBy("term_id").collect()
    assert [r["term"] for r in rows] == sorted(w for w, n in df.items() if n >= 2)
    assert [r["term_id"] for r in rows] == list(range(len(rows)))
    assert vocabulary.n_docs == 26 and vocabulary.n_terms == len(rows)


def test_tfidf_matches_python(small_corpus, fitted):
    bags, vocabulary = fitted
    terms = {r["term"]: r for r in vocabulary.table.collect()}
    for row in V.sparse_rows(bags, vocabulary).collect():
        bag = python_bags(small_corpus.filter(F.col("id") == row["id"]))[row["id"]]
        raw = {
            terms[w]["term_id"]: n * (math.log(27 / (1 + terms[w]["df"])) + 1)
            for w, n in bag.items()
            if w in terms
        }
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        expected = [(i, raw[i] / norm) for i in sorted(raw)]
        assert row["indices"] == [i for i, _ in expected]
        assert row["values"] == pytest.approx([x for _, x in expected])


def test_documents_without_known_terms_stay(spark, fitted):
    _, vocabulary = fitted
    new = spark.createDataFrame([(1, "unheard words"), (2, "cat cat zebra")], "id long, text string")
    bags = V.bags(V.tokens(new))
    rows = {r["id"]: r for r in V.sparse_rows(bags, vocabulary, "count").collect()}
    assert rows[1]["indices"] == [] and rows[2]["values"] == [2.0]
    shape = V.matrix_shape(V.sparse_rows(bags, vocabulary, "count"), vocabulary).first()
    assert (shape["n_docs"], shape["n_nonzero"]) == (2, 1)
    vector = V.lazy_ml_vectors(V.sparse_rows(bags, vocabulary), vocabulary.n_terms)
    stored = V.ml_vectors(V.sparse_rows(bags, vocabulary), vocabulary.n_terms)
    a, b = ({r["id"]: r["features"] for r in d.collect()} for d in (vector, stored))
    assert a == b and a[1].numNonzeros() == 0 and a[2].size == vocabulary.n_terms


def test_large_vocabulary_gives_the_same_rows(fitted, monkeypatch):
    bags, vocabulary = fitted
    expected = {r["id"]: r for r in V.sparse_rows(bags, vocabulary).collect()}
    huge = V.Vocabulary(vocabulary.table, vocabulary.n_docs, vocabulary.n_terms, 1 << 40)
    got = {r["id"]: r for r in V.sparse_rows(bags, huge).collect()}
    assert got == expected


def test_mean_vector_counts_unknown_words_as_zero(spark):
    df = spark.createDataFrame([(1, "a a b x"), (2, "x"), (3, "")], "id long, text string")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 4.0])], "term string, vector array<float>")
    rows = {r["id"]: r["vector"] for r in V.mean_vectors(V.raw_bags(df), vectors, 2).collect()}
    assert rows == {1: [0.5, 1.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_top_terms_break_ties_by_term(spark):
    df = spark.createDataFrame([("c", 2, 1.0), ("c", 1, 1.0), ("c", 0, 0.5)], "category string, term_id int, weight double")
    top = ranking.top_terms(ranking.category_term_sums(df), 2).orderBy("rank").collect()
    assert [r["term_id"] for r in top] == [1, 2]
    plan = ranking.top_terms(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rows_that_repeat_an_id_stay_apart(spark, fitted):
    _, vocabulary = fitted
    rows = [(1, "cat dog"), (1, "cat fur fur"), (1, "cat fur fur"), (2, "cat"), (3, ""), (3, "")]
    table = V.tokens(spark.createDataFrame(rows, "id long, text string"))
    found = sorted((r["id"], r["values"]) for r in V.sparse_rows(V.bags(table), vocabulary, "count").collect())
    assert found == [(1, [1.0, 1.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0]), (3, []), (3, [])]
    lemmas = spark.createDataFrame([("fur", "Hair")], "surface string, lemma string")
    words = sorted((r["id"], " ".join(r["tokens"])) for r in V.lemmatize(table, lemmas).collect())
    assert words == [(1, "cat dog"), (1, "cat hair hair"), (1, "cat hair hair"), (2, "cat"), (3, ""), (3, "")]
    texts = spark.createDataFrame(rows, "id long, text string")
    assert sequences.encode(texts, vocabulary, max_len=8).groupBy("id").count().orderBy("id").collect() == [
        (1, 3), (2, 1), (3, 2)
    ]


def test_vectors_of_different_lengths_are_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    assert V.common_width(df.filter("size(v) = 2"), "v") == 2
    with pytest.raises(ValueError):
        V.common_width(df, "v")


def test_long_weights_equal_the_rows(spark, fitted, monkeypatch):
    bags, vocabulary = fitted
    for weighting, norm in (("tfidf", True), ("tfidf", False), ("count", True)):
        rows = V.weights(V.sparse_rows(bags, vocabulary, weighting, norm))
        expected = {(r["id"], r["term_id"]): r["weight"] for r in rows.collect()}
        for size in (vocabulary.size, 1 << 40):
            sized = V.Vocabulary(vocabulary.table, vocabulary.n_docs, vocabulary.n_terms, size)
            got = V.term_weights(bags, sized, weighting, norm).collect()
            assert {(r["id"], r["term_id"]): r["weight"] for r in got} == pytest.approx(expected)
            assert len(got) == len(expected)
    with pytest.raises(ValueError):
        V.term_weights(bags, vocabulary, "other")


def test_long_weights_of_repeated_and_null_ids_stay_apart(spark, fitted):
    _, vocabulary = fitted
    rows = [(1, "cat"), (1, "cat"), (1, "cat dog"), (None, "dog"), (None, "cat cat"), (2, ""), (3, None)]
    stored = V.bags(V.tokens(spark.createDataFrame(rows, "id long, text string")))
    got = [(r["id"], r["term"], round(r["weight"], 9)) for r in V.term_weights(stored, vocabulary).collect()]
    single = [(1, "cat", 1.0), (1, "cat", 1.0), (None, "cat", 1.0), (None, "dog", 1.0)]
    assert [g for g in sorted(got, key=str) if g[2] == 1.0] == sorted(single, key=str)
    assert len(got) == 6 and sum(w * w for i, _, w in got if i == 1) == pytest.approx(3.0)
    assert V.term_weights(stored.limit(0), vocabulary).count() == 0


def test_long_weights_move_bags_once_and_collect_nothing(fitted):
    bags, vocabulary = fitted
    plan = V.term_weights(bags, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "collect_" not in plan


def test_lemma_bags_equal_the_bags_of_lemmatized_tokens(spark):
    rows = [(1, "cats cat Dogs fur"), (1, "cats"), (1, "cats"), (None, "fur furs"), (2, ""), (2, ""), (3, None)]
    table = V.tokens(spark.createDataFrame(rows, "id long, text string"))
    lemmas = spark.createDataFrame([("cats", "Cat"), ("dogs", "dog"), ("furs", "fur")], "surface string, lemma string")

    def listed(found):
        return sorted(((r["id"], [(e["term"], e["tf"]) for e in r["bag"]]) for r in found.collect()), key=str)

    expected = listed(V.bags(V.lemmatize(table, lemmas)))
    assert listed(V.lemma_bags(V.bags(table), lemmas)) == expected
    assert (1, [("cat", 2), ("dog", 1), ("fur", 1)]) in expected and len(expected) == 7
    texts = spark.createDataFrame(rows, "id long, text string")
    assert listed(V.stored_bags(texts, lemmas=lemmas)) == expected
    assert listed(V.lemma_bags(V.bags(table), lemmas.limit(0))) == listed(V.bags(table))
    assert V.lemma_bags(V.bags(table).limit(0), lemmas).count() == 0


def test_lemmas_beyond_the_broadcast_limit_give_the_same_bags(spark, monkeypatch):
    table = V.bags(V.tokens(spark.createDataFrame([(1, "cats cat"), (2, "")], "id long, text string")))
    lemmas = spark.createDataFrame([("cats", "cat")], "surface string, lemma string")
    monkeypatch.setattr(V, "table_bytes", lambda _: 1 << 40)
    found = {r["id"]: [(e["term"], e["tf"]) for e in r["bag"]] for r in V.lemma_bags(table, lemmas).collect()}
    assert found == {1: [("cat", 2)], 2: []}
