import math

import numpy as np
import pytest

from textloom.operators import lda, topics
from textloom.operators import vectors as V
from textloom.operators.factors import columns
from textloom.session import materialize


@pytest.fixture(scope="module")
def counted(spark, small_corpus):
    bags = V.stored_bags(small_corpus)
    vocabulary = V.fit_vocabulary(bags)
    return vocabulary, materialize(V.sparse_rows(bags, vocabulary, "count"), "rows")


def table(model):
    return np.array([[r[c] for c in columns(model.k)] for r in model.terms.orderBy("term_id").collect()])


def test_special_functions():
    x = np.array([1e-3, 0.1, 0.5, 1.0, 2.5, 7.0, 40.0, 1e6])
    assert lda.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)
    h = 1e-5 * x
    slope = [(math.lgamma(v + d) - math.lgamma(v - d)) / (2 * d) for v, d in zip(x, h)]
    assert lda.digamma(x) == pytest.approx(slope, rel=1e-5, abs=1e-5)
    assert lda.digamma(np.array([1.0])) == pytest.approx([-0.5772156649015329])


def test_bound_rises_and_topics_part_the_categories(counted):
    vocabulary, rows = counted
    model = lda.fit_lda(rows, vocabulary.table, vocabulary.n_terms, k=2, max_iter=30, inner_tol=1e-8)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(model.bounds, model.bounds[1:]))
    assert model.converged and model.terms.count() == vocabulary.n_terms
    found = {r["id"]: r for r in lda.infer(rows, model).collect()}
    assert len(found) == 26 and all(sum(r["vector"]) == pytest.approx(1) for r in found.values())
    assert found[24]["vector"] == [0.5, 0.5] and found[24]["bound"] == 0
    sides = {c: {int(np.argmax(r["vector"])) for i, r in found.items() if r["category"] == c and i < 24} for c in ("pets", "cars")}
    assert all(len(s) == 1 for s in sides.values()) and sides["pets"] != sides["cars"]
    quality = lda.quality(rows, model)
    assert quality["log_likelihood"] < 0 < quality["perplexity"]
    terms = lda.topic_terms(model)
    assert terms.groupBy("topic").sum("weight").toPandas()["sum(weight)"].tolist() == pytest.approx([1, 1])
    assert topics.top_topic_words(terms, vocabulary).count() == 16


def test_every_step_reads_all_documents_however_they_are_dealt(counted, monkeypatch):
    vocabulary, rows = counted
    fits = []
    for parts, at_once in ((1, 5), (7, 1 << 17)):
        monkeypatch.setattr(lda, "ENTRIES_AT_ONCE", at_once)
        dealt = rows.repartition(parts)
        fits.append(table(lda.fit_lda(dealt, vocabulary.table, vocabulary.n_terms, k=3, max_iter=4)))
    assert fits[0] == pytest.approx(fits[1], rel=1e-9)
    # What a step hands out is every occurrence of every term, on top of the prior.
    total = sum(sum(r["values"]) for r in rows.collect())
    assert fits[0].sum() == pytest.approx(total + fits[0].size / 3)


def test_large_topic_tables_are_joined_by_shuffle(counted, monkeypatch):
    vocabulary, rows = counted
    small = lda.fit_lda(rows, vocabulary.table, vocabulary.n_terms, k=2, max_iter=2)
    monkeypatch.setattr(lda, "BROADCAST_BYTES", 1)
    large = lda.fit_lda(rows, vocabulary.table, vocabulary.n_terms, k=2, max_iter=2)
    assert table(small) == pytest.approx(table(large), rel=1e-9)


def test_rows_that_repeat_an_id_keep_their_own_topics(spark, counted):
    vocabulary, rows = counted
    model = lda.fit_lda(rows, vocabulary.table, vocabulary.n_terms, k=2, max_iter=10)
    pets, cars = (rows.filter(f"id = {i}") for i in (1, 13))
    same = pets.unionByName(cars).unionByName(pets).selectExpr("CAST(NULL AS long) AS id", "category", "indices", "values")
    alone = {r["category"]: r["vector"] for r in lda.infer(pets.unionByName(cars), model).collect()}
    got = lda.infer(same, model).collect()
    assert sorted(r["category"] for r in got) == ["cars", "pets", "pets"]
    assert all(r["vector"] == pytest.approx(alone[r["category"]]) for r in got)


def test_no_rows(counted):
    vocabulary, rows = counted
    model = lda.fit_lda(rows.limit(0), vocabulary.table, vocabulary.n_terms, k=2, max_iter=2)
    assert lda.infer(rows.limit(0), model).count() == 0
    assert lda.quality(rows.limit(0), model)["perplexity"] > 0


def test_documents_solved_in_groups_equal_each_alone(monkeypatch):
    pick = np.random.default_rng(3)
    lengths = np.r_[0, pick.integers(1, 60, 80), 900, 0]
    place = np.concatenate([pick.choice(1000, n, replace=False) for n in lengths])
    x, factor = pick.integers(0, 4, len(place)).astype(float), pick.gamma(0.2, 1, (3, 1000)) + 1e-9
    factor[:, 5] = 0  # a term without a topic row takes no part
    alpha = 0.4
    for at_once in (1, 200, 1 << 15):
        monkeypatch.setattr(lda, "ENTRIES_AT_ONCE", at_once)
        documents = lda.Documents(lengths, place, x, factor)
        gamma, bounds, weight = documents.solved(alpha, 100, 1e-4)
        sums, ends = np.zeros(factor.shape), np.cumsum(lengths)
        for i, (end, n) in enumerate(zip(ends, lengths)):
            own = slice(end - n, end)
            kept = (x[own] > 0) & (factor[0, place[own]] > 0)
            terms, count = place[own][kept], x[own][kept]
            if not len(terms):
                assert bounds[i] == 0 and gamma[i].tolist() == [alpha] * 3
                continue
            now = np.ones(3)
            for _ in range(100):
                share = np.exp(lda.digamma(now) - lda.digamma(now.sum()))
                new = alpha + share * (factor[:, terms] @ (count / (share @ factor[:, terms])))
                rest, now = np.abs(new - now).mean() < 1e-4, new
                if rest:
                    break
            assert gamma[i] == pytest.approx(now, rel=1e-9)
            mixed = np.exp(lda.digamma(now) - lda.digamma(now.sum()))[:, None] * factor[:, terms]
            sums[:, terms] += mixed * count / mixed.sum(axis=0)
        assert np.array(list(documents.shares(gamma, weight))) == pytest.approx(sums, rel=1e-9)
        groups = list(lda.alike(documents.lengths))
        assert sorted(np.concatenate(groups)) == np.flatnonzero(documents.lengths).tolist()
        assert all(len(g) * documents.lengths[g].max() <= max(at_once, documents.lengths[g].max()) for g in groups)
        assert all(documents.lengths[g].max() <= 1.25 * documents.lengths[g].min() + 16 for g in groups)
