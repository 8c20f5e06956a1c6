import numpy as np
import pytest

from textloom.operators import nmf, reduce, topics
from textloom.operators import vectors as V
from textloom.session import materialize


@pytest.fixture(scope="module")
def prepared(spark, small_corpus):
    bags = V.stored_bags(small_corpus)
    vocabulary = V.fit_vocabulary(bags)
    rows = materialize(V.sparse_rows(bags, vocabulary), "rows")
    dense = np.zeros((26, vocabulary.n_terms))
    for r in rows.collect():
        dense[r["id"], r["indices"]] = r["values"]
    return bags, vocabulary, rows, dense


def as_numpy(df, key, names):
    return np.array([[r[c] for c in names] for r in df.orderBy(key).collect()])


def test_nmf_error_falls_and_matches_the_factors(prepared):
    _, vocabulary, rows, dense = prepared
    model = nmf.fit_nmf(rows, vocabulary.n_terms, k=2, max_iter=6)
    names = ["c0", "c1"]
    w, h = as_numpy(model.documents, "id", names), as_numpy(model.terms, "term_id", names)
    assert w.shape == (26, 2) and h.shape == (vocabulary.n_terms, 2)
    assert (w >= 0).all() and (h >= 0).all()
    assert all(b <= a + 1e-9 for a, b in zip(model.errors, model.errors[1:], strict=False))
    assert model.error == pytest.approx(np.linalg.norm(dense - w @ h.T))
    again = nmf.fit_nmf(rows, vocabulary.n_terms, k=2, max_iter=2)
    assert again.errors == pytest.approx(model.errors[:2])
    resumed = nmf.fit_nmf(rows, vocabulary.n_terms, k=2, max_iter=1, start_terms=model.terms)
    assert resumed.error < model.errors[0]
    new = as_numpy(nmf.transform_nmf(model, rows), "id", names)
    assert new.shape == w.shape and (new[24] == 0).all()
    assert np.linalg.norm(dense - new @ h.T) <= model.error + 1e-3
    top = topics.top_topic_words(nmf.topic_terms(model), vocabulary, 3)
    assert top.count() == 6


def test_sparse_pca_matches_the_eigen_decomposition(prepared):
    _, vocabulary, rows, dense = prepared
    result = reduce.sparse_pca(rows, vocabulary.n_terms, k=2, extra=4)
    centred = dense - dense.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(centred.T))
    assert result.variances == pytest.approx(values[::-1][:2], rel=1e-4)
    points = as_numpy(result.points, "id", ["pc1", "pc2"])
    expected = centred @ vectors[:, ::-1][:, :2]
    assert np.abs(points) == pytest.approx(np.abs(expected), abs=5e-3)
    loadings = as_numpy(result.loadings, "term_id", ["c0", "c1"])
    assert (loadings[np.abs(loadings).argmax(axis=0), [0, 1]] > 0).all()


def test_dense_pca_is_centred(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(50, 4)) @ np.diag([3, 2, 1, 0.5]) + 7
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(data)], "id long, vector array<double>")
    points = as_numpy(reduce.dense_pca(df), "id", ["pc1", "pc2"])
    values = np.linalg.eigvalsh(np.cov(data.T))[::-1]
    assert points.mean(axis=0) == pytest.approx([0, 0], abs=1e-9)
    assert points.var(axis=0, ddof=1) == pytest.approx(values[:2])


def test_non_negative_weights_are_the_optimum():
    pick = np.random.default_rng(2)
    for k in (1, 2, 5, 8):
        h = np.abs(pick.standard_normal((k, 40))) * (pick.random((k, 40)) < 0.4)
        if k > 2:
            h[1] = h[0]  # a singular system
        gram = h @ h.T
        b = np.r_[pick.standard_normal((60, 40)), np.abs(pick.standard_normal((60, 40))), np.zeros((2, 40))] @ h.T
        w = nmf.non_negative(b, gram)
        gradient = w @ gram - b
        assert (w >= 0).all() and (gradient > -1e-7).all() and np.abs(w * gradient).max() < 1e-7
    assert nmf.non_negative(np.empty((0, 3)), np.eye(3)).shape == (0, 3)


def test_rows_that_repeat_an_id_keep_weights_of_their_own(spark, prepared):
    _, vocabulary, rows, _ = prepared
    model = nmf.fit_nmf(rows, vocabulary.n_terms, k=2, max_iter=20)
    pets, cars = (rows.filter(f"id = {i}") for i in (1, 13))
    alone = {r["category"]: (r["c0"], r["c1"]) for r in nmf.transform_nmf(model, pets.unionByName(cars)).collect()}
    same = pets.unionByName(cars).unionByName(pets).selectExpr("CAST(NULL AS long) AS id", "category", "indices", "values")
    got = nmf.transform_nmf(model, same).collect()
    assert sorted(r["category"] for r in got) == ["cars", "pets", "pets"]
    assert all((r["c0"], r["c1"]) == pytest.approx(alone[r["category"]]) for r in got)
    one_id = rows.selectExpr("7L AS id", "category", "indices", "values")
    for frame in (one_id, rows):
        fitted = nmf.fit_nmf(frame, vocabulary.n_terms, k=2, max_iter=5)
        points = reduce.sparse_pca(frame, vocabulary.n_terms)
        assert fitted.documents.count() == points.points.count() == 26
        assert fitted.errors == pytest.approx(nmf.fit_nmf(rows, vocabulary.n_terms, k=2, max_iter=5).errors)
    assert (points.residuals < 1e-2).all()
    checked = nmf.optimality(model, rows, nmf.transform_nmf(model, rows).drop("category"))
    assert checked.filter("optimal").count() == checked.count() == 26
    wrong = nmf.transform_nmf(model, rows).drop("category").selectExpr("id", "c0 + 1 AS c0", "c1")
    assert nmf.optimality(model, rows, wrong).filter("NOT optimal").count() == 26
