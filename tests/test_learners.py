"""The squared-hinge SVM and the classifier over encoded sequences against plain versions."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from textloom.operators import bayes, classify, svm
from textloom.operators import vectors as V


@pytest.fixture(scope="module")
def points(spark):
    """Three overlapping classes, as sparse and dense vectors, one of them empty."""
    pick = np.random.default_rng(3)
    x = pick.standard_normal((150, 6)) * (pick.random((150, 6)) < 0.6)
    label = (x @ pick.standard_normal((6, 3)) + pick.standard_normal((150, 3))).argmax(axis=1)
    x[7] = 0
    vectors = [
        Vectors.dense(r) if i % 3 == 0 else Vectors.sparse(6, np.flatnonzero(r).tolist(), r[r != 0].tolist())
        for i, r in enumerate(x)
    ]
    rows = [(i, f"class{k}", float(k), v) for i, (k, v) in enumerate(zip(label.tolist(), vectors))]
    return x, label, spark.createDataFrame(rows, ["id", "category", "label", "features"])


def objective(w, x, y, c):
    slack = np.maximum(0, 1 - y * (np.c_[x, np.ones(len(x))] @ w))
    return w @ w / 2 + c * (slack**2).sum(), w - 2 * c * np.c_[x, np.ones(len(x))].T @ (slack * y)


@pytest.mark.parametrize("c", [0.1, 10.0])
def test_newton_reaches_the_minimum(points, c):
    x, label, frame = points
    fit = svm.fit_squared_hinge(frame.select("features", "label").repartition(5), 6, 3, c=c, tol=1e-6)
    assert fit.converged and fit.gradient <= 1e-6 and fit.steps < 30
    for k, w in enumerate(fit.weights):
        y = np.where(label == k, 1.0, -1.0)
        value, gradient = objective(w, x, y, c)
        assert np.linalg.norm(gradient) <= 1e-5 * np.linalg.norm(objective(np.zeros(7), x, y, c)[1])
        pick = np.random.default_rng(k)
        assert all(objective(w + 1e-3 * pick.standard_normal(7), x, y, c)[0] > value for _ in range(20))


def test_newton_model_predicts_and_tells_its_limit(points, monkeypatch):
    x, label, frame = points
    fitted = classify.train("svc", frame, 6, classify.newton_svc())
    fit = fitted.model.stages[0].fit
    margins = np.c_[x, np.ones(len(x))] @ fit.weights.T
    got = {r["id"]: r["p"] for r in classify.predict(fitted, frame, "train").collect()}
    assert got == {i: f"class{k}" for i, k in enumerate(margins.argmax(axis=1))}
    assert fitted.converged and fitted.steps == fit.steps
    cut = classify.train("svc", frame, 6, classify.newton_svc(tol=1e-12, max_steps=1))
    assert cut.steps == 1 and cut.converged is False
    monkeypatch.setattr(svm, "DIRECT_TASKS", 2)  # sums of many tasks are added up in a second stage
    again = svm.fit_squared_hinge(frame.select("features", "label").repartition(9), 6, 3)
    assert again.weights == pytest.approx(fit.weights, abs=1e-6)


def test_other_models_tell_their_steps(points):
    _, _, frame = points
    told = {
        name: classify.train(name, frame, 6, factory)
        for name, factory in (
            ("cut", classify.logistic(2)),
            ("whole", classify.logistic(200)),
            ("mlp", classify.perceptron((3,), 5)),
            ("hinge", classify.linear_svc(max_iter=3)),
        )
    }
    assert told["cut"].steps == 2 and told["cut"].converged is False
    assert told["whole"].converged and told["mlp"].steps and told["hinge"].converged is False


def naive(train, held_out, size, alpha=1.0):
    docs, words = Counter(), defaultdict(Counter)
    for label, ids in train:
        docs[label] += 1
        words[label].update(i for i in ids if i >= 4)
    out = []
    for _, ids in held_out:
        joint = [
            (math.log(docs[k] / len(train))
             + sum(math.log((words[k][i] + alpha) / (sum(words[k].values()) + alpha * size)) for i in ids if i >= 4), -k)
            for k in sorted(docs)
        ]
        best = max(joint)
        out.append((-best[1], round(best[0], 9)))
    return out


def test_sequence_bayes(spark):
    pick = np.random.default_rng(5)
    rows = [(int(k), [2, *pick.integers(1 + 10 * k, 30 + 10 * k, pick.integers(0, 12)).tolist(), 3]) for k in pick.integers(0, 3, 80)]
    held_out = [*rows[:20], (0, [2, 3]), (1, [2, 1, 1, 3]), (2, [2, 99, 99, 98, 3])]

    def frame(source):
        padded = [(i % 5 or None, ids + [0] * (20 - len(ids)), [1] * len(ids) + [0] * (20 - len(ids)), k) for i, (k, ids) in enumerate(source)]
        return spark.createDataFrame(padded, "id long, input_ids array<int>, attention_mask array<int>, label long")

    unlabelled = frame(rows[:3]).selectExpr("id", "input_ids", "attention_mask", "CAST(NULL AS long) AS label")
    model = bayes.fit_sequence_bayes(frame(rows).unionByName(unlabelled).repartition(4), 60)
    got = bayes.score_sequences(frame(held_out), model).collect()
    assert sorted((r["predicted"], round(r["score"], 9)) for r in got) == sorted(naive(rows, held_out, 60))
    twice = frame([held_out[0]] * 3)  # equal rows stay three, each with its own score
    assert {(r["predicted"], round(r["score"], 9)) for r in bayes.score_sequences(twice, model).collect()} == {naive(rows, held_out, 60)[0]}
    assert bayes.score_sequences(twice, model).count() == 3
    assert bayes.score_sequences(frame([]), model).count() == 0
    with pytest.raises(ValueError):
        bayes.score_sequences(twice, bayes.fit_sequence_bayes(frame([]), 60))


def test_mean_vectors_tell_repeated_ids_apart(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "term string, vector array<float>")
    rows = [(1, ["a", "a"]), (1, ["b"]), (2, ["b"]), (None, ["a", "b"]), (None, ["a", "b"]), (3, []), (3, ["x"])]
    bags = V.bags(spark.createDataFrame(rows, "id long, tokens array<string>"))
    got = sorted((str(r["id"]), r["vector"]) for r in V.mean_vectors(bags, vectors, 2).collect())
    assert got == [("1", [0, 1]), ("1", [1, 0]), ("2", [0, 1]), ("3", [0, 0]), ("3", [0, 0]), ("None", [0.5, 0.5]), ("None", [0.5, 0.5])]
