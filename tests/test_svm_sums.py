import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from textloom.operators import svm


@pytest.fixture(scope="module")
def counted(spark):
    """Counts of very different size, some features in every row."""
    pick = np.random.default_rng(3)
    scale = np.r_[1000, 300, np.ones(38)]
    x = pick.poisson(1.0, (400, 40)) * scale
    y = (x[:, 2] + x[:, 3] > x[:, 4] + x[:, 5] + 0.5).astype(float)
    rows = [(Vectors.sparse(40, {i: float(v) for i, v in enumerate(r) if v}), float(c)) for r, c in zip(x, y)]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(4).persist()


def test_the_driver_gets_every_sum_once(counted, monkeypatch):
    """Sums are added up by slice before they are collected, not sent once by every task."""
    got = []
    made = np.frombuffer
    whole = svm.summed(counted, 40, lambda b, y: b.back(y[:, None]), (1, 41))
    monkeypatch.setattr(svm, "SLICE", 16)
    monkeypatch.setattr(svm.np, "frombuffer", lambda data, *kind: got.append(len(data)) or made(data, *kind))
    sliced = svm.summed(counted, 40, lambda b, y: b.back(y[:, None]), (1, 41))
    assert sliced == pytest.approx(whole)
    assert len(got) == 2 * 3 and sum(got) <= 41 * (8 + 4)


def test_products_read_only_the_rows_inside_a_margin(spark, monkeypatch):
    """Conjugate gradients pass over the rows of the margins, not over all rows in every step."""
    x = np.r_[np.linspace(-50, -5, 300), np.linspace(-1, 1, 21), np.linspace(5, 50, 300)]
    rows = spark.createDataFrame([(Vectors.dense([float(v)]), float(v > 0)) for v in x], ["features", "label"])
    read, whole = [], svm.Rows.summed

    def counted_pass(self, part, shape):
        read.append(int(whole(self, lambda block, given: np.array([block.rows]), (1,))[0]))
        return whole(self, part, shape)

    monkeypatch.setattr(svm.Rows, "summed", counted_pass)
    fit = svm.fit_squared_hinge(rows.repartition(3), 1, 2)
    assert fit.converged and fit.gradient <= 1e-4
    assert read[0] == len(x) and 0 < min(read) < 60


def test_rows_are_kept_in_pieces_and_added_in_place(counted, monkeypatch):
    """A task holds a few entries at a time, and its sums once."""
    shares = np.array([[0.3, -2.0]])
    whole = svm.summed(counted, 40, lambda b, y: b.back(y[:, None] * shares + 1), (2, 41))
    before = svm.fit_squared_hinge(counted, 40, 2)
    monkeypatch.setattr(svm, "PIECE", 100)
    rows = svm.Rows.of(counted, 40)
    pieces = [len(r["entries"]) // 8 for r in rows.table.select("entries").collect()]
    assert max(pieces) < 100 + 40 and len(pieces) > 50
    monkeypatch.setattr(svm.Block, "back", None)
    added = rows.summed(svm.Adds(lambda b, y, total: b.add_back(total, y * shares + 1)), (2, 41))
    assert added == pytest.approx(whole, rel=1e-12)
    # The gradient's tolerance follows the large counts, so rounding shows in what is minimised.
    fit = svm.fit_squared_hinge(counted, 40, 2)
    x, y = map(np.array, zip(*((r["features"].toArray(), r["label"]) for r in counted.collect())))

    def objective(weights):
        slack = np.maximum(0, 1 - np.where(y == 1, 1, -1) * (x @ weights[:-1] + weights[-1]))
        return weights @ weights / 2 + (slack**2).sum()

    assert fit.converged and objective(fit.weights[1]) == pytest.approx(objective(before.weights[1]), rel=1e-2)
    assert fit.gradient <= 1e-4
