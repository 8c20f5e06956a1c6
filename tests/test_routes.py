"""The packed steps of the factorization against dense ones."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import factors, nmf, routes
from textloom.session import SHUFFLE_CLEANUP, materialize, shared_dir


@pytest.fixture(scope="module")
def dense():
    pick = np.random.default_rng(4)
    return np.round(pick.random((60, 45)) * (pick.random((60, 45)) < 0.15), 3)


@pytest.fixture(scope="module")
def rows(spark, dense):
    """Ids repeat or are null, one row is empty and stays, one names a term twice."""
    dense[11] = 0
    data = [(i % 20 or None, np.flatnonzero(r).tolist(), r[r > 0].tolist()) for i, r in enumerate(dense)]
    data[3][1].append(7), data[3][2].append(0.5)
    dense[3, 7] += 0.5
    frame = spark.createDataFrame(data, "id long, indices array<int>, values array<double>")
    return materialize(frame.coalesce(1), "rows")


def factor(table, key, k=3):
    return np.array([[r[f"c{i}"] for i in range(k)] for r in table.orderBy(key).collect()])


@pytest.fixture
def packed(rows, monkeypatch):
    monkeypatch.setattr(routes, "ENTRIES_PER_BLOCK", 30)
    monkeypatch.setattr(routes, "PIECE", 9)
    numbered = factors.numbered(rows)
    return numbered, routes.routes_of(numbered)


def starts(packed):
    numbered, x = packed
    some = [f"0.1D + ({{0}} * {7 + i} % 11) / 10 AS c{i}" for i in range(3)]
    filled = numbered.filter(F.size("indices") > 0).selectExpr("_row", *(s.format("_row") for s in some))
    terms = routes.term_ids(x).selectExpr("term_id", *(s.format("term_id") for s in some))
    return materialize(filled, "w"), materialize(terms, "h")


def test_a_step_is_that_of_the_dense_matrix(packed, dense):
    _, x = packed
    w, h = starts(packed)
    kept, used = dense[dense.any(axis=1)], np.flatnonzero(dense.any(axis=0))
    dense_w, dense_h = factor(w, "_row"), factor(h, "term_id")
    assert [r["term_id"] for r in h.orderBy("term_id").collect()] == used.tolist()
    found = nmf.update(x, routes.row_blocks(x, w, 3), routes.term_slices(x, h, 3), 3, dense_h.T @ dense_h)
    new_w = dense_w * (kept[:, used] @ dense_h) / (dense_w @ dense_h.T @ dense_h)
    assert factor(routes.numbered_rows(x, nmf.updated_documents(found), 3), "id") == pytest.approx(new_w)
    w_gram = nmf.documents_gram(found, 3)
    assert w_gram == pytest.approx(new_w.T @ new_w)
    new_h = dense_h * (kept[:, used].T @ new_w) / (dense_h @ new_w.T @ new_w)
    after = nmf.update_terms(found, 3, w_gram)
    assert factor(routes.term_rows(x, after, 3), "term_id") == pytest.approx(new_h)
    assert sum(r["shared"] for r in after.collect()) == pytest.approx(np.sum((kept[:, used].T @ new_w) * new_h))


def test_factor_rows_travel_in_messages_not_one_by_one(packed, dense):
    """A slice sends a block one message with a row per term that the block needs."""
    _, x = packed
    _, h = starts(packed)
    sent = routes.sent(x, routes.term_slices(x, h, 3), 3)
    got = sent.select("slice", "of", F.length("part").alias("bytes")).collect()
    blocks = {r["_block"] for r in x.cells.select("_block").distinct().collect()}
    assert len(blocks) > 8 and x.cells.count() > len(blocks)
    assert len(got) == len({(r["slice"], r["of"]) for r in got}) and {r["of"] for r in got} == blocks
    assert np.count_nonzero(dense) > sum(r["bytes"] for r in got) // 24 > dense.any(axis=0).sum()


def test_no_entries_at_all(spark):
    rows = materialize(spark.createDataFrame([(1, [], []), (2, [], [])], "id long, indices array<int>, values array<double>"), "rows")
    model = nmf.fit_nmf(rows, 5, k=2, max_iter=2)
    assert model.documents.orderBy("id").collect() == [(1, 0.0, 0.0), (2, 0.0, 0.0)] and model.errors[-1] == 0
    assert model.terms.count() == 0


def folders(spark, name):
    path = f"{shared_dir(spark)}/textloom"
    return {f for f in os.listdir(path) if f.startswith(name)}


def test_a_fit_leaves_only_its_last_step_on_disk(spark, rows):
    before, shuffles = folders(spark, "nmf-s"), spark.conf.get(SHUFFLE_CLEANUP)
    model = nmf.fit_nmf(rows, 45, k=3, max_iter=4, tol=0.0)
    assert len(model.errors) == 4
    assert len(folders(spark, "nmf-s") - before) == 1
    assert model.terms.count() and model.documents.count() == rows.count()
    assert spark.conf.get(SHUFFLE_CLEANUP) == shuffles


def test_blocks_are_packed_piece_by_piece(packed, dense):
    """No piece holds more than one document beyond its limit, and places lead back to the terms."""
    _, x = packed
    kept = dense[dense.any(axis=1)]
    found, rows = np.zeros(dense.shape), 0
    routed = [r.asDict() for r in x.routes.collect()]
    own = {r["slice"]: np.frombuffer(r["at"], np.int64) for r in routed if r["of"] == -1}
    for block in x.numbers:
        asked = {r["slice"]: own[r["slice"]][np.frombuffer(r["at"], np.int32)] for r in routed if r["of"] == block}
        terms = np.concatenate([asked[s] for s in x.numbers if s in asked] or [np.zeros(0, np.int64)])
        cells = {r["piece"]: r for r in x.cells.filter(F.col("_block") == block).collect()}
        stands = np.frombuffer(cells.pop(-1)["at"], np.int32) if cells else None
        for r in cells.values():
            lengths, at, values = (np.frombuffer(r[c], t) for c, t in (("lengths", np.int32), ("at", np.int32), ("entries", float)))
            assert len(at) == lengths.sum() == len(values) and len(at) - lengths[-1] < 9 + dense.shape[1]
            for n, t, v in zip(np.repeat(np.arange(len(lengths)), lengths) + rows, terms[stands[at]], values):
                found[n, t] += v
            rows += len(lengths)
    assert rows == len(kept)
    assert sorted(map(tuple, np.round(found[:rows], 6))) == sorted(map(tuple, np.round(kept, 6)))
