import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import factors, vectors as V
from textloom.session import materialize


@pytest.fixture(scope="module")
def bags(spark):
    rows = [(i % 40, " ".join(f"w{chr(97 + (i * j) % 26)}{chr(97 + j % 7)}" for j in range(i % 9))) for i in range(80)]
    return V.stored_bags(spark.createDataFrame(rows, "id long, text string").repartition(3))


def test_products_go_by_block_and_send_a_term_once(spark, bags, monkeypatch):
    vocabulary = V.fit_vocabulary(bags)
    rows = factors.numbered(V.sparse_rows(bags, vocabulary, "count"))
    monkeypatch.setattr(factors, "ROWS_PER_BLOCK", 3)
    blocks = factors.blocks_of(rows)
    places = blocks.cells.select("_block", F.spark_partition_id().alias("p")).distinct().collect()
    assert len({r["p"] for r in places}) == len({r["_block"] for r in places}) == len(places) > 8
    assert blocks.terms.count() == blocks.terms.distinct().count()
    table = materialize(vocabulary.table.selectExpr("term_id", "1D + term_id AS c0", "0.5D AS c1"), "factor")
    n = vocabulary.n_terms
    dense = {r["_row"]: np.bincount(r["indices"], r["values"], n) for r in rows.collect()}
    factor = np.stack([1.0 + np.arange(n), np.full(n, 0.5)], axis=1)
    x = np.array([dense[i] for i in sorted(dense)])
    got = {r["id"]: (r["c0"], r["c1"]) for r in factors.times_terms(blocks, table, 2).collect()}
    assert all(got.get(i, (0, 0)) == pytest.approx(tuple(dense[i] @ factor)) for i in dense)
    back = factors.gram_times(blocks, table, 2).orderBy("term_id").collect()
    assert np.array([(r["c0"], r["c1"]) for r in back]) == pytest.approx(x.T @ (x @ factor))
