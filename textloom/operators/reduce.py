"""Principal components of document vectors, sparse over terms or short and dense."""

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.factors import (
    ROW,
    blocks_of,
    columns,
    cross_sums,
    gram,
    gram_sums,
    gram_times,
    hash_uniform,
    numbered,
    renamed,
    right_multiply,
    symmetric,
    times_terms,
    with_keys,
)
from textloom.operators.vectors import weights
from textloom.session import materialize


@dataclass(frozen=True)
class SparsePca:
    """``points`` (keys, pc1..), the loadings per term and the variances of the components.

    ``residuals`` holds |C v - variance v| of each component v as a share of the largest variance,
    C being the covariance.
    """

    points: DataFrame
    loadings: DataFrame
    variances: np.ndarray
    converged: bool
    residuals: np.ndarray


def _orthonormal(cross: np.ndarray) -> np.ndarray:
    """The matrix that makes columns with Gram ``cross`` orthonormal; flat directions vanish."""
    values, vectors = np.linalg.eigh(cross)
    keep = values > values.max() * 1e-12 if values.max() > 0 else np.zeros_like(values, bool)
    scale = np.where(keep, 1.0 / np.sqrt(np.where(keep, values, 1.0)), 0.0)
    return vectors * scale


def sparse_pca(
    rows: DataFrame,
    n_terms: int,
    k: int = 2,
    extra: int = 6,
    max_iter: int = 40,
    tol: float = 1e-6,
    seed: int = 42,
) -> SparsePca:
    """Leading components of the centred document-term matrix over all its terms.

    Block power iteration: the covariance is applied as XᵀX V - s (sᵀV) / n with the column
    sums s, so neither the covariance nor a centred (dense) matrix is ever built, and the
    vocabulary need not be cut. ``extra`` more directions than wanted speed up convergence; ``converged`` tells whether ``tol`` was reached.
    """
    p = k + extra
    rows = numbered(rows)
    n_docs = rows.count()
    x = blocks_of(rows)
    entries = weights(rows.select("indices", "values"))
    sums = materialize(entries.groupBy("term_id").agg(F.sum("weight").alias("s")), "column-sums")
    starts = [f"{hash_uniform(seed, 'term_id', i)} - 0.5D AS {c}" for i, c in enumerate(columns(p))]
    v = sums.selectExpr("term_id", "s", *starts)
    v = _rotated(materialize(v, "pca-start"), _orthonormal(gram(v, p)), p)
    before, converged = None, False
    for _ in range(max_iter):
        along = _column_means(v, p, n_docs)
        product = gram_times(x, v.drop("s"), p)
        centred = [
            f"{z} - s * {float(m)!r}D AS {z}"
            for z, m in zip(columns(p, "z"), along, strict=True)
        ]
        joined = renamed(product, "term_id", p, "z").join(v, "term_id")
        applied = materialize(
            joined.selectExpr("term_id", "s", *columns(p), *centred), "pca-terms"
        )
        cross_values, spread_values = applied.agg(
            cross_sums(p, "c", "z"), gram_sums(p, "z")
        ).first()
        cross = np.array(cross_values).reshape(p, p)
        spread = symmetric(spread_values, p)
        ritz, turn = np.linalg.eigh((cross + cross.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis = _rotated(applied, turn[:, :k], p)
        if before is not None and np.all(np.abs(ritz[:k] - before) <= tol * ritz[0]):
            converged = True
            break
        before = ritz[:k]
        v = _rotated(applied, _orthonormal(spread), p, "z")
    loadings = _signed(materialize(basis, "pca-loadings"), k)
    means = _column_means(loadings, k, n_docs)
    scores = times_terms(x, loadings.drop("s"), k)
    keys = [c for c in rows.columns if c not in (ROW, "indices", "values")]
    points = with_keys(rows, scores).select(
        *keys,
        *[
            (F.coalesce(F.col(c), F.lit(0.0)) - float(m)).alias(f"pc{i + 1}")
            for i, (c, m) in enumerate(zip(columns(k), means, strict=True))
        ],
    )
    points = materialize(points, "pca-points")
    x.unpersist()
    # The components are orthonormal combinations ``turn`` of V, and CV has the products ``spread``.
    squares = np.einsum("ik,ij,jk->k", turn[:, :k], spread, turn[:, :k]) - ritz[:k] ** 2
    residuals = np.sqrt(np.maximum(squares, 0)) / max(ritz[0], 1e-300)
    return SparsePca(points, loadings.drop("s"), ritz[:k] / max(1, n_docs - 1), converged, residuals)


def _rotated(table: DataFrame, matrix: np.ndarray, p: int, prefix: str = "c") -> DataFrame:
    names = columns(matrix.shape[1])
    turned = right_multiply(matrix, prefix)
    return table.selectExpr(
        "term_id", "s", *[f"{t} AS {c}" for t, c in zip(turned, names, strict=True)]
    )


def _column_means(table: DataFrame, p: int, n_docs: int) -> np.ndarray:
    """The mean document times the factor: sᵀV / n."""
    sums = F.expr("array(" + ", ".join(f"coalesce(sum(s * {c}), 0D)" for c in columns(p)) + ")")
    return np.array(table.agg(sums).first()[0]) / max(1, n_docs)


def _signed(loadings: DataFrame, k: int) -> DataFrame:
    """Turn every component so that its largest loading is positive."""
    tops = [F.expr(f"max_by({c}, struct(abs({c}), -term_id))") for c in columns(k)]
    signs = [-1.0 if top is not None and top < 0 else 1.0 for top in loadings.agg(*tops).first()]
    return _rotated(loadings, np.diag(signs), k)


def dense_pca(df: DataFrame, vector: str = "vector", k: int = 2) -> DataFrame:
    """(other columns, pc1..) of a short array column (topic weights, word-vector means)."""
    others = [c for c in df.columns if c != vector]
    features = df.select(*others, array_to_vector(vector).alias("_raw"))
    scaler = StandardScaler(
        inputCol="_raw", outputCol="_centred", withMean=True, withStd=False
    ).fit(features)
    centred = scaler.transform(features)
    model = PCA(k=k, inputCol="_centred", outputCol="_points").fit(centred)
    points = vector_to_array("_points")
    return model.transform(centred).select(
        *others, *[F.get(points, F.lit(i)).alias(f"pc{i + 1}") for i in range(k)]
    )


def category_points(points: dict[str, DataFrame]) -> DataFrame:
    """(feature_set, id, category, pc1, pc2): one table for all feature sets."""
    parts = [
        table.select(F.lit(name).alias("feature_set"), "id", "category", "pc1", "pc2")
        for name, table in points.items()
    ]
    return reduce(DataFrame.unionByName, parts)
