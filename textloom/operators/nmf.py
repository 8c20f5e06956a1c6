"""Non-negative matrix factorization X ≈ W H by multiplicative updates (Lee and Seung)."""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.factors import (
    ROW,
    blocks_of,
    columns,
    gram,
    hash_uniform,
    numbered,
    renamed,
    right_multiply,
    times_terms,
    with_keys,
)
from textloom.operators.routes import (
    MESSAGE,
    BlockCells,
    Routes,
    messages,
    numbered_rows,
    routes_of,
    row_blocks,
    sent,
    term_ids,
    term_rows,
    term_slices,
)
from textloom.operators.vectors import BLOCK, weights
from textloom.session import discard, materialize

TINY = 1e-12


@dataclass(frozen=True)
class NmfModel:
    """``terms`` (term_id, c0..) is H; ``documents`` (keys, c0..) is W of the training rows."""

    k: int
    n_terms: int
    terms: DataFrame
    documents: DataFrame
    gram: np.ndarray
    error: float
    errors: list[float] = field(default_factory=list)
    converged: bool = False


def multiplicative(old: np.ndarray, product: np.ndarray, other_gram: np.ndarray) -> np.ndarray:
    """New factor rows from the old ones, their product with X and the other factor's Gram."""
    return old * product / np.maximum(old @ other_gram, TINY)


def update(x: Routes, w: DataFrame, h: DataFrame, k: int, h_gram: np.ndarray) -> DataFrame:
    """One pass: W ← W ∘ (X Hᵀ) / (W H Hᵀ), and the sums Xᵀ W of the new W.

    ``w`` is kept by block and ``h`` by slice. The stored result holds blocks of the new W (-1 - block in
    ``slice``) beside their Gram, and sums by slice beside the old H, in ``other``.
    """
    numbers, schema = x.numbers, f"{MESSAGE}, other binary"

    def block(cells: pa.Table, given: pa.Table) -> pa.Table:
        own = BlockCells(cells, given, numbers, k)
        new, sums = own.updated(lambda old, product: multiplicative(old, product, h_gram))
        of, none = [own.number] * (len(sums) + 1), [None] * len(sums)
        other = pa.array([(new.T @ new).tobytes(), *none], pa.binary())
        return messages([-1 - own.number, *own.slices], of, [new, *sums], other=other)

    def total(routes: pa.Table, given: pa.Table) -> pa.Table:
        if not routes.num_rows:
            return given  # a block of W
        at = dict(zip(routes.column("of").to_pylist(), routes.column("at"), strict=True))
        sums, old = np.zeros((len(at[-1].as_buffer()) // 8, k)), None
        for of, part in zip(given.column("of").to_pylist(), given.column("part"), strict=True):
            if of < 0:
                old = part.as_py()
            else:
                sums[np.frombuffer(at[of].as_buffer(), np.int32)] += np.frombuffer(part.as_buffer(), np.float64).reshape(-1, k)
        return messages([routes.column("slice")[0].as_py()], [-1], [sums], other=pa.array([old], pa.binary()))

    given = sent(x, h, k).unionByName(w.select("slice", "of", "part"))
    found = x.cells.groupBy(BLOCK).cogroup(given.groupBy("of")).applyInArrow(block, schema)
    old = h.select("slice", "of", "part", F.lit(None).cast("binary").alias("other"))
    sums = found.unionByName(old).groupBy("slice")
    return materialize(x.routes.groupBy("slice").cogroup(sums).applyInArrow(total, schema), "nmf-step")


def updated_documents(found: DataFrame) -> DataFrame:
    """The new W by block."""
    return found.filter("slice < 0").selectExpr("-1L AS slice", "of", "part")


def documents_gram(found: DataFrame, k: int) -> np.ndarray:
    """Wᵀ W of the new W, of one small matrix per block."""
    parts = found.filter("slice < 0").select("other").collect()
    return sum((np.frombuffer(r["other"]).reshape(k, k) for r in parts), np.zeros((k, k)))


def update_terms(found: DataFrame, k: int, w_gram: np.ndarray) -> DataFrame:
    """H ← H ∘ (Wᵀ X) / (Wᵀ W H) by slice, beside its Gram and its products with Wᵀ X for the error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, part, other in zip(*(batch.column(c).to_pylist() for c in ("slice", "part", "other")), strict=True):
                sums, old = (np.frombuffer(b).reshape(-1, k) for b in (part, other))
                new = multiplicative(old, sums, w_gram)
                others = {"gram": pa.array([(new.T @ new).tobytes()], pa.binary()), "shared": pa.array([float((new * sums).sum())])}
                yield from messages([number], [-1], [new], **others).to_batches()

    return found.filter("slice >= 0").mapInArrow(run, f"{MESSAGE}, gram binary, shared double")


def start_factor(keys: DataFrame, key: str, k: int, scale: float, seed: int) -> DataFrame:
    """Positive start values from a hash of the key, the column and the seed."""
    starts = [
        f"{2 * scale!r}D * {hash_uniform(seed, key, i)} AS {c}" for i, c in enumerate(columns(k))
    ]
    return keys.selectExpr(key, *starts)


def fit_nmf(
    rows: DataFrame,
    n_terms: int,
    k: int = 8,
    max_iter: int = 200,
    tol: float = 1e-4,
    seed: int = 42,
    start_terms: DataFrame | None = None,
) -> NmfModel:
    """Factorize ``rows`` (keys, indices, values) into ``k`` components.

    Rows are numbered first, so rows that repeat an id, or have none, keep weights of their own.

    Iterates until the error falls by less than ``tol`` of the first error; ``converged`` tells
    whether that or ``max_iter`` ended the fit. ``start_terms`` continues from an earlier H, in
    which new terms get a start value. The new W and what the new H follows from are written to the
    shared folder in every iteration: each is used twice in the next one, so that plans would otherwise
    double with every step, and a lost executor costs no more than the current step. The next one
    replaces it there.
    """
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    rows = numbered(rows)
    x = routes_of(rows)
    x_sum, x_squared = weights(rows.select("indices", "values")).withColumnRenamed("weight", "x").agg(
        F.coalesce(F.sum("x"), F.lit(0.0)), F.coalesce(F.sum(F.col("x") * F.col("x")), F.lit(0.0))
    ).first()
    n_docs = rows.count()
    scale = float(np.sqrt(x_sum / max(1, n_docs * n_terms) / k))
    # Equal starts for all documents: the terms' start values tell the components apart.
    starts = (f"{scale!r}D AS {c}" for c in columns(k))
    w = row_blocks(x, rows.filter(F.size("indices") > 0).selectExpr(ROW, *starts), k)
    h = start_factor(term_ids(x), "term_id", k, scale, seed + 1)
    if start_terms is not None:
        known = renamed(start_terms, "term_id", k, "s")
        started = [F.coalesce(s, c).alias(c) for c, s in zip(columns(k), columns(k, "s"), strict=True)]
        h = h.join(known, "term_id", "left").select("term_id", *started)
    h = materialize(h, "nmf-terms")
    h_gram = gram(h, k)
    h = materialize(term_slices(x, h, k), "nmf-start")
    errors: list[float] = []
    converged, before = False, h
    for _ in range(max_iter):
        found = update(x, w, h, k, h_gram)
        discard(before)
        before = found
        w = updated_documents(found)
        w_gram = documents_gram(found, k)
        h = update_terms(found, k, w_gram)
        parts = h.select("gram", "shared").collect()  # one small matrix per slice
        h_gram = sum((np.frombuffer(r["gram"]).reshape(k, k) for r in parts), np.zeros((k, k)))
        squared = x_squared - 2 * sum(r["shared"] for r in parts) + float(np.sum(w_gram * h_gram))
        errors.append(float(np.sqrt(max(squared, 0.0))))
        if len(errors) > 1 and errors[-2] - errors[-1] < tol * errors[0]:
            converged = True
            break
    terms = materialize(term_rows(x, h, k), "nmf-terms")
    found_rows = materialize(numbered_rows(x, w, k), "nmf-documents")
    x.unpersist()
    # Documents without any known term take no part in the sums and have zero weights.
    every = with_keys(rows, found_rows).na.fill(0.0, columns(k))
    return NmfModel(k, n_terms, terms, every, h_gram, errors[-1], errors, converged)


def non_negative(b: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """The w >= 0 that minimises w G w / 2 - b w for every row of ``b``, by block principal pivoting.

    Each row holds a set of positive weights; a set is exchanged with those that break the conditions
    of the optimum (w >= 0, gradient >= 0, one of both zero) until none does. If an exchange of all
    does not lessen their number three times, the last of them moves alone, which cannot cycle.
    Rows with the same set share one solution of the small system.
    """
    n, k = b.shape
    positive, tries = np.zeros((n, k), bool), np.full(n, 3)
    fewest, out = np.full(n, k + 1), np.zeros((n, k))
    slack = 1e-12 * (1 + np.abs(b).max(axis=1, keepdims=True, initial=0))
    gradient, open_ = -b, np.arange(n)
    for _ in range(200 * k):
        wrong = np.where(positive[open_], out[open_] < -slack[open_], gradient[open_] < -slack[open_])
        count = wrong.sum(axis=1)
        open_, wrong, count = (x[count > 0] for x in (open_, wrong, count))
        if not len(open_):
            break
        better = count < fewest[open_]
        fewest[open_] = np.minimum(fewest[open_], count)
        tries[open_] = np.where(better, 3, tries[open_] - 1)
        alone = tries[open_] < 0
        last = k - 1 - wrong[:, ::-1].argmax(axis=1)
        wrong[alone] = np.arange(k) == last[alone, None]
        positive[open_] ^= wrong
        sets, of = np.unique(positive[open_], axis=0, return_inverse=True)
        for i, s in enumerate(sets):
            rows = open_[of.reshape(-1) == i]
            out[rows] = 0
            if s.any():
                solved = np.linalg.lstsq(gram[np.ix_(s, s)], b[np.ix_(rows, s)].T, rcond=None)[0].T
                out[np.ix_(rows, s)] = solved
            gradient[rows] = np.where(s, 0.0, out[rows] @ gram - b[rows])
    return np.maximum(out, 0.0)


def transform_nmf(model: NmfModel, rows: DataFrame) -> DataFrame:
    """(keys, c0..): the best W of unseen ``rows`` with H fixed, the exact non-negative optimum.

    X Hᵀ is one pass over blocks of documents. A document then needs nothing but its own product
    and the small Gram matrix, so it is solved on Arrow batches inside the tasks. Documents without
    a known term get zeros; rows that repeat an id are solved each.
    """
    k, h_gram = model.k, model.gram
    rows = numbered(rows)
    product = times_terms(blocks_of(rows), model.terms, k)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            w = non_negative(batch[columns(k)].to_numpy(dtype=float), h_gram)
            yield pd.concat([batch[["id"]], pd.DataFrame(w, columns=columns(k))], axis=1)

    solved = product.mapInPandas(solve, product.schema)
    return with_keys(rows, solved).na.fill(0.0, columns(k))


def optimality(model: NmfModel, rows: DataFrame, solved: DataFrame, key: str = "id", tol: float = 1e-6) -> DataFrame:
    """(key, optimal): whether ``solved`` weights of uniquely keyed ``rows`` meet the conditions of the optimum.

    All weights and all gradients are at least zero, and one of both is zero, within ``tol`` of the
    largest product of the row. The gradient is computed anew from the components.
    """
    k = model.k
    rows = numbered(rows.select(key, "indices", "values"))
    product = renamed(times_terms(blocks_of(rows), model.terms, k), "id", k, "b")
    product = with_keys(rows, product).groupBy(F.col(key).alias("id")).agg(*(F.sum(b).alias(b) for b in columns(k, "b")))
    both = solved.withColumnRenamed(key, "id").join(product, "id", "left").na.fill(0.0, columns(k, "b"))
    scale = f"{tol!r}D * (1 + greatest({', '.join(f'abs({b})' for b in columns(k, 'b'))}))"
    below = right_multiply(gram(model.terms, k))
    met = " AND ".join(
        f"{c} >= 0 AND ({g} - {b}) >= -({scale}) AND least({c}, abs({g} - {b})) <= {scale}"
        for c, b, g in zip(columns(k), columns(k, "b"), below, strict=True)
    )
    return both.selectExpr(f"id AS `{key}`", f"{met} AS optimal")


def topic_terms(model: NmfModel) -> DataFrame:
    """(topic, term_id, weight): the components in long form."""
    return long_factor(model.terms, "term_id", model.k)


def long_factor(table: DataFrame, key: str, k: int) -> DataFrame:
    wide = table.unpivot([key], columns(k), "_column", "weight")
    topic = F.substring("_column", 2, 9).cast("int")
    return wide.select(topic.alias("topic"), key, "weight")


def as_array(table: DataFrame, k: int, name: str = "vector") -> DataFrame:
    """(keys, vector) from the factor columns of documents."""
    keys = [c for c in table.columns if c not in columns(k)]
    return table.select(*keys, F.array(*columns(k)).alias(name))
