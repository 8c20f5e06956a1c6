"""Latent Dirichlet allocation by batch variational inference over stored documents.

Every step reads every document once: topic shares of a document are settled inside its task, and
the expected counts of a term are sums of what the documents give it. The topic-term table stays
a Spark table; the driver holds one number per topic.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.factors import (
    ROW,
    Cells,
    blocks_of,
    by_block,
    columns,
    hash_uniform,
    keyed,
    keyed_schema,
    numbered,
)
from textloom.operators.lookup import BROADCAST_BYTES
from textloom.operators.nmf import long_factor
from textloom.operators.routes import MESSAGE, BlockCells, Routes, messages, numbers_in, routes_of, rows_of
from textloom.operators.vectors import BLOCK
from textloom.session import discard, materialize

# The row of a step's sums that holds the bound and not a term.
BOUND_ID = -1
TINY = 1e-100
# About so many entries of whole documents are solved together; their topic rows stay in the caches.
ENTRIES_AT_ONCE = 1 << 15
# Documents at rest are left out once no more than this share still moves.
KEPT = 0.75


def _shifted(x: np.ndarray, shift: int = 8) -> tuple[np.ndarray, list[np.ndarray]]:
    return x + shift, [x + i for i in range(shift)]


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the log-gamma function for positive numbers: recurrence by 8, then its series.

    The reciprocals of x + i and x + 7 - i are added as one quotient.
    """
    y, s = x + 8, x * (x + 7)
    r = 1 / (y * y)
    series = r * (1 / 12 - r * (1 / 120 - r * (1 / 252 - r * (1 / 240 - r / 132))))
    below = (1 / s + 1 / (s + 6) + 1 / (s + 10) + 1 / (s + 12)) * (2 * x + 7)
    return np.log(y) - 0.5 / y - series - below


def log_gamma(x: np.ndarray) -> np.ndarray:
    y, below = _shifted(x)
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - sum(np.log(b) for b in below)


def dirichlet_logs(x: np.ndarray) -> np.ndarray:
    """E[log p] of rows of Dirichlet parameters."""
    found = digamma(np.concatenate([x, x.sum(axis=1, keepdims=True)], axis=1))
    return found[:, :-1] - found[:, -1:]


@dataclass(frozen=True)
class LdaModel:
    """``terms`` (term_id, c0..) holds the topic-term parameters; ``bounds`` the bound before each step."""

    k: int
    n_terms: int
    alpha: float
    eta: float
    terms: DataFrame
    totals: np.ndarray
    bounds: list[float] = field(default_factory=list)
    converged: bool = False


def settle(count: np.ndarray, topics: np.ndarray, alpha: float, inner: int, tol: float) -> np.ndarray:
    """Topic parameters (docs, k) of documents given as (docs, width) counts and (docs, k, width) rows of exp E[log beta].

    Shorter documents are filled up with zeros. Each document stops by itself once its parameters move by
    less than ``tol`` on average, so its result does not depend on the documents beside it.
    """
    n, k, _ = topics.shape
    gamma, now, ones = np.ones((n, k)), np.ones((n, k)), np.ones(k)
    open_, live, weight = np.arange(n), np.ones(n, bool), np.empty_like(count)
    for _ in range(inner):
        share = np.exp(dirichlet_logs(now))
        np.matmul(share[:, None, :], topics, out=weight[:, None, :])
        weight += TINY
        np.divide(count, weight, out=weight)
        new = alpha + share * np.matmul(topics, weight[:, :, None])[:, :, 0]
        moving = np.abs(new - now) @ ones / k >= tol
        gamma[open_[live]], now = new[live], new
        live &= moving
        left = np.count_nonzero(live)
        if not left:
            break
        # Documents at rest go along until they are many, as leaving them out copies the others.
        if left <= KEPT * len(live):
            count, topics, now, open_ = count[live], topics[live], now[live], open_[live]
            live, weight = np.ones(left, bool), np.empty_like(count)
    return gamma


def prior_bounds(gamma: np.ndarray, logs: np.ndarray, alpha: float) -> np.ndarray:
    """The part of a document's bound that does not depend on its words."""
    k = gamma.shape[1]
    out = ((alpha - gamma) * logs).sum(axis=1) + log_gamma(gamma).sum(axis=1)
    return out + math.lgamma(k * alpha) - k * math.lgamma(alpha) - log_gamma(gamma.sum(axis=1))


def alike(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Documents with entries in groups of similar lengths, each of about ``ENTRIES_AT_ONCE`` entries."""
    order = np.argsort(lengths, kind="stable")
    ordered, first = lengths[order], int(np.count_nonzero(lengths == 0))
    while first < len(order):
        last = int(np.searchsorted(ordered, ordered[first] + ordered[first] // 4 + 16, "right"))
        last = min(last, first + max(1, ENTRIES_AT_ONCE // int(ordered[last - 1])))
        yield order[first:last]
        first = last


class Documents:
    """Documents one after the other: entries each, and of every entry its place in ``factor`` and its count.

    ``factor`` holds one array per topic, exp E[log beta] of the terms; entries of terms without any, and
    counts that are not positive, are left out.
    """

    def __init__(self, lengths: np.ndarray, place: np.ndarray, x: np.ndarray, factor: Sequence[np.ndarray]):
        kept = x > 0
        kept &= np.any(factor, axis=0)[place]
        if not kept.all():
            row = np.repeat(np.arange(len(lengths)), lengths)[kept]
            lengths, place, x = np.bincount(row, minlength=len(lengths)), place[kept], x[kept]
        self.lengths, self.place, self.x, self.factor = lengths.astype(np.int64), place, x, factor

    def solved(self, alpha: float, inner: int, tol: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Topic parameters and bound of every document, and every count divided by its mixed topic row."""
        k, lengths = len(self.factor), self.lengths
        starts, width = np.cumsum(lengths) - lengths, np.arange(lengths.max(initial=0))
        gamma, bounds, weight = np.full((len(lengths), k), alpha), np.zeros(len(lengths)), np.zeros(len(self.x))
        for some in alike(lengths):
            there = width[: lengths[some[-1]]] < lengths[some, None]
            at = np.where(there, starts[some, None] + width[: there.shape[1]], starts[some, None])
            count, place = np.where(there, self.x[at], 0.0), self.place[at]
            topics = np.empty((len(some), k, there.shape[1]))
            for c, column in enumerate(self.factor):
                topics[:, c] = column[place]
            found = settle(count, topics, alpha, inner, tol)
            logs = dirichlet_logs(found)
            mixed = np.matmul(np.exp(logs)[:, None, :], topics)[:, 0] + TINY
            gamma[some] = found
            bounds[some] = (count * np.log(mixed)).sum(axis=1) + prior_bounds(found, logs, alpha)
            weight[at[there]] = (count / mixed)[there]
        return gamma, bounds, weight

    def shares(self, gamma: np.ndarray, weight: np.ndarray) -> Iterator[np.ndarray]:
        """Summed shares of every term, topic by topic."""
        n = len(self.factor[0])
        for share, column in zip(np.exp(dirichlet_logs(gamma)).T, self.factor, strict=True):
            yield np.bincount(self.place, weight * np.repeat(share, self.lengths), n) * column


def topic_logs(terms: DataFrame, totals: np.ndarray) -> DataFrame:
    """(term_id, c0..): exp E[log beta] of every term."""
    k, below = len(totals), digamma(np.asarray(totals, float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.exp(digamma(batch.column(c).to_numpy()) - b) for c, b in zip(columns(k), below)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("term_id"), *map(pa.array, values)], names=["term_id", *columns(k)]
            )

    schema = ", ".join(["term_id int", *(f"{c} double" for c in columns(k))])
    return terms.select(F.col("term_id").cast("int").alias("term_id"), *columns(k)).mapInArrow(run, schema)


def sent_logs(model: LdaModel) -> DataFrame:
    """The topic rows, sent whole to every executor while they are few."""
    logs = topic_logs(model.terms, model.totals)
    return F.broadcast(logs) if 8 * model.n_terms * (model.k + 1) <= BROADCAST_BYTES else logs


def expected_counts(x: Routes, model: LdaModel, inner: int, tol: float) -> DataFrame:
    """(term_id, c0..): summed topic shares of every term that occurs, and the bound of every block as ``BOUND_ID``."""
    k, alpha, numbers = model.k, model.alpha, x.numbers

    def send(own: pa.Table, given: pa.Table) -> pa.Table:
        at = {of: np.frombuffer(part, np.int64 if of < 0 else np.int32) for of, part in zip(*(own.column(c).to_pylist() for c in ("of", "at")))}
        if not at:
            return messages([], [], [])
        rows = rows_of(at.pop(-1), "term_id", given, k)
        return messages([own.column("slice")[0].as_py()] * len(at), list(at), [rows[part] for part in at.values()])

    def block(cells: pa.Table, given: pa.Table) -> pa.Table:
        own = BlockCells(cells, given, numbers, k)
        sums, bound = np.zeros(own.factor.shape), 0.0
        for lengths, at, values in own.arrays():
            documents = Documents(lengths, at, values, own.factor)
            gamma, bounds, weight = documents.solved(alpha, inner, tol)
            bound += bounds.sum()
            for total, share in zip(sums, documents.shares(gamma, weight), strict=True):
                total += share
        parts = [np.array([bound]), *own.by_slice(sums)]
        return messages([-1 - own.number, *own.slices], [own.number] * len(parts), parts)

    def total(routes: pa.Table, given: pa.Table) -> pa.Table:
        if not routes.num_rows:
            sums = np.zeros((given.num_rows, k))
            sums[:, 0] = numbers_in(given.column("part"), np.float64)
            return keyed("term_id", np.full(len(sums), BOUND_ID), sums)
        at = dict(zip(routes.column("of").to_pylist(), routes.column("at"), strict=True))
        ids = np.frombuffer(at[-1].as_buffer(), np.int64)
        sums = np.zeros((len(ids), k))
        for of, part in zip(given.column("of").to_pylist(), given.column("part"), strict=True):
            sums[np.frombuffer(at[of].as_buffer(), np.int32)] += np.frombuffer(part.as_buffer(), np.float64).reshape(-1, k)
        return keyed("term_id", ids, sums)

    logs = topic_logs(model.terms, model.totals).select(x.slice().alias("slice"), F.col("term_id").cast("long").alias("term_id"), *columns(k))
    sent = x.routes.groupBy("slice").cogroup(logs.groupBy("slice")).applyInArrow(send, MESSAGE)
    found = x.cells.groupBy(BLOCK).cogroup(sent.groupBy("of")).applyInArrow(block, MESSAGE)
    return x.routes.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(total, keyed_schema("term_id", k))


def topics_bound(terms: DataFrame, totals: np.ndarray, n_terms: int, eta: float) -> float:
    """The part of the bound that belongs to the topics."""
    k, below = len(totals), digamma(np.asarray(totals, float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = np.stack([batch.column(c).to_numpy() for c in columns(k)], axis=1)
            part = ((eta - value) * (digamma(value) - below) + log_gamma(value) - math.lgamma(eta)).sum()
            yield pa.RecordBatch.from_arrays([pa.array([part])], names=["part"])

    total = terms.select(columns(k)).mapInArrow(run, "part double").agg(F.sum("part")).first()[0] or 0.0
    return float(total + k * math.lgamma(n_terms * eta) - log_gamma(np.asarray(totals, float)).sum())


def model_of(terms: DataFrame, k: int, n_terms: int, alpha: float | None = None, eta: float | None = None) -> LdaModel:
    """A model from a stored table of positive parameters (term_id, c0..) of all ``n_terms`` terms."""
    totals = terms.agg(*(F.sum(c) for c in columns(k))).first()
    return LdaModel(k, n_terms, alpha or 1 / k, eta or 1 / k, terms, np.array([t or 0.0 for t in totals]))


def step(x: Routes, model: LdaModel, inner: int, tol: float) -> tuple[LdaModel, float]:
    """The model after one pass over all documents, and the bound of the model before it."""
    k = model.k
    sums = materialize(expected_counts(x, model, inner, tol), "lda-step")
    documents = sums.filter(F.col("term_id") == BOUND_ID).agg(F.sum("c0")).first()[0] or 0.0
    before = documents + topics_bound(model.terms, model.totals, model.n_terms, model.eta)
    counts = sums.filter(F.col("term_id") != BOUND_ID).selectExpr("term_id", *(f"c{i} AS s{i}" for i in range(k)))
    every = model.terms.select(F.col("term_id").cast("int").alias("term_id")).join(counts, "term_id", "left")
    new = [(F.coalesce(f"s{i}", F.lit(0.0)) + model.eta).alias(f"c{i}") for i in range(k)]
    terms = materialize(every.select("term_id", *new), "lda-terms")
    discard(sums)
    after = model_of(terms, k, model.n_terms, model.alpha, model.eta)
    return LdaModel(k, model.n_terms, model.alpha, model.eta, terms, after.totals, [*model.bounds, before]), before


def fit_lda(
    rows: DataFrame,
    vocabulary_terms: DataFrame,
    n_terms: int,
    k: int = 8,
    max_iter: int = 20,
    tol: float = 1e-4,
    inner: int = 100,
    inner_tol: float = 1e-3,
    seed: int = 42,
) -> LdaModel:
    """Fit ``k`` topics to count ``rows`` (indices, values) over the terms of a vocabulary table.

    Start values are hashes of term, topic and seed, so the topics do not depend on how the rows are
    dealt over tasks. The fit ends when the bound grows by less than ``tol`` of itself, which
    ``converged`` tells, or after ``max_iter`` steps.
    """
    x = routes_of(rows if ROW in rows.columns else numbered(rows))
    starts = [f"0.5D + {hash_uniform(seed, 'term_id', i)} AS c{i}" for i in range(k)]
    terms = materialize(vocabulary_terms.selectExpr("cast(term_id AS int) AS term_id", *starts), "lda-terms")
    model, converged = model_of(terms, k, n_terms), False
    for _ in range(max_iter):
        before = model.terms
        model, _ = step(x, model, inner, inner_tol)
        discard(before)
        if len(model.bounds) > 1 and abs(model.bounds[-1] - model.bounds[-2]) <= tol * abs(model.bounds[-2]):
            converged = True
            break
    x.unpersist()
    return LdaModel(k, n_terms, model.alpha, model.eta, model.terms, model.totals, model.bounds, converged)


def infer(rows: DataFrame, model: LdaModel, inner: int = 100, inner_tol: float = 1e-3) -> DataFrame:
    """(keys, vector, bound): topic shares of every row and its part of the variational bound.

    Rows without a known term get equal shares and a bound of 0. Rows that repeat an id stay
    rows of their own.
    """
    k, alpha = model.k, model.alpha
    stored = rows if ROW in rows.columns else numbered(rows)
    keys = [c for c in stored.columns if c not in (ROW, "indices", "values")]

    def run(table: pa.Table, logs: pa.Table) -> pa.Table:
        cells = Cells(table, logs, k)
        documents = Documents(np.bincount(cells.row, minlength=len(cells.rows)), cells.place, cells.x, cells.factor)
        gamma, bounds, _ = documents.solved(alpha, inner, inner_tol)
        some = documents.lengths > 0
        shares = gamma[some] / gamma[some].sum(axis=1, keepdims=True)
        lists = pa.ListArray.from_arrays(np.arange(0, shares.size + 1, k, np.int32), pa.array(shares.reshape(-1)))
        return pa.table({ROW: pa.array(cells.rows[some], pa.int64()), "vector": lists, "bound": pa.array(bounds[some])})

    blocks = blocks_of(stored)
    found = by_block(blocks, sent_logs(model), k, run, f"{ROW} long, vector array<double>, bound double")
    found = materialize(found, "lda-documents")
    blocks.unpersist()
    even = F.array_repeat(F.lit(1.0 / k), k)
    return stored.select(ROW, *keys).join(found, ROW, "left").select(
        *keys, F.coalesce("vector", even).alias("vector"), F.coalesce("bound", F.lit(0.0)).alias("bound")
    )


def quality(rows: DataFrame, model: LdaModel) -> dict[str, float]:
    """Bound of the rows under the model, topics included, and the perplexity per word."""
    documents = infer(rows, model).agg(F.sum("bound")).first()[0] or 0.0
    words = rows.agg(F.sum(F.aggregate("values", F.lit(0.0), lambda a, v: a + v))).first()[0] or 0.0
    bound = documents + topics_bound(model.terms, model.totals, model.n_terms, model.eta)
    return {"log_likelihood": bound, "perplexity": math.exp(-bound / max(1.0, words))}


def topic_terms(model: LdaModel) -> DataFrame:
    """(topic, term_id, weight): the share of every term in every topic."""
    shares = [f"{c} / {float(t)!r}D AS {c}" for c, t in zip(columns(model.k), model.totals)]
    return long_factor(model.terms.selectExpr("term_id", *shares), "term_id", model.k)
