"""One-vs-rest linear SVM with squared hinge loss, fitted by Newton steps over stored rows.

Per class the fit minimises |w|^2 / 2 + C sum(max(0, 1 - y w.x)^2), the intercept being the weight of
a constant feature. The loss is convex and its gradient continuous, so few Newton steps do; each
solves its linear system by conjugate gradients, whose Hessian-vector products are one pass for all
classes together over the rows inside a margin. These are set aside once per step; other rows have no
curvature.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A pass adds up the sums of its tasks in a second stage once there are more tasks than these,
DIRECT_TASKS = 32
# or more numbers than these.
SLICE = 1 << 17
# Steps tried along a Newton direction, all in one pass.
STEP_SIZES = [2.0**-i for i in range(11)]
# Conjugate gradients end at this share of the gradient.
INNER_TOLERANCE = 0.1
# Rows are handed on in pieces of about so many entries.
PIECE = 1 << 20
# Rows as bytes: entries per row, features, values, and the numbers given with every row.
PACKED = "lengths binary, indices binary, entries binary, given binary"


class Block:
    """Sparse rows: entries per row, their features and values."""

    def __init__(self, lengths: np.ndarray, indices: np.ndarray, values: np.ndarray, size: int):
        self.lengths, self.indices, self.values, self.size = lengths, indices, values, size
        self.rows = len(lengths)
        self.row = np.repeat(np.arange(self.rows), lengths)

    @staticmethod
    def of_vectors(vectors: pa.StructArray, size: int) -> "Block":
        """The rows of one Arrow batch of Spark ML vectors."""
        values = vectors.field("values")
        lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
        if sparse.all():
            indices = vectors.field("indices").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            given = vectors.field("indices").to_pylist()
            each = [g if s else range(n) for g, s, n in zip(given, sparse, lengths.tolist())]
            indices = np.array([i for e in each for i in e], np.int64)
        return Block(lengths, indices, values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), size)

    def packed(self, given: np.ndarray) -> pa.RecordBatch:
        """One row of ``PACKED``."""
        parts = self.lengths.astype(np.int32), self.indices.astype(np.int32), self.values, given.astype(np.float64)
        data = [pa.array([part.tobytes()], pa.binary()) for part in parts]
        return pa.RecordBatch.from_arrays(data, names=["lengths", "indices", "entries", "given"])

    def only(self, kept: np.ndarray) -> "Block":
        entries = kept[self.row]
        return Block(self.lengths[kept], self.indices[entries], self.values[entries], self.size)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """(rows, classes): products with (classes, size + 1) weights, the last of a constant 1."""
        sums = [np.bincount(self.row, self.values * w[self.indices], self.rows) + w[-1] for w in weights]
        return np.stack(sums, axis=1)

    def back(self, shares: np.ndarray) -> np.ndarray:
        """(classes, size + 1): sums of the rows weighted by (rows, classes) shares."""
        out = np.empty((shares.shape[1], self.size + 1))
        for c, share in enumerate(shares.T):
            out[c, :-1] = np.bincount(self.indices, self.values * share[self.row], self.size)
            out[c, -1] = share.sum()
        return out

    def add_back(self, total: np.ndarray, shares: np.ndarray) -> None:
        """Add ``back`` to (classes, size + 1) sums in place, so that a piece needs no array as wide as the model."""
        for sums, share in zip(total, shares.T, strict=True):
            np.add.at(sums, self.indices, self.values * share[self.row])
            sums[-1] += share.sum()


def unpacked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[Block, np.ndarray]]:
    """The rows of every packed piece and (rows, width) numbers given with them."""
    for batch in batches:
        for piece in zip(*(batch.column(c) for c in ("lengths", "indices", "entries", "given")), strict=True):
            lengths, indices, values, given = (
                np.frombuffer(p.as_buffer(), kind) for p, kind in zip(piece, (np.int32, np.int32, float, float), strict=True)
            )
            if len(lengths):
                yield Block(lengths, indices, values, size), given.reshape(len(lengths), -1)


@dataclass(frozen=True)
class Adds:
    """A part of sums that ``add(block, given, total)`` adds to the total in place."""

    add: Callable[[Block, np.ndarray, np.ndarray], None]


@dataclass(frozen=True)
class Rows:
    """Rows as a table of ``PACKED`` pieces in ``tasks`` partitions, which passes need not parse again."""

    table: DataFrame
    size: int
    tasks: int

    @staticmethod
    def of(rows: DataFrame, size: int) -> "Rows":
        """(features, label) rows; the label is given with every row."""
        limit = PIECE

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths = batch.column(0).field("values").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                starts = np.cumsum(lengths, dtype=np.int64) - lengths
                cuts = np.r_[0, np.flatnonzero(np.diff(starts // limit)) + 1, len(lengths)]
                for a, b in zip(cuts, cuts[1:]):
                    if a < b:
                        part = batch.slice(a, b - a)
                        yield Block.of_vectors(part.column(0), size).packed(part.column(1).to_numpy(zero_copy_only=False))

        return Rows(rows.mapInArrow(run, PACKED), size, rows.rdd.getNumPartitions())

    def persist(self) -> "Rows":
        return Rows(self.table.persist(StorageLevel.MEMORY_AND_DISK), self.size, self.tasks)

    def where(self, marks: Callable[[Block, np.ndarray], np.ndarray]) -> "Rows":
        """The rows with any true among their ``marks(block, given)``, which are given with them instead."""
        size = self.size

        def piece(parts: list[tuple[Block, np.ndarray]]) -> pa.RecordBatch:
            whole = (np.concatenate([getattr(b, name) for b, _ in parts]) for name in ("lengths", "indices", "values"))
            return Block(*whole, size).packed(np.concatenate([given for _, given in parts]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts, entries = [], 0
            for block, given in unpacked(batches, size):
                marked = marks(block, given)
                kept = marked.any(axis=1)
                parts.append((block.only(kept), marked[kept]))
                entries += len(parts[-1][0].values)
                if entries >= PIECE:
                    yield piece(parts)
                    parts, entries = [], 0
            if parts:
                yield piece(parts)

        return Rows(self.table.mapInArrow(run, PACKED), size, self.tasks)

    def summed(self, part: "Callable[[Block, np.ndarray], np.ndarray] | Adds", shape: tuple) -> np.ndarray:
        """The sum of ``part(block, given)`` over all pieces.

        A task gives its non-zero sums in slices of at most ``SLICE`` numbers. Sums of many tasks, or of
        many slices, are added up slice by slice in a second stage, so the driver gets each number once.
        """
        slices, size = -(-math.prod(shape) // SLICE), self.size
        add = part.add if isinstance(part, Adds) else None

        def piece(i: int, sums: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(sums).astype(np.int32)
            data = [pa.array([i], pa.int64()), pa.array([at.tobytes()], pa.binary()), pa.array([sums[at].tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(data, names=["slice", "at", "part"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for block, given in unpacked(batches, size):
                if add:
                    add(block, given, total)
                else:
                    total += part(block, given)
            flat = total.reshape(-1)
            yield from (piece(i, flat[i * SLICE : (i + 1) * SLICE]) for i in range(slices))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = {}
            for batch in batches:
                for row in batch.to_pylist():
                    total = totals.setdefault(row["slice"], np.zeros(SLICE))
                    total[np.frombuffer(row["at"], np.int32)] += np.frombuffer(row["part"])
            yield from (piece(i, total) for i, total in totals.items())

        schema = "slice long, at binary, part binary"
        parts = self.table.mapInArrow(run, schema)
        if self.tasks > DIRECT_TASKS or slices > 1:
            parts = parts.repartition(min(slices, self.tasks), "slice").mapInArrow(merge, schema)
        out = np.zeros(math.prod(shape))
        for row in parts.collect():  # every number once, or one slice of at most ``DIRECT_TASKS`` tasks
            out[row["slice"] * SLICE + np.frombuffer(row["at"], np.int32)] += np.frombuffer(row["part"])
        return out.reshape(shape)


def summed(rows: DataFrame, size: int, part: Callable[[Block, np.ndarray], np.ndarray], shape: tuple) -> np.ndarray:
    """The sum of ``part(block, labels)`` over (features, label) rows, in one pass."""
    return Rows.of(rows, size).summed(lambda block, labels: part(block, labels[:, 0]), shape)


def _signs(labels: np.ndarray, classes: int) -> np.ndarray:
    """(rows, classes) from (rows, 1) labels."""
    return np.where(labels == np.arange(classes), 1.0, -1.0)


@dataclass(frozen=True)
class NewtonFit:
    """Weights (classes, features + 1) and how the fit ended.

    ``gradient`` is the largest norm of a class's gradient, relative to that at zero weights.
    """

    weights: np.ndarray
    steps: int
    passes: int
    gradient: float
    converged: bool


def fit_squared_hinge(
    rows: DataFrame, size: int, classes: int, c: float = 1.0, tol: float = 1e-4, max_steps: int = 100, inner: int = 100
) -> NewtonFit:
    """Fit (features, label) rows; ``tol`` bounds each class's gradient relative to the first one."""
    shape, passes = (classes, size + 1), 0
    stored = Rows.of(rows, size).persist()

    def gradient(weights: np.ndarray) -> np.ndarray:
        def part(block, labels, total):
            y = _signs(labels, classes)
            slack = np.maximum(0, 1 - y * block.times(weights))
            block.add_back(total, -2 * c * slack * y)

        return weights + stored.summed(Adds(part), shape)

    def inside(weights: np.ndarray, open_: np.ndarray) -> Rows:
        """The rows inside the margin of an open class, marked by class."""
        return stored.where(lambda block, labels: (_signs(labels, classes) * block.times(weights) < 1) & open_)

    def curvature(active: Rows, direction: np.ndarray) -> np.ndarray:
        def part(block, marks, total):
            block.add_back(total, 2 * c * marks * block.times(direction))

        return direction + active.summed(Adds(part), shape)

    def losses(weights: np.ndarray, direction: np.ndarray) -> np.ndarray:
        """(step sizes + 1, classes): the objective at every step size, and at none."""
        steps = np.array([0.0, *STEP_SIZES])

        def part(block, labels):
            y = _signs(labels, classes)
            at, along = y * block.times(weights), y * block.times(direction)
            return np.stack([(np.maximum(0, 1 - at - t * along) ** 2).sum(axis=0) for t in steps])

        hinge = stored.summed(part, (len(steps), classes))
        norms = np.stack([((weights + t * direction) ** 2).sum(axis=1) for t in steps])
        return norms / 2 + c * hinge

    def direction_of(weights: np.ndarray, g: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, int]:
        """Conjugate gradients for all open classes side by side."""
        d, r = np.zeros(shape), np.where(open_[:, None], -g, 0.0)
        p, rr = r.copy(), (r * r).sum(axis=1)
        goal, used = INNER_TOLERANCE**2 * rr, 0
        active = inside(weights, open_).persist()
        while used < inner and (rr > goal).any():
            going = rr > goal
            hp = curvature(active, np.where(going[:, None], p, 0.0))
            used += 1
            php = (p * hp).sum(axis=1)
            alpha = np.where(going & (php > 0), rr / np.where(php > 0, php, 1), 0.0)
            d += alpha[:, None] * p
            r -= alpha[:, None] * hp
            new = np.where(going, (r * r).sum(axis=1), rr)
            beta = np.where(going, new / np.where(rr > 0, rr, 1), 0.0)
            p = np.where(going[:, None], r + beta[:, None] * p, p)
            rr = new
        active.table.unpersist()
        return d, used

    weights = np.zeros(shape)
    g = gradient(weights)
    first = np.sqrt((g * g).sum(axis=1))
    passes, steps = 1, 0
    norm = first.copy()
    open_ = norm > tol * first
    while open_.any() and steps < max_steps:
        d, used = direction_of(weights, g, open_)
        values = losses(weights, d)
        slope = (g * d).sum(axis=1)
        sizes = np.array(STEP_SIZES)
        enough = values[1:] <= values[0] + 1e-4 * sizes[:, None] * slope
        pick = np.where(enough.any(axis=0), sizes[enough.argmax(axis=0)], 0.0) * open_
        passes, steps = passes + used + 2, steps + 1
        if not pick.any():
            break  # no step lowers the objective within rounding
        weights = weights + pick[:, None] * d
        g = gradient(weights)
        norm = np.sqrt((g * g).sum(axis=1))
        open_ = norm > tol * first
    stored.table.unpersist()
    relative = float((norm / np.where(first > 0, first, 1)).max()) if classes else 0.0
    return NewtonFit(weights, steps, passes, relative, not open_.any())


class SquaredHingeModel(Transformer):
    """Adds ``prediction``, the class of the largest margin, the first of equal ones."""

    def __init__(self, fit: NewtonFit):
        super().__init__()
        self.fit = fit

    def margins(self, features: str = "features") -> Column:
        weights = self.fit.weights

        @F.arrow_udf("array<double>")
        def scored(vectors: pa.Array) -> pa.Array:
            if not len(vectors):
                return pa.array([], pa.list_(pa.float64()))
            return pa.array(Block.of_vectors(vectors, weights.shape[1] - 1).times(weights).tolist(), pa.list_(pa.float64()))

        return scored(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weights = self.fit.weights

        @F.arrow_udf("double")
        def best(vectors: pa.Array) -> pa.Array:
            if not len(vectors):
                return pa.array([], pa.float64())
            return pa.array(Block.of_vectors(vectors, weights.shape[1] - 1).times(weights).argmax(axis=1).astype(np.float64))

        return dataset.withColumn("prediction", best("features"))


class NewtonSvc:
    """Estimator of ``SquaredHingeModel`` from ``features`` and ``label``."""

    def __init__(self, size: int, classes: int, c: float, tol: float, max_steps: int):
        self.settings = dict(size=size, classes=classes, c=c, tol=tol, max_steps=max_steps)

    def fit(self, rows: DataFrame) -> SquaredHingeModel:
        return SquaredHingeModel(fit_squared_hinge(rows.select("features", "label"), **self.settings))
