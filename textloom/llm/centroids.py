"""Exact integer k-means: Ptolemaic lower bounds from cached pivot distances, survivors checked."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_fields, materialize, to_batch

DIM = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
PIVOTS = 4
# Integer components stay below this, so that a squared distance of 64 components fits in 64 bits.
COMPONENT_BOUND = 1 << 27
# Relative share of its terms by which a bound is lowered, far above the error of its rounding.
SLACK = 1e-13


def kept(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """Rows (vec_id, embedding) of exactly ``dim`` components, none of them null or non-finite."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select("vec_id", "embedding").filter((F.size("embedding") == dim) & ~bad)


def integers(flat: np.ndarray, dim: int) -> np.ndarray:
    """floor(SCALE * x) of every component, as rows of ``dim``."""
    scaled = np.floor(flat.astype(np.float64) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= COMPONENT_BOUND:
        raise ValueError(f"a component is beyond {COMPONENT_BOUND // SCALE}: its distances exceed 64 bits")
    return scaled.astype(np.int64).reshape(-1, dim)


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to one integer point."""
    away = rows - point
    return np.einsum("ij,ij->i", away, away)


def pivots_of(points: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Up to ``most`` distinct points, each the farthest from those before it."""
    chosen = [0]
    nearest = squared(points, points[0])
    while len(chosen) < most and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[chosen[-1]]))
    return points[chosen]


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """(rows, points): Euclidean distances, rounded."""
    return np.sqrt(np.stack([squared(rows, p) for p in points], axis=1).astype(np.float64))


def lower_bounds(to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, centroids): numbers not above the squared distances, by Ptolemy's inequality.

    For a row x, a centroid c and pivots p, s: d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) *
    d(c, p)|. Every bound is lowered by more than its rounding can have raised it.
    """
    ours, apart = distances(centroids, pivots), distances(pivots, pivots)
    best = np.zeros((len(to_pivots), len(centroids)))
    for p, s in combinations(range(len(pivots)), 2):
        one, two = np.outer(to_pivots[:, p], ours[:, s]), np.outer(to_pivots[:, s], ours[:, p])
        np.maximum(best, (np.abs(one - two) - SLACK * (one + two)) / apart[p, s], out=best)
    return best * best * (1 - SLACK)


def nearest(rows: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """(number of the nearest centroid, exact squared distance) per row, and the distances computed.

    Ties go to the smaller number. A centroid whose bound exceeds the best exact distance so far
    cannot be the nearest; all others are checked exactly.
    """
    bounds = lower_bounds(to_pivots, centroids, pivots)
    who = bounds.argmin(axis=1)
    first = rows - centroids[who]
    best, checked = np.einsum("ij,ij->i", first, first), len(rows)
    guess = who.copy()
    for c in range(len(centroids)):
        at = np.flatnonzero((bounds[:, c] <= best) & (guess != c))
        checked += len(at)
        d = squared(rows[at], centroids[c])
        better = (d < best[at]) | ((d == best[at]) & (c < who[at]))
        at = at[better]
        best[at], who[at] = d[better], c
    return who, best, checked


def _rows(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def with_pivots(found: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, away): integer components and distances to the pivots, stored for all rounds."""
    kind = found.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, v array<int>, away array<double>"
    names, types = arrow_fields(found.sparkSession, schema)
    dim = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column(1).flatten().to_numpy(zero_copy_only=False), dim)
            away = distances(rows, pivots)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), x.reshape(-1))
                for x in (rows.astype(np.int32), away)
            ]
            yield to_batch([batch.column(0), *lists], names, types)

    return materialize(found.mapInArrow(run, schema), "vectors")


def cluster_sums(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Rows and component sums of each non-empty cluster: one pass, summed in every task first."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            rows = _rows(batch, "v", dim).astype(np.int64)
            who, _, _ = nearest(rows, _rows(batch, "away", len(pivots)), centroids, pivots)
            counts += np.bincount(who, minlength=k)
            for c in np.unique(who):
                sums[c] += rows[who == c].sum(axis=0)
        at = np.flatnonzero(counts)
        columns = [np.repeat(at, dim), np.tile(np.arange(dim), len(at)), np.repeat(counts[at], dim), sums[at].reshape(-1)]
        yield to_batch([pa.array(c) for c in columns], names, types)

    schema = "cluster int, place int, n long, s long"
    names, types = arrow_fields(stored.sparkSession, schema)
    parts = stored.select("v", "away").mapInArrow(run, schema)
    total = F.sum(F.col("s").cast(T.DecimalType(38, 0)))
    found = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), total.alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in found:
        out.setdefault(r["cluster"], (r["n"], [0] * dim))[1][r["place"]] = int(r["s"])
    return out


def assigned(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every stored row."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch, "v", dim).astype(np.int64)
            who, best, _ = nearest(rows, _rows(batch, "away", len(pivots)), centroids, pivots)
            yield to_batch([batch.column("vec_id"), pa.array(who), pa.array(best)], names, types)

    schema = f"vec_id {stored.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    names, types = arrow_fields(stored.sparkSession, schema)
    return stored.mapInArrow(run, schema)


def starting_points(found: DataFrame, clusters: int, seed: int, dim: int) -> np.ndarray:
    """The rows with the smallest hash of their id; equal ids by components, null ids last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = found.orderBy(order.asc_nulls_last(), "embedding").limit(clusters).select("embedding").collect()
    return integers(np.array([r[0] for r in first], np.float64).reshape(-1), dim)


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, final centroids) of ``vectors``.

    Vectors that are null, of another length or hold null or non-finite components are left out.
    The first centroids are the kept vectors of smallest id hash, fewer if there are fewer vectors;
    without any, both results are empty. Repeated rows and null ids are vectors of their own. All
    arithmetic is on integers; components beyond +-131072 are refused, as their distances would
    not fit. A round reads the stored vectors once and sends one row per task, cluster and component.
    """
    found = kept(vectors, dim)
    centroids = starting_points(found, clusters, seed, dim)
    if not len(centroids):
        return found.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    pivots = pivots_of(centroids)
    stored = with_pivots(found, pivots)
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, sums) in cluster_sums(stored, centroids, pivots).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():
            break  # every later round would give the same centroids
        centroids = moved
    return materialize(assigned(stored, centroids, pivots), "assigned"), centroids


def op13(vectors: DataFrame) -> DataFrame:
    found, centroids = cluster_vectors(vectors)
    exact = F.sum(F.col("distance").cast(T.DecimalType(38, 0)))
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(exact.alias("s")).collect()}
    spelled = [",".join(map(str, c.tolist())) for c in centroids]
    rows = [(c, s, sum(sums.values()), spelled[c]) for c, s in sums.items()]
    named = found.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid string"
    )
    # One row per cluster.
    return found.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("centroid", 256).alias("centroid_sha256")
    )


def _oracle() -> str:
    """The rounds written out, each an assignment and its new centroids."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""away{i} AS MATERIALIZED (
  SELECT r, c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(e, m)])::BIGINT AS d
  FROM v CROSS JOIN c{i}
), a{i} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS o FROM away{i}) WHERE o = 1
)""")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.m, o.m) AS m FROM c{i} AS o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS m FROM (
      SELECT c, pos, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
        SELECT c, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM a{i} JOIN v USING (r)
      ) GROUP BY c, pos
    ) GROUP BY c
  ) AS n USING (c)
)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
  FROM embeddings
  WHERE len(embedding) = {DIM} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, e) - 1 AS INTEGER) AS c, e AS m
  FROM v QUALIFY row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, e) <= {CLUSTERS}
), {", ".join(steps)}
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} USING (c)
"""


ORACLE = _oracle()
