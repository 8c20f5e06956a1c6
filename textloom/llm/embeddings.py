"""Near-duplicate vectors by randomised-rotation binary codes with correction factors."""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import local_roots, materialize, sized_join
from textloom.llm.components import components

MIN_COSINE = 0.93
# Sign bits per bucket and number of bucketings: a pair at the threshold differs in 12 % of its
# sign bits, so it shares none of the buckets with a probability of about 3e-5.
BITS = 10
TABLES = 32
# Standard deviations of the estimate within which a pair is recomputed exactly.
BOUND = 4.0
BLOCK = 2048
SEED = 7


@cache
def rotation(dim: int, turn: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, turn]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def bucket_codes(unit: np.ndarray) -> np.ndarray:
    """(vectors, TABLES): the bucket of each vector in each bucketing, from rotated sign bits."""
    dim, need = unit.shape[1], BITS * TABLES
    turns = [unit @ rotation(dim, t + 1) > 0 for t in range(-(-need // dim))]
    bits = np.concatenate(turns, 1)[:, :need].reshape(len(unit), TABLES, BITS)
    return bits @ (1 << np.arange(BITS))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def stored_codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign codes, correction factors) of unit vectors after a random rotation."""
    turned = unit @ rotation(unit.shape[1], 0)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def block_links(
    unit: np.ndarray, code: np.ndarray, factor: np.ndarray, rows: np.ndarray, cols: np.ndarray, min_cosine: float
) -> Iterator[tuple]:
    """Index pairs (i of rows, j of cols) with an exact cosine of at least ``min_cosine``.

    The estimate of <q, o> is <q, code of o> / factor of o; its error has the standard deviation
    sqrt((1 - f^2) / f^2 / (dim - 1)) with f the factor. A pair whose upper confidence bound is
    below the threshold is dropped, the others are recomputed in double precision.
    """
    dim = unit.shape[1]
    turned = (unit[rows] @ rotation(dim, 0)).astype(np.float32)
    signs = np.unpackbits(code[cols], axis=1, count=dim).astype(np.float32) * 2 - 1
    signs /= np.float32(np.sqrt(dim))
    factor = factor[cols]
    error = np.sqrt(np.maximum(0, 1 - factor**2) / factor**2 / max(1, dim - 1))
    floor = ((min_cosine - BOUND * error) * factor).astype(np.float32) - np.float32(1e-4)
    for at in range(0, len(rows), 1024):
        i, j = np.nonzero(turned[at : at + 1024] @ signs.T >= floor)
        for part in range(0, len(i), 1 << 16):
            a, b = rows[i[part : part + (1 << 16)] + at], cols[j[part : part + (1 << 16)]]
            near = (unit[a] * unit[b]).sum(axis=1) >= min_cosine
            yield a[near], b[near]


def by_dim(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, unit vectors) of the rows of each vector length in a batch."""
    sizes = batch.column(column).value_lengths().to_numpy()
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        flat = batch.column(column).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, units(flat.astype(float).reshape(len(at), dim))


def classes(vectors: DataFrame) -> DataFrame:
    """Comparable vectors with exact copies taken together and their codes, stored once.

    (cid, label, embedding, first, copies, code, factor): a code has a bit and a factor per
    vector, which every block of the search reads again.
    """
    clean = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    clean = clean & F.exists("embedding", lambda x: x != 0)
    usable = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & clean)
    grouped = usable.groupBy("label", "embedding").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies")
    )
    grouped = grouped.select("label", "embedding", "first", "copies")
    schema = T.StructType([*grouped.schema.fields]).add("code", "binary").add("factor", "double")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, unit in by_dim(batch, 1):
                code, factor = stored_codes(unit)
                part = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor)],
                    names=schema.names,
                )

    coded = grouped.mapInArrow(encode, schema)
    return materialize(coded.withColumn("cid", F.monotonically_increasing_id()), "classes")


def bucketed(found: DataFrame) -> DataFrame:
    """One row per vector and bucketing: (label, cid, copies, vector, code, factor, dim, band, bucket)."""
    carried = ["label", "cid", "copies", "embedding", "code", "factor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, unit in by_dim(batch, 3):
                again = np.repeat(at, TABLES)
                band = np.tile(np.arange(TABLES, dtype=np.int32), len(at))
                bucket = bucket_codes(unit).reshape(-1).astype(np.int32)
                dim = np.full(len(again), unit.shape[1], np.int32)
                wide = batch.take(pa.array(again))
                new = [pa.array(dim), pa.array(band), pa.array(bucket)]
                yield pa.RecordBatch.from_arrays([*wide.columns, *new], names=[*carried, "dim", "band", "bucket"])

    schema = T.StructType([found.schema[c] for c in carried])
    for name in ("dim", "band", "bucket"):
        schema = schema.add(name, "integer")
    return found.select(*carried).mapInArrow(run, schema)


def link_rows(min_cosine: float):
    """Links of sorted block rows: (cid, copies linked, cid of the root of its links here)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            group = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(group[1:] != group[:-1]) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(group)]):
                part = batch.slice(lo, hi - lo)
                if held and held[-1].column(0)[0] != part.column(0)[0]:
                    yield from solve(held)
                    held = []
                held.append(part)
        if held:
            yield from solve(held)

    def solve(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        if len(whole) < 2:
            return
        band, chunk, left, right = (whole.column(i).to_numpy() for i in (1, 2, 3, 4))
        cid, copies = whole.column(5).to_numpy(), whole.column(6).to_numpy()
        dim = len(whole.column(7)[0])
        flat = whole.column(7).flatten().to_numpy(zero_copy_only=False).astype(float)
        unit = units(flat.reshape(len(whole), dim))
        code = np.frombuffer(b"".join(whole.column(8).to_pylist()), np.uint8).reshape(len(whole), -1)
        factor = whole.column(9).to_numpy()
        codes = bucket_codes(unit)
        same = left[0] == right[0]
        rows = np.arange(len(whole)) if same else np.flatnonzero(chunk == left[0])
        cols = rows if same else np.flatnonzero(chunk == right[0])
        links, roots = np.zeros(len(whole), np.int64), np.arange(len(whole))
        for i, j in block_links(unit, code, factor, rows, cols, min_cosine):
            # A pair counts in the first bucketing that it shares, and once.
            new = ~(codes[i, : band[0]] == codes[j, : band[0]]).any(axis=1)
            new &= (i < j) if same else (cid[i] != cid[j])
            i, j = i[new], j[new]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            roots = local_roots(roots, i, j)
        out = np.flatnonzero(links)
        if len(out):
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[out]), pa.array(links[out]), pa.array(cid[roots[out]])],
                names=["cid", "links", "root"],
            )

    return run


def class_links(found: DataFrame, min_cosine: float = MIN_COSINE, block: int = BLOCK) -> DataFrame:
    """(cid, links, root) per class and block with links.

    A bucket of more than ``block`` vectors is cut into chunks, and every pair of chunks is a
    block of its own: each row goes to as many blocks as there are chunks in its bucket.
    """
    spread = bucketed(found)
    keys = ["label", "dim", "band", "bucket"]
    sizes = spread.groupBy(*keys).count().filter(F.col("count") > block)
    large = materialize(sizes.withColumn("chunks", F.ceil(F.col("count") / block).cast("int")).drop("count"), "blocks")
    if large.isEmpty():
        cut = spread.withColumn("chunks", F.lit(1))
    else:
        cut = sized_join(spread, large, keys).withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    cut = cut.withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cut = cut.withColumns({"left": F.least("chunk", "other"), "right": F.greatest("chunk", "other")})
    blocks = [*keys, "left", "right"]
    cut = cut.withColumn("block", F.xxhash64(*blocks))
    columns = ["block", "band", "chunk", "left", "right", "cid", "copies", "embedding", "code", "factor"]
    order = ["block", *blocks]
    placed = cut.repartition(*blocks).sortWithinPartitions(*order)
    return placed.select(*columns).mapInArrow(link_rows(min_cosine), "cid long, links long, root long")


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Rows of one label (not null) whose cosine in double precision is at least ``min_cosine`` are
    linked. Candidates share the sign bits of at least one of several random rotations (a pair at
    the threshold is missed with a probability below 1e-4, measured in the tests), exact copies are found by grouping and
    counted without listing their pairs. Null, empty and zero vectors and those with null or
    non-finite components link with nothing, nor do vectors of different lengths. Repeated rows
    are vectors of their own and link with each other.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    found = classes(rows)
    links = materialize(class_links(found, min_cosine), "class-links")
    total = links.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    joined = (
        found.select("cid", "first", "copies")
        .join(total, "cid", "left")
        .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("root", F.coalesce("root", "cid"))
    )
    lowest = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    joined = joined.join(lowest, "root").select(
        "cid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    named = materialize(found.select("cid", "label", "embedding").join(joined, "cid").drop("cid"), "named")
    result = sized_join(rows, named, ["label", "embedding"])
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT r, vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(e) > 0
    AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
    AND list_sum([abs(x) for x in e]) > 0
), links AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS other
  FROM good AS a JOIN good AS b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(r, far) AS (
  SELECT r, r FROM v
  UNION
  SELECT reach.r, links.b FROM reach JOIN links ON reach.far = links.a
), roots AS (
  SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.far = v.r GROUP BY reach.r
), degrees AS (
  SELECT a AS r, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN roots USING (r) LEFT JOIN degrees USING (r)
"""
