"""Products of a sparse document-term table with narrow factor tables.

The matrix X is kept in blocks of whole rows. A factor table holds one row per document or per term
and ``k`` numeric columns ``c0 .. c{k-1}``; a block gets the factor rows of its own terms and gives
back one partial sum for each. Only k-by-k matrices ever reach the driver.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.vectors import BLOCK
from textloom.session import materialize

# Larger blocks share more terms, so fewer factor rows travel; a block is read into one task.
ROWS_PER_BLOCK = 16_384
ROW = "_row"


def numbered(rows: DataFrame, name: str = "numbered-rows") -> DataFrame:
    """Stored rows with a number each, which tells rows that repeat an id apart.

    The numbers are written with the rows and so the same whenever they are read.
    """
    return materialize(rows.withColumn(ROW, F.monotonically_increasing_id()), name)


def with_keys(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The key columns of numbered ``rows`` beside the results of their numbers in ``id``."""
    keys = [c for c in rows.columns if c not in (ROW, "indices", "values")]
    return rows.select(ROW, *keys).join(found.withColumnRenamed("id", ROW), ROW, "left").drop(ROW)


def columns(k: int, prefix: str = "c") -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


@dataclass(frozen=True)
class Blocks:
    """A stored sparse matrix in blocks of rows, kept for the iterations, and the terms of each block.

    ``cells`` (block, row, indices, values) is placed by block, ``terms`` (term_id, of) by term.
    Factor rows travel to a block once per distinct term in it, not once per entry.
    """

    cells: DataFrame
    terms: DataFrame

    def unpersist(self) -> None:
        self.cells.unpersist()
        self.terms.unpersist()


def block_numbers(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers of which hash partitioning puts one into each of ``n`` partitions."""
    found, tried = {}, 0
    while len(found) < n:
        part = F.pmod(F.hash("id"), F.lit(n)).alias("part")
        dealt = spark.range(tried, tried + 16 * n).groupBy(part).agg(F.min("id").alias("id"))
        found = {r["part"]: r["id"] for r in dealt.collect()} | found
        tried += 16 * n
    return list(found.values())


def blocks_of(rows: DataFrame) -> Blocks:
    """Numbered stored ``rows`` in blocks, one per task; rows without entries are left out.

    Rows are dealt by a hash of their number, so that copies and long ids spread evenly. Lost blocks
    are computed again from the stored rows.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n = cores * max(1, -(-rows.count() // (ROWS_PER_BLOCK * cores)))
    number = F.element_at(F.lit(block_numbers(spark, n)), F.pmod(F.xxhash64(ROW), F.lit(n)).cast("int") + 1)
    filled = rows.filter(F.size("indices") > 0).select(number.cast("long").alias(BLOCK), ROW, "indices", "values")
    cells = filled.repartition(n, BLOCK).sortWithinPartitions(BLOCK, ROW).persist(StorageLevel.MEMORY_AND_DISK)
    ids = F.explode(F.col("indices").cast("array<long>")).alias("term_id")
    terms = cells.select(F.col(BLOCK).alias("of"), ids).distinct().repartition(n, "term_id")
    return Blocks(cells, terms.sortWithinPartitions("term_id").persist(StorageLevel.MEMORY_AND_DISK))


class Cells:
    """The entries of a block beside the factor rows of its terms; terms without a row are dropped."""

    def __init__(self, rows: pa.Table, factor: pa.Table, k: int):
        ids = factor.column("term_id").to_numpy()
        order = np.argsort(ids)
        self.terms, self.rows = ids[order], rows.column(ROW).to_numpy()
        self.factor = [factor.column(c).to_numpy()[order] for c in columns(k)]
        indices, values = (rows.column(c).combine_chunks() for c in ("indices", "values"))
        lengths = indices.value_lengths().to_numpy(zero_copy_only=False)
        flat = indices.flatten().to_numpy(zero_copy_only=False)
        place = np.searchsorted(self.terms, flat)
        known = np.append(self.terms, -1)[place] == flat
        self.row = np.repeat(np.arange(len(lengths)), lengths)[known]
        self.place, self.x = place[known], values.flatten().to_numpy(zero_copy_only=False)[known]

    def product(self) -> np.ndarray:
        """(rows, k): the rows times the factor."""
        n = len(self.rows)
        return np.stack([np.bincount(self.row, self.x * f[self.place], n) for f in self.factor], axis=1)

    def back(self, given: np.ndarray) -> np.ndarray:
        """(terms of the block, k): the transposed rows times (rows, k) values."""
        n = len(self.terms)
        return np.stack([np.bincount(self.place, self.x * g[self.row], n) for g in given.T.copy()], axis=1)


def keyed(key: str, keys: np.ndarray, values: np.ndarray, **others) -> pa.Table:
    """An Arrow table of a key, other columns and the factor columns."""
    names = columns(values.shape[1])
    return pa.table({key: pa.array(keys, pa.int64()), **others, **dict(zip(names, map(pa.array, values.T.copy()), strict=True))})


def keyed_schema(key: str, k: int, *others: str) -> str:
    return ", ".join([f"{key} long", *others, *(f"{c} double" for c in columns(k))])


def by_block(
    blocks: Blocks, factor: DataFrame, k: int, run: Callable, schema: str, documents: DataFrame | None = None
) -> DataFrame:
    """``run(rows, factor rows)`` on every block and the rows of a term factor that it needs.

    Rows of ``documents`` (of, term_id, c0..) come to their block beside them.
    """
    needed = blocks.terms.join(factor.select(F.col("term_id").cast("long").alias("term_id"), *columns(k)), "term_id")
    if documents is not None:
        needed = needed.unionByName(documents)
    return blocks.cells.groupBy(BLOCK).cogroup(needed.groupBy("of")).applyInArrow(run, schema)


def times_terms(blocks: Blocks, table: DataFrame, k: int) -> DataFrame:
    """X times a term factor: one row (id, c0..) per document with entries."""

    def run(rows: pa.Table, factor: pa.Table) -> pa.Table:
        cells = Cells(rows, factor, k)
        return keyed("id", cells.rows, cells.product())

    return by_block(blocks, table, k, run, keyed_schema("id", k))


def gram_times(blocks: Blocks, table: DataFrame, k: int) -> DataFrame:
    """X transposed times X times a term factor: one row (term_id, c0..) per term."""

    def run(rows: pa.Table, factor: pa.Table) -> pa.Table:
        cells = Cells(rows, factor, k)
        return keyed("term_id", cells.terms, cells.back(cells.product()))

    found = by_block(blocks, table, k, run, keyed_schema("term_id", k))
    return found.groupBy("term_id").agg(*(F.sum(c).alias(c) for c in columns(k)))


def hash_uniform(seed: int, key: str, column: int) -> str:
    """SQL for a number in (0, 1] that depends on key, column and seed only."""
    bits = (1 << 52) - 1
    return f"((xxhash64({seed}, {key}, {column}) & {bits}L) + 1) / {float(1 << 52)!r}D"


def right_multiply(matrix: np.ndarray, prefix: str = "c") -> list[str]:
    """SQL for the row of factor columns times a small matrix, one expression per column.

    Generated columns are SQL text, as building each of them from Column calls would cost
    far more round trips to the JVM than the sums themselves take.
    """
    rows, cols = matrix.shape
    names = columns(rows, prefix)
    return [
        "(" + " + ".join(f"{names[i]} * {float(matrix[i, j])!r}D" for i in range(rows)) + ")"
        for j in range(cols)
    ]


def _sums(products: list[str]) -> Column:
    return F.expr("array(" + ", ".join(f"coalesce(sum({p}), 0D)" for p in products) + ")")


def gram_sums(k: int, prefix: str = "c") -> Column:
    """The upper triangle of the symmetric matrix of column products, as one array of sums."""
    names = columns(k, prefix)
    return _sums([f"{names[i]} * {names[j]}" for i in range(k) for j in range(i, k)])


def cross_sums(k: int, left: str, right: str) -> Column:
    """The entries of leftᵀ right, row by row, as one array of sums."""
    return _sums([f"{a} * {b}" for a in columns(k, left) for b in columns(k, right)])


def symmetric(upper: Sequence[float], k: int) -> np.ndarray:
    """The k-by-k matrix from its upper triangle."""
    matrix = np.zeros((k, k))
    matrix[np.triu_indices(k)] = upper
    return matrix + np.triu(matrix, 1).T


def gram(table: DataFrame, k: int, prefix: str = "c") -> np.ndarray:
    return symmetric(table.agg(gram_sums(k, prefix)).first()[0], k)


def renamed(table: DataFrame, key: str, k: int, prefix: str) -> DataFrame:
    """The factor table with another column prefix, to join two factors."""
    return table.selectExpr(
        key, *[f"{c} AS {b}" for c, b in zip(columns(k), columns(k, prefix), strict=True)]
    )
