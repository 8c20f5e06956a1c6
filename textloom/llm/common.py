"""Helpers shared by the operators of this subpackage."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.lookup import lookup_join
from textloom.session import materialize, scratch_path, spread

# Tables measured above this size are joined by shuffle and never broadcast.
BROADCAST_BYTES = 32 << 20
# A null id joins as this value; the text hash beside it keeps such rows apart.
NULL_ID = -(1 << 63)
KEY = ["_llm_id", "_llm_th"]
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def balanced(scan: DataFrame, key: str = "doc_id") -> DataFrame:
    """``scan`` itself, or spread over all cores if it has too few splits for them."""
    return spread(scan, scan, key)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add the join key of a row: its id and a hash of its text.

    Rows that share both are equal in everything an operator reads, so one list of findings
    serves all of them and repeated ids with different texts stay apart.
    """
    return docs.withColumns(
        {
            KEY[0]: F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)),
            KEY[1]: F.xxhash64(F.col(text_col)),
        }
    )


def map_batches(
    df: DataFrame, fn: Callable[[list[list]], list], schema: str, inputs: list[str]
) -> DataFrame:
    """Run ``fn`` over the columns ``inputs`` of every Arrow batch.

    ``fn`` gets one Python list per input and returns one Arrow array or sequence per column
    of ``schema``, of any common length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = fn([c.to_pylist() for c in batch.columns])
            yield to_batch(columns, names, types)

    names, types = arrow_fields(df.sparkSession, schema)
    return df.select(*inputs).mapInArrow(run, schema)


def arrow_fields(spark: SparkSession, schema: str) -> tuple[list[str], list[pa.DataType]]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    return fields.names, fields.types


def to_batch(columns: list, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [
        c.cast(t) if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(columns, types)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def by_bytes(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[list]]:
    """Rebatch (id, ..., text) rows so that each list of columns holds about ``limit`` bytes of text.

    The text is the last column. A single text above the limit is a batch of its own.
    """
    rows: list[tuple] = []
    size = 0
    # Python objects of few rows at once: a whole Arrow batch may hold thousands of long texts.
    parts = (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, len(b), ROWS_AT_ONCE))
    for part in parts:
        lengths = pc.fill_null(pc.binary_length(part.column(part.num_columns - 1)), 0).to_pylist()
        for row, length in zip(zip(*(c.to_pylist() for c in part.columns)), lengths):
            if rows and size + length > limit:
                yield [list(c) for c in zip(*rows)]
                rows, size = [], 0
            rows.append(row)
            size += length
    if rows:
        yield [list(c) for c in zip(*rows)]


def sized_join(rows: DataFrame, lookup: DataFrame, key: list[str], how: str = "left") -> DataFrame:
    """Join with a stored table of one row per key: broadcast only if measured to be small."""
    size = stored_bytes(lookup)
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(lookup), key, how)
    return rows.join(lookup.hint("merge"), key, how)


def sized_lookup(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """As ``sized_join`` for one key whose hot values may hold a large share of ``rows``."""
    return lookup_join(rows, lookup, key, how, limit=BROADCAST_BYTES)


def stored_bytes(df: DataFrame) -> int:
    """Rows times width in memory, arrays and strings by their measured length."""
    from textloom.operators.lookup import measured

    rows, size = measured(df)
    return int(size or 0) + 16 * int(rows)


def local_roots(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the links (a, b) into ``roots``, where every index points at a smaller one or itself."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return roots
        a, b = ra[apart], rb[apart]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = roots[roots]
            if np.array_equal(up, roots):
                break
            roots = up


__all__ = [
    "BROADCAST_BYTES",
    "KEY",
    "NULL_ID",
    "arrow_fields",
    "balanced",
    "by_bytes",
    "keyed",
    "local_roots",
    "map_batches",
    "materialize",
    "scratch_path",
    "sized_join",
    "sized_lookup",
    "stored_bytes",
    "table",
    "to_batch",
]
