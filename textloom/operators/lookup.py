"""Equi-joins of many rows with a lookup table, safe for large tables and hot keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import materialize

# Tables measured to be larger than this are never broadcast.
BROADCAST_BYTES = 64 << 20
# A key is hot if it holds at least this share of the rows, so at most 1000 keys are hot.
HOT_SHARE = 0.001


def measured(table: DataFrame) -> tuple[int, int]:
    """Rows and size in bytes of a table's values, from one aggregation over it."""
    widths = [str(8 * len(table.columns))]
    for field in table.schema:
        if isinstance(field.dataType, T.StringType):
            widths.append(f"coalesce(octet_length(`{field.name}`), 0)")
        elif isinstance(field.dataType, T.ArrayType):
            widths.append(f"8 * greatest(size(`{field.name}`), 0)")
    total = F.expr(f"coalesce(sum(cast({' + '.join(widths)} AS bigint)), 0)")
    return table.agg(F.count("*"), total).first()


def table_bytes(table: DataFrame) -> int:
    return measured(table)[1]


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    how: str = "inner",
    size: int | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``rows`` with ``table`` (one row per ``key``), inner or left.

    A table whose measured size is within ``limit`` is broadcast. Beyond it the keys that
    hold a large share of the rows, at most ``1 / HOT_SHARE`` of them by counting, are split
    off and joined by broadcasting their few table rows, so that the shuffle join of the
    rest sees no hot key. Both parts together are the whole result.
    """
    size = table_bytes(table) if size is None else size
    if size <= limit:
        return rows.join(F.broadcast(table), key, how)
    hot = materialize(hot_keys(rows, key), "hot-keys")
    hot_rows = rows.join(F.broadcast(hot), key, "left_semi")
    cold_rows = rows.join(F.broadcast(hot), key, "left_anti")
    hot_table = table.join(F.broadcast(hot), key, "left_semi")
    joined_hot = hot_rows.join(F.broadcast(hot_table), key, how)
    # NULL keys match nothing; the outer join would send all of them to one task.
    joined_cold = cold_rows.filter(F.col(key).isNotNull()).join(table, key, how)
    result = joined_hot.unionByName(joined_cold)
    if how == "left":
        missing = cold_rows.filter(F.col(key).isNull())
        result = result.unionByName(missing, allowMissingColumns=True)
    return result


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The at most ``1 / share`` keys that hold at least ``share`` of all rows each."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total = rows.count()
    return counts.filter((F.col("_n") >= share * total) & F.col(key).isNotNull()).select(key)
