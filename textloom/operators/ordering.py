"""Exact row numbers, samples, batches and shards without a single-task window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialize

# A hash bucket is named by this many hex digits, so there are at most 16**4 of them.
BUCKET_DIGITS = 4


def _hash_buckets(df: DataFrame, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their hash and bucket, and the bucket table with sizes and starts.

    The bucket table has at most 16**BUCKET_DIGITS rows whatever the data, which is what
    makes its ordered window and its broadcast safe.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    rows = df.withColumn("_hash", digest).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = (
        rows.groupBy("_bucket")
        .agg(F.count("*").alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .withColumn("_total", F.sum("_size").over(everything))
    )
    return rows, buckets


def shuffled_index(
    df: DataFrame, key: str = "id", seed: int = 42, name: str = "row_index"
) -> DataFrame:
    """0-based position of every row in a seeded random permutation.

    The order is the hash of the unique ``key``; rows are numbered inside hash buckets of
    even size and shifted by the number of rows in the buckets before.
    """
    rows, buckets = _hash_buckets(df, key, seed)
    in_bucket = Window.partitionBy("_bucket").orderBy("_hash", key)
    starts = F.broadcast(buckets.select("_bucket", "_start"))
    return (
        rows.withColumn("_rank", F.row_number().over(in_bucket))
        .join(starts, "_bucket")
        .select(*df.columns, (F.col("_start") + F.col("_rank") - 1).alias(name))
    )


def exact_sample(df: DataFrame, fraction: float, key: str = "id", seed: int = 42) -> DataFrame:
    """Exactly ``round(fraction * n)`` rows (half to even) without replacement.

    Whole hash buckets are kept by a filter; only the one bucket in which the sample ends is
    shuffled and ranked, so the cost is one counting scan and one filtering scan.
    """
    rows, buckets = _hash_buckets(df, key, seed)
    wanted = F.bround(F.lit(fraction) * F.col("_total"), 0).cast("long")
    used = F.broadcast(
        buckets.withColumn("_left", wanted - F.col("_start"))
        .filter("_left > 0")
        .select("_bucket", "_left", "_size")
    )
    candidates = rows.join(used, "_bucket")
    whole = candidates.filter("_size <= _left").select(*df.columns)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    last = candidates.filter("_size > _left").withColumn("_rank", rank).filter("_rank <= _left")
    return whole.union(last.select(*df.columns))


def ordered_index(
    df: DataFrame, *keys: str, name: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """0-based position of every row in the order of ``keys`` (unique together).

    Rows are range-partitioned and sorted; the position inside a partition is kept in the
    written table, and only the partition sizes (one row each) are summed up in order. Unless
    ``partitions`` is given, adaptive execution merges neighbouring ranges that are small.
    """
    ranges = [partitions, *keys] if partitions else keys
    placed = materialize(
        df.repartitionByRange(*ranges)
        .sortWithinPartitions(*keys)
        .withColumn("_placed", F.monotonically_increasing_id()),
        "ordered",
    )
    # The id holds the partition in its upper bits and the position in its lower 33 bits.
    part = F.shiftright("_placed", 33)
    position = F.col("_placed").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + position).alias(name))
    )


def assign_batches(
    df: DataFrame,
    batch_size: int,
    shuffle: bool = False,
    workers: int = 1,
    key: str = "id",
    seed: int = 42,
) -> DataFrame:
    """Add ``batch``: consecutive groups of ``batch_size * workers`` rows, the last may be short."""
    indexed = _indexed(df, shuffle, key, seed)
    size = batch_size * max(1, workers)
    return indexed.withColumn("batch", F.floor(F.col("row_index") / size)).drop("row_index")


def assign_shards(
    df: DataFrame, n_shards: int, shuffle: bool = True, key: str = "id", seed: int = 42
) -> DataFrame:
    """Add ``shard``: rows dealt out in turn, so shard sizes differ by at most one row."""
    indexed = _indexed(df, shuffle, key, seed)
    return indexed.withColumn("shard", F.col("row_index") % n_shards).drop("row_index")


def repartition_by_shard(sharded: DataFrame, n_shards: int) -> DataFrame:
    """Place the rows of each shard together for workers that read one shard each."""
    return sharded.repartitionByRange(n_shards, "shard")


def planned_steps(n_rows: int, batch_size: int, epochs: int = 1, accumulate: int = 1,
                  max_steps: int = -1) -> int:
    """Optimizer steps of a run: a positive ``max_steps`` wins over the number of epochs."""
    if max_steps > 0:
        return max_steps
    if epochs < 1:
        raise ValueError("either max_steps or epochs must be positive")
    batches = -(-n_rows // batch_size)
    if batches < accumulate:
        raise ValueError("fewer batches in an epoch than are accumulated for one step")
    return batches // accumulate * epochs


def _indexed(df: DataFrame, shuffle: bool, key: str, seed: int) -> DataFrame:
    return shuffled_index(df, key, seed) if shuffle else ordered_index(df, key)
