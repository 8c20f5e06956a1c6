import hashlib

import pytest
from pyspark.sql import functions as F

from textloom.operators import lookup, ordering


def hash_order(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}|{seed}".encode()).hexdigest())


def test_shuffled_index_is_the_hash_order(spark):
    rows = ordering.shuffled_index(spark.range(500)).orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(500))
    assert [r["id"] for r in rows] == hash_order(range(500))


@pytest.mark.parametrize(("n", "fraction", "expected"), [(10, 0.25, 2), (14, 0.25, 4), (99, 1.0, 99), (7, 0.0, 0)])
def test_sample_is_exact(spark, n, fraction, expected):
    ids = [r["id"] for r in ordering.exact_sample(spark.range(n), fraction).collect()]
    assert sorted(ids) == sorted(hash_order(range(n))[:expected])


def test_ordered_index_over_strings(spark):
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("word"))
    rows = ordering.ordered_index(df, "word").orderBy("word").collect()
    assert [r["row_index"] for r in rows] == list(range(3000))


def test_batches_and_shards(spark):
    batches = ordering.assign_batches(spark.range(100), 8, workers=2).groupBy("batch").count()
    assert sorted(r["count"] for r in batches.collect()) == [4] + [16] * 6
    shards = ordering.assign_shards(spark.range(100), 8).groupBy("shard").count()
    assert {r["count"] for r in shards.collect()} == {12, 13}
    placed = ordering.repartition_by_shard(ordering.assign_shards(spark.range(100), 4), 4)
    per_task = placed.groupBy(F.spark_partition_id()).agg(F.count_distinct("shard").alias("n"))
    assert {r["n"] for r in per_task.collect()} == {1}


def test_planned_steps():
    assert ordering.planned_steps(100, 32, epochs=2, accumulate=2) == 4
    assert ordering.planned_steps(100, 32, max_steps=7) == 7
    with pytest.raises(ValueError):
        ordering.planned_steps(100, 32, epochs=0)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_large_table_with_hot_and_missing_keys(spark, how):
    """The split into hot and cold keys gives what a plain join gives."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 500)
    rows = spark.range(3000).select("id", key.alias("k"))
    table = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    expected = rows.join(table, "k", how).select("id", "k", "v")
    got = lookup.lookup_join(rows, table, "k", how, limit=0).select("id", "k", "v")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert lookup.hot_keys(rows, "k", 0.2).collect() == [(0,)]


def test_small_table_is_broadcast_and_large_is_not(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    table = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))

    def plan(df):
        return df._jdf.queryExecution().analyzed().toString()

    assert "broadcast" in plan(lookup.lookup_join(rows, table, "k")).lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    large = lookup.lookup_join(rows, table, "k", limit=0)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert large.count() == 10


def test_planned_steps_needs_a_full_accumulation():
    with pytest.raises(ValueError):
        ordering.planned_steps(10, 32, 1, 2)
