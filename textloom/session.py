"""Session settings and the shared folder that holds intermediate tables."""

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_session(cores="*", shuffle_partitions=8, memory="16g") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="textloom-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may do without it: the folder must be reachable from every
    executor, so on a cluster a missing setting is an error and not a local fallback.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/textloom/{name}-{uuid.uuid4().hex}"


# Shuffle files go as soon as the query that made them has ended, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _without_shuffles_left(spark: SparkSession):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    This cuts the lineage and survives the loss of executors, and later readers still get
    column pruning, filter pushdown and real size statistics. ``schema`` may rename the
    physical types on reading, which is how index/value pairs become ML vectors. What the write
    shuffled is not read again and does not stay on disk; shuffles of persisted tables do.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _without_shuffles_left(spark):
        df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def discard(*stored: DataFrame) -> None:
    """Remove the tables that ``materialize`` wrote and that nothing will read again."""
    for df in stored:
        spark = df.sparkSession
        for path in {file.rpartition("/")[0] for file in df.inputFiles()}:
            if path.split("/")[-2] == "textloom":
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, scan: DataFrame, key: str) -> DataFrame:
    """Repartition ``df`` by ``key`` only if ``scan`` yields too few splits for the cluster.

    A table of many files already has more splits than cores and is left as it is; one
    small file with a single row group would otherwise be tokenized by a single task.
    """
    wanted = 2 * df.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, key)
