"""Label codes: sorted distinct labels of the training table, numbered from 0."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.lookup import lookup_join


def fit_labels(train: DataFrame, column: str = "category") -> DataFrame:
    """(category, code). The window orders distinct labels only, one row per class."""
    distinct = train.filter(F.col(column).isNotNull()).select(column).distinct()
    code = F.row_number().over(Window.orderBy(column)) - 1
    return distinct.withColumn("code", code.cast("long"))


def unseen_labels(df: DataFrame, labels: DataFrame, column: str = "category") -> DataFrame:
    """(category, n_rows) of labels that the training table does not have."""
    counts = df.groupBy(column).agg(F.count("*").alias("n_rows"))
    return counts.join(labels, column, "left_anti")


def encode_labels(df: DataFrame, labels: DataFrame, column: str = "category") -> DataFrame:
    """Add ``code``; a label without a code stops the job when the row is computed."""
    message = F.concat(F.lit("label not seen in training: "), F.coalesce(column, F.lit("NULL")))
    joined = lookup_join(df, labels, column, "left")
    return joined.withColumn("code", F.coalesce("code", F.raise_error(message).cast("long")))


def decode_labels(df: DataFrame, labels: DataFrame, column: str = "category") -> DataFrame:
    """Add the label of every ``code``."""
    return lookup_join(df, labels.select("code", column), "code", "left")
