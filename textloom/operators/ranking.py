"""Category counts, memberships and the terms that characterise each category."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.ordering import shuffled_index


def category_counts(df: DataFrame, column: str = "category") -> DataFrame:
    """Rows per category, largest first, NULL not counted."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def category_members(df: DataFrame, column: str = "category", seed: int = 42) -> DataFrame:
    """(category, row_index, id): the rows of every category by their row number.

    Membership stays one row per article, as a category may hold most of the table.
    """
    return shuffled_index(df.select("id", column), seed=seed).select(column, "row_index", "id")


def category_term_sums(
    weights: DataFrame, column: str = "category", digits: int = 6
) -> DataFrame:
    """Sum of term weights per category; rounded so that ranks do not hang on summing order."""
    return weights.groupBy(column, "term_id").agg(
        F.round(F.sum("weight"), digits).alias("weight")
    )


def top_terms(
    sums: DataFrame, n: int = 10, group: str = "category", tie: str = "term_id"
) -> DataFrame:
    """The ``n`` heaviest terms per group with ``rank`` 1 for the heaviest.

    Term ids follow the order of the terms, so ties go to the first term. Spark cuts every
    task to ``n`` rows per group before it shuffles by group.
    """
    order = Window.partitionBy(group).orderBy(F.desc("weight"), tie)
    return (
        sums.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= n)
        .select(group, "rank", tie, "weight")
    )
