"""Projection, filters, cleaning and profiling of article tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its number of NULLs, in a single scan."""
    columns = list(columns or df.columns)
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return totals.unpivot([], columns, "column_name", "n_null")


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Keep complete rows. Plain IS NOT NULL filters are pushed down to the file scan."""
    for field in df.schema:
        if columns is None or field.name in columns:
            df = df.filter(F.col(field.name).isNotNull())
            if isinstance(field.dataType, T.DoubleType | T.FloatType):
                df = df.filter(~F.isnan(field.name))
    return df


def merge_text(
    df: DataFrame, parts=("title", "abstract"), name: str = "text", separator: str = ""
) -> DataFrame:
    """Join text columns, without a separator by default, and drop the parts."""
    columns = [F.col(p).cast("string") for p in parts]
    merged = F.concat_ws(separator, *columns) if separator else F.concat(*columns)
    return df.withColumn(name, merged).drop(*parts)


def keep_categories(df: DataFrame, categories: Sequence[str], column="category") -> DataFrame:
    return df.filter(F.col(column).isin(list(categories)))


def working_table(
    articles: DataFrame, categories: Sequence[str] | None = None, separator: str = ""
) -> DataFrame:
    """(id, category, text): complete articles of the wanted categories, text merged."""
    needed = ["id", "category", "title", "abstract"]
    df = drop_nulls(project(articles, needed), needed[1:])
    df = keep_categories(df, categories) if categories else df
    return merge_text(df, separator=separator)


def preview(df: DataFrame, n: int = 5, key: str = "id") -> DataFrame:
    """The first ``n`` rows in key order; Spark keeps only ``n`` rows per task for this."""
    return df.orderBy(key).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def funnel(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows left after each step, where steps apply one after the other; one scan for all."""
    passed = F.lit(True)
    totals = []
    for name, condition in steps.items():
        passed = passed & condition
        totals.append(F.count_if(passed).alias(name))
    return df.agg(*totals).unpivot([], list(steps), "step", "n_rows")


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def hash_split(
    df: DataFrame, text: str = "text", fraction: float = 0.8, seed: int = 42
) -> DataFrame:
    """Add ``split`` (train/test) from a hash of the text, so exact copies stay together."""
    digest = F.substring(F.md5(F.concat(F.col(text), F.lit(f"|{seed}"))), 1, 4)
    return df.withColumn(
        "split", F.when(digest < split_bound(fraction), "train").otherwise("test")
    )


def split_bound(fraction: float) -> str:
    """The string below which a share of ``fraction`` of all four-digit hex hashes sorts."""
    bound = round(fraction * 65536)
    return f"{bound:04x}" if bound < 65536 else "g"
