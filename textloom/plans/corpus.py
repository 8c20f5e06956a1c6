"""The working tables that the registered queries start from."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.clean import hash_split, working_table
from textloom.operators.ordering import ordered_index
from textloom.operators.vectors import Vocabulary
from textloom.session import spread
from textloom.sources.articles import articles_from_documents

# The categories that are kept; the driver's documents have one more.
CATEGORIES = ["en", "fr", "es"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles_from_documents(table(spark, sf_dir, "documents"))


def complete_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, category, text) of all categories."""
    return working_table(articles(spark, sf_dir))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, category, text) of the kept categories, spread over the cluster for tokenizing."""
    documents = table(spark, sf_dir, "documents")
    return spread(working_table(articles_from_documents(documents), CATEGORIES), documents, "id")


def split_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with its ``split``."""
    return hash_split(corpus(spark, sf_dir))


def part(df: DataFrame, split: str) -> DataFrame:
    return df.filter(F.col("split") == split).drop("split")


def train_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part(split_corpus(spark, sf_dir), "train")


def word_vectors(spark: SparkSession, sf_dir: str, vocabulary: Vocabulary) -> DataFrame:
    """(term, vector): the i-th embedding stands for the i-th most frequent term."""
    ranked = ordered_index(vocabulary.table.select("term", "df"), F.desc("df"), "term", name="rank")
    embeddings = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("rank"), F.col("embedding").alias("vector")
    )
    return ranked.join(embeddings, "rank").select("term", "vector")


def marker_predictions(df: DataFrame) -> DataFrame:
    """(id, split, y, p): a rule that reads the category off frequent short words.

    Stands in for a trained model where metrics are checked against SQL.
    """
    padded = F.lower(F.col("text"))
    rule = (
        F.when(F.contains(padded, F.lit(" the ")), "en")
        .when(F.contains(padded, F.lit(" le ")), "fr")
        .when(F.contains(padded, F.lit(" el ")), "es")
        .otherwise("de")
    )
    return df.select("id", "split", F.col("category").alias("y"), rule.alias("p"))


def model_predictions(df: DataFrame) -> DataFrame:
    """(model, y, p) of two simple models: the word markers and always the first category."""
    marked = marker_predictions(df)
    models = F.array(
        F.struct(F.lit("markers").alias("model"), F.col("y"), F.col("p")),
        F.struct(F.lit("constant").alias("model"), F.col("y"), F.lit(CATEGORIES[0]).alias("p")),
    )
    return marked.select(F.inline(models))
