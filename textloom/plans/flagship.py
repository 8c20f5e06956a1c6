"""The flagship query: the words that characterise each category."""

from pyspark.sql import DataFrame, SparkSession

from textloom.operators.ranking import category_term_sums, top_terms
from textloom.operators.vectors import (
    fit_vocabulary,
    stored_bags,
    term_counts,
    term_weights,
    with_terms,
)
from textloom.plans.corpus import train_corpus


def top_words(
    spark: SparkSession, sf_dir: str, weighting: str = "tfidf", n: int = 10
) -> DataFrame:
    """(category, rank, term, weight): the heaviest words of each category in the training rows."""
    bag_table = stored_bags(train_corpus(spark, sf_dir))
    vocabulary = fit_vocabulary(bag_table)
    if weighting == "count":
        counts = term_counts(bag_table, vocabulary)
        long = counts.select("category", "term_id", counts.tf.cast("double").alias("weight"))
    else:
        long = term_weights(bag_table, vocabulary, weighting)
    top = top_terms(category_term_sums(long), n)
    return with_terms(top, vocabulary).select("category", "rank", "term", "weight")
