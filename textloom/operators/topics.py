"""The words of topics, from any table of topic-term weights."""

from pyspark.sql import DataFrame

from textloom.operators.ranking import top_terms
from textloom.operators.vectors import Vocabulary, with_terms


def top_topic_words(terms: DataFrame, vocabulary: Vocabulary, n: int = 8) -> DataFrame:
    """(topic, rank, term, weight), heaviest first, from a (topic, term_id, weight) table."""
    top = top_terms(terms, n, group="topic")
    return with_terms(top, vocabulary).select("topic", "rank", "term", "weight")
