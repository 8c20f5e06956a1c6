"""Text as fixed-length id sequences, selected by model family."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.sequences import (
    MAX_SEQUENCE_LENGTH,
    RESERVED_IDS,
    UNKNOWN_ID,
    attention_mask,
    clamp_length,
    padded,
    segment_ids,
    with_markers,
)
from textloom.functions.text import plain_words
from textloom.operators.lookup import lookup_join
from textloom.operators.vectors import CONTENT, Vocabulary, content_hash, repeated, row_copies

# Supported model families, and those without segment ids.
FAMILIES = [
    "albert", "bart", "bert", "camembert", "distilbert",
    "flaubert", "roberta", "xlm", "xlnet",
]
WITHOUT_SEGMENTS = ["distilbert", "bart"]


def column_name(df: DataFrame, column: str | int) -> str:
    """A column given by name or by position."""
    if isinstance(column, bool) or not isinstance(column, str | int):
        raise TypeError("a column is given by its name or its position")
    if isinstance(column, int):
        return df.columns[column]
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    return column


def encode(
    df: DataFrame,
    vocabulary: Vocabulary,
    text: str | int = "text",
    label: str | int | None = None,
    max_len: int = MAX_SEQUENCE_LENGTH,
    tokenizer: Callable[[Column], Column] = plain_words,
    key: str = "id",
) -> DataFrame:
    """(key, input_ids, attention_mask, token_type_ids[, label]), all of length ``max_len``.

    Only the words that fit are looked up; unknown words get the unknown id. The words of one
    document are regrouped by its key and a hash of them, so rows that repeat a key stay rows of
    their own; they are never more than ``max_len``.
    """
    text_name = column_name(df, text)
    label_name = None if label is None else column_name(df, label)
    max_len = clamp_length(max_len)
    keys = [F.col(key)] + ([F.col(label_name).alias("label")] if label_name else [])
    names = [key] + (["label"] if label_name else [])
    words = F.slice(tokenizer(F.col(text_name)), 1, max_len - 2)
    cut = df.select(*keys, words.alias("_words"))
    long = cut.select(
        *names, content_hash("_words").alias(CONTENT), F.posexplode_outer("_words").alias("_pos", "term")
    )
    known = vocabulary.table.select("term", "term_id")
    joined = lookup_join(long, known, "term", "left", size=vocabulary.size)
    word_id = F.coalesce(F.col("term_id") + RESERVED_IDS, F.lit(UNKNOWN_ID))
    placed = F.when(F.col("_pos").isNotNull(), F.struct("_pos", word_id.alias("word_id")))
    ids = F.sort_array(F.collect_set(placed))["word_id"]
    sequences = joined.groupBy(*names, CONTENT).agg(ids.alias("_ids"), row_copies())
    encoded = repeated(sequences).withColumn("input_ids", padded(with_markers(F.col("_ids"), max_len), max_len))
    return encoded.select(
        key,
        "input_ids",
        attention_mask(F.col("input_ids")).alias("attention_mask"),
        segment_ids(max_len).alias("token_type_ids"),
        *names[1:],
    )


def model_inputs(encoded: DataFrame, model_name: str, train: bool = True) -> DataFrame:
    """The input columns of a model: the label only for training, segments if it has them."""
    family = model_name.split("-")[0]
    if family not in FAMILIES:
        raise ValueError(f"model not supported: {model_name}")
    wanted = ["id", "input_ids", "attention_mask"]
    if family not in WITHOUT_SEGMENTS:
        wanted.append("token_type_ids")
    if train:
        wanted.append("label")
    return encoded.select(*wanted)
