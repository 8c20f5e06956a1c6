"""Corpus pipeline: language filter, near and passage deduplication, decontamination, encoding."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontaminate, language, simhash, substring
from textloom.llm.common import KEY, NULL_ID, balanced, keyed, materialize, sized_join, table

# SQL cannot express language models and tokenizers; each stage is tested against brute force.
ORACLE_SQL = None


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, so that no name can clash with a new column."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias("_none")).alias("_rest"))


def unpacked(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return found.select(*(c if c in ("doc_id", "text") else F.col("_rest")[c].alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a recognised language; texts without a letter go.

    If no language can be learned, since no row has both text and a language, every text with a
    letter stays.
    """
    model = language.fit(docs.select("doc_id", "text", "lang"))
    if not model["langs"]:
        return docs.filter(language.has_letter("text"))
    found = language.predict(balanced(packed(docs)), model)
    return unpacked(found.filter(F.col("lang_pred") != language.UNDECIDED), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the smallest doc_id, null ids last.

    Near duplicates are linked by SimHash fingerprints over 4-word shingles that differ in at most
    4 bits. Null, empty and wordless texts form one group. Rows are told apart by id and text, so
    unrelated texts stay whatever their ids. Of several texts of a group with the smallest id the
    one with the smallest hash stays, of rows equal in both the one whose other columns come first
    as JSON.
    """
    found = simhash.near_duplicates(docs.select("doc_id", "text"), simhash.SHINGLE_WORDS, simhash.MAX_BITS)
    named = F.coalesce("doc_id", F.lit(NULL_ID))
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), named.alias(KEY[0]), F.col("text_hash").alias(KEY[1]))
    first = found.groupBy("root").agg(F.min(row).alias("_kept"))
    first = materialize(first.select(*(F.col(f"_kept.{k}") for k in KEY)), "kept")
    found = sized_join(keyed(packed(docs), "doc_id", "text"), first, KEY, "inner")
    one = F.min_by(F.struct("doc_id", "text", "_rest"), F.to_json("_rest")).alias("_row")
    return unpacked(found.groupBy(*KEY).agg(one).select("_row.*"), docs)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated passages out of the texts; other texts stay as they are.

    Null and empty texts have no passages and stay null and empty; every row stays, repeated rows
    each, which cover each other's windows.
    """
    cut = substring.remove_repeats(packed(docs))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return unpacked(cut.withColumn("text", text), docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark.

    Null and empty texts hold none and stay; repeated rows stay or go together; null and empty
    items match nothing.
    """
    clean = decontaminate.drop_contaminated(balanced(packed(docs)), table(spark, sf_dir, "benchmark"))
    return unpacked(clean, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining document; null and empty texts have none, repeated rows each."""
    return bpe.encode_texts(balanced(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", remove_passages),
    ("decontamination", decontaminate_benchmark),
    ("bpe_encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
