"""Multinomial naive Bayes over encoded id sequences, as joins and sums."""

import math
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.arrays import argmax
from textloom.functions.sequences import RESERVED_IDS
from textloom.operators.lookup import lookup_join, table_bytes
from textloom.operators.vectors import CONTENT, content_hash, repeated, row_copies
from textloom.session import materialize


@dataclass(frozen=True)
class SequenceBayes:
    """Log-probabilities of a fit.

    ``tokens`` holds (token_id, logs) for the ids of the training rows, one value per label in
    ascending order; an id without a row has ``unseen``. ``labels`` and ``priors`` run likewise.
    """

    tokens: DataFrame
    labels: list[int]
    priors: list[float]
    unseen: list[float]


def token_ids(encoded: DataFrame, *keys: str) -> DataFrame:
    """(keys, token_id): the masked-in ids of every sequence without the markers around them."""
    real = F.arrays_zip("input_ids", "attention_mask")
    kept = F.filter(real, lambda x: (x["attention_mask"] == 1) & (x["input_ids"] >= RESERVED_IDS))
    return encoded.select(*keys, F.transform(kept, lambda x: x["input_ids"]).alias("_ids"))


def fit_sequence_bayes(encoded: DataFrame, size: int, alpha: float = 1.0) -> SequenceBayes:
    """Fit (input_ids, attention_mask, label) rows over a vocabulary of ``size`` ids.

    P(id | label) = (count + alpha) / (ids of the label + alpha * size). Only real words count:
    padding, unknown words and markers are left out. Rows without a label are not read. Counts are
    summed per task before the shuffle, so a label that holds most rows makes no large group;
    the driver sees one row per label.
    """
    labelled = encoded.filter("label IS NOT NULL")
    ids = token_ids(labelled, F.col("label").cast("long").alias("label"))
    per_label = ids.groupBy("label").agg(F.count("*").alias("rows"), F.sum(F.size("_ids")).alias("ids"))
    facts = sorted(map(tuple, per_label.collect()))
    every = sum(rows for _, rows, _ in facts)
    labels = [label for label, _, _ in facts]
    priors = [math.log(rows / every) for _, rows, _ in facts]
    totals = [(n or 0) + alpha * size for _, _, n in facts]
    counts = ids.select("label", F.explode("_ids").alias("token_id")).groupBy("token_id", "label").agg(F.count("*").alias("n"))
    held = counts.groupBy("token_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("n"))
    logs = [
        F.log((F.coalesce(F.element_at("n", F.lit(label).cast("long")), F.lit(0)) + alpha) / F.lit(total))
        for label, total in zip(labels, totals)
    ]
    logs = F.array(*logs) if logs else F.array().cast("array<double>")
    tokens = materialize(held.select("token_id", logs.alias("logs")), "sequence-bayes")
    return SequenceBayes(tokens, labels, priors, [math.log(alpha / t) for t in totals])


def score_sequences(encoded: DataFrame, model: SequenceBayes, key: str = "id") -> DataFrame:
    """(key, predicted, score): the label of the largest joint log-probability, and that value.

    Equal values give the smaller label. Every distinct id of a sequence is looked up once with its
    count; sequences without words are scored by the priors. Rows that repeat a key stay rows of
    their own.
    """
    if not model.labels:
        raise ValueError("no labelled row to learn from")
    ids = token_ids(encoded, key)
    counted = F.transform(
        F.array_distinct("_ids"),
        lambda t: F.struct(t.alias("token_id"), F.size(F.filter("_ids", lambda x: x == t)).alias("n")),
    )
    long = ids.select(key, content_hash("_ids").alias(CONTENT), F.posexplode_outer(counted).alias("_pos", "_t"))
    long = long.select(key, CONTENT, "_pos", "_t.token_id", "_t.n")
    known = model.tokens.select("token_id", array_to_vector("logs").alias("_logs"))
    joined = lookup_join(long, known, "token_id", "left", size=table_bytes(model.tokens))
    # A sequence without words has one row without an id, which adds nothing.
    absent = F.when(F.col("token_id").isNull(), 0.0)
    unseen = array_to_vector(F.array(*(F.coalesce(absent, F.lit(u)) for u in model.unseen)))
    total = Summarizer.sum(F.coalesce("_logs", unseen), F.coalesce("n", F.lit(1)).cast("double"))
    grouped = joined.groupBy(key, CONTENT).agg(total.alias("_sum"), row_copies())
    shares = F.transform(vector_to_array("_sum"), lambda s: s / F.col("_copies"))
    joint = F.zip_with(shares, F.array(*map(F.lit, model.priors)), lambda s, p: s + p)
    scored = repeated(grouped.withColumn("_joint", joint))
    best = argmax(F.col("_joint"))
    return scored.select(
        key,
        F.get(F.array(*(F.lit(x).cast("long") for x in model.labels)), best.cast("int")).alias("predicted"),
        F.array_max("_joint").alias("score"),
    )
