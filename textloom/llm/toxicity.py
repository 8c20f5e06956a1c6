"""Toxic passages: maximum-scoring segments of token log-odds with extreme-value calibration."""

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import KEY, arrow_fields, balanced, keyed, map_batches, materialize, sized_join, to_batch
from textloom.llm.language import held_out

# The model is fitted on at most about this many labelled documents.
SAMPLE_DOCS = 40_000
# The Dirichlet prior of a word holds this share of its occurrences in both classes together.
PRIOR_SHARE = 0.1
# Words whose log-odds are this many standard deviations above zero count for toxicity.
MIN_Z = 3.0
# What every other word costs, so that passages end where their words stop being toxic.
STEP = 0.25
SIGNIFICANT = 0.05
THRESHOLD = 0.7
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def segments(places: list[int], gains: list[float], step: float = STEP) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first word, last word) in linear time.

    Words at ``places`` score their gain and every other word ``-step``. A segment is maximal if
    none that contains it scores more and no part of it has a score of zero or less at an end.
    Candidates are kept with the sums before and after them; a new one is merged with the last
    candidate that starts lower as long as that one ends lower too.
    """
    kept: list[tuple[float, float, int, int]] = []  # sum before, sum after, first, last
    total, at = 0.0, -1
    for place, gain in zip(places, gains):
        total -= step * (place - at - 1)
        before, total, at, first = total, total + gain, place, place
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][0] >= before:
                j -= 1
            if j < 0 or kept[j][1] >= total:
                kept.append((before, total, first, place))
                break
            before, first = kept[j][0], kept[j][2]
            del kept[j:]
    return [(after - before, first, last) for before, after, first, last in kept]


def _scan(docs: DataFrame, gains: dict[str, float]) -> DataFrame:
    """(_llm_id, _llm_th, n_words, segment scores, starts, ends) of each row."""
    known = docs.sparkSession.sparkContext.broadcast(gains)
    schema = "_llm_id long, _llm_th long, n_words long, scores array<double>, starts array<long>, ends array<long>"

    def run(columns):
        table, out = known.value, [[] for _ in range(6)]
        for doc, text_hash, text in zip(*columns):
            words = words_of(text)
            places = [i for i, w in enumerate(words) if w in table]
            found = segments(places, [table[words[i]] for i in places])
            row = doc, text_hash, len(words), *([s[i] for s in found] for i in range(3))
            for column, value in zip(out, row):
                column.append(value)
        return out

    return map_batches(docs, run, schema, [*KEY, "text"])


def decay(gains: np.ndarray, shares: np.ndarray, step: float = STEP) -> float:
    """The positive solution x of E[exp(x * score)] = 1 over clean words."""

    def excess(x: float) -> float:
        return float((shares * np.exp(x * gains)).sum() + (1 - shares.sum()) * math.exp(-x * step) - 1)

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def evidence(scores: list[float], n_words: int, rate: float, scale: float) -> float:
    """Sum of -log E over the significant segments; E is the number expected by chance.

    By extreme-value theory a text of n clean words has K * n * exp(-rate * s) segments that
    score s or more.
    """
    total = 0.0
    for score in scores:
        surprise = rate * score - math.log(max(1, n_words) * scale)
        if surprise > -math.log(SIGNIFICANT):
            total += surprise
    return total


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Steps of the best rising fit of ``y`` over ``x``, each smoothed by one row of either class."""
    order = np.argsort(x, kind="stable")
    pooled: list[list[float]] = []  # first x, sum, rows
    edges, first = np.unique(x[order], return_index=True)
    sums = np.add.reduceat(y[order].astype(float), first)
    rows = np.diff(np.concatenate([first, [len(x)]]))
    for edge, s, n in zip(edges.tolist(), sums.tolist(), rows.tolist()):
        pooled.append([edge, s, n])
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][2] >= pooled[-1][1] * pooled[-2][2]:
            _, s, n = pooled.pop()
            pooled[-1][1] += s
            pooled[-1][2] += n
    values = [(s + 0.5) / (n + 1) for _, s, n in pooled]
    return [p[0] for p in pooled], np.maximum.accumulate(values).tolist()


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Word gains and calibration from (doc_id, text) and (doc_id, toxic).

    A document is toxic if one of its labels says so; null labels and ids are left out. The fit
    reads about ``sample_docs`` labelled documents, chosen by a hash of their id; equal texts count
    as one, toxic if one of them is. Words are counted in Spark, once per document; their log-odds between the
    classes have a Dirichlet prior in proportion to both. Only the words of significant log-odds, at most
    the words of the sample's toxic documents, and one number per sampled document
    reach the driver. Without labels of both classes every text scores the same.
    """
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = marks.count()
    share = min(1.0, sample_docs / max(1, total))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30)
    marks = materialize(marks.filter(drawn).withColumn("toxic", (F.col("toxic") > 0).cast("int")), "marks")
    sample = sized_join(docs.select("doc_id", "text"), marks, ["doc_id"], "inner")
    alike = sample.groupBy(F.xxhash64("text").alias("_th"))
    sample = alike.agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    sample = materialize(keyed(sample, "doc_id", "text").select(*KEY, "text", "toxic"), "sample")
    n_docs, n_toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = {"gains": {}, "rate": 1.0, "scale": 1.0, "edges": [0.0], "values": [(n_toxic + 0.5) / (n_docs + 1)]}
    if n_toxic == 0 or n_toxic == n_docs:
        return base

    def count(columns):
        seen: dict[str, list[int]] = {}
        for text, toxic in zip(*columns):
            for word in set(words_of(text)):
                seen.setdefault(word, [0, 0])[toxic] += 1
        return [list(seen), [v[1] for v in seen.values()], [v[0] for v in seen.values()]]

    counted = map_batches(sample, count, "word string, toxic long, clean long", ["text", "toxic"])
    counted = counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = materialize(counted, "word-counts")
    a, b = counted.agg(F.sum("toxic"), F.sum("clean")).first()
    if not a or not b:
        return base
    prior, mass = (F.col("toxic") + F.col("clean")) * PRIOR_SHARE, (a + b) * PRIOR_SHARE
    x, y = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(x / (a + mass - x)) - F.log(y / (b + mass - y))
    strong = counted.withColumns({"odds": odds, "z": odds / F.sqrt(1 / x + 1 / y)}).filter(F.col("z") >= MIN_Z)
    words = strong.orderBy("word").collect()
    gains = {r["word"]: r["odds"] for r in words}
    if not gains:
        return base
    rate = decay(np.array([r["odds"] for r in words]), np.array([r["clean"] / b for r in words]))
    scanned = materialize(_scan(sample, gains), "segments")
    scanned = scanned.join(sample.select(*KEY, "toxic"), KEY).select("toxic", "n_words", "scores")
    rows = scanned.collect()
    chance = sum(r["n_words"] * math.exp(-rate * max([0.0, *r["scores"]])) for r in rows if not r["toxic"])
    scale = sum(not r["toxic"] for r in rows) / max(1.0, chance)
    x = np.array([evidence(r["scores"], r["n_words"], rate, scale) for r in rows])
    edges, values = isotonic(x, np.array([r["toxic"] for r in rows]))
    return {"gains": gains, "rate": rate, "scale": scale, "edges": edges, "values": values}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, passages) of every row of ``docs`` (doc_id, text).

    ``passages`` lists the significant segments (first word, last word, score). Null, empty and
    wordless texts have no passage and get the score of texts without evidence. Texts of any
    length are scanned whole; repeated rows are scored each.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, score double, passages array<struct<first:int,last:int,score:double>>"
    names, types = arrow_fields(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        table, edges, values = m["gains"], np.array(m["edges"]), m["values"]
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                places = [i for i, w in enumerate(words) if w in table]
                found = segments(places, [table[words[i]] for i in places])
                total = evidence([s for s, _, _ in found], len(words), m["rate"], m["scale"])
                scores.append(values[max(0, int(np.searchsorted(edges, total, "right")) - 1)])
                passages.append(
                    [
                        {"first": a, "last": z, "score": s}
                        for s, a, z in found
                        if evidence([s], len(words), m["rate"], m["scale"]) > 0
                    ]
                )
            yield to_batch([batch.column(0), scores, passages], names, types)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels.select("doc_id", "toxic").filter(~held_out("doc_id", 3, 1)))
    found = score(balanced(docs), model)
    return found.select(
        "doc_id",
        held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
