"""A store of fitted models: a folder of tables per version, named last in one table of versions.

A reader sees a model whole or not at all, since its tables are written before its name. Older
versions stay until they are removed. Everything that a model needs to score new rows is stored:
vocabulary, tokenizer name, lemmas and factors.
"""

import json
import time
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.bayes import SequenceBayes
from textloom.operators.factors import columns
from textloom.operators.lda import LdaModel
from textloom.operators.nmf import NmfModel
from textloom.operators.svm import NewtonFit, SquaredHingeModel
from textloom.operators.vectors import Vocabulary

VERSIONS = "kind string, version string, saved_at double, facts string"


@dataclass(frozen=True)
class WordVectors:
    """Given word vectors (term, vector) of one width, as documents are averaged from them."""

    table: DataFrame
    dim: int


@dataclass(frozen=True)
class TextSettings:
    """How text was made into rows: the tokenizer's name, and lemmas (surface, lemma) if any."""

    tokenizer: str = "tokenize"
    weighting: str = "tfidf"
    lemmas: DataFrame | None = None


def _weight_table(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    """(feature, c0..): the weights of all classes of a feature; the last feature is the constant."""
    names = ", ".join(f"{c} double" for c in columns(len(weights)))
    rows = [(i, *map(float, w)) for i, w in enumerate(weights.T)]
    return spark.createDataFrame(rows, f"feature long, {names}")


def _parts(spark: SparkSession, model) -> tuple[str, dict[str, DataFrame], dict]:
    """Kind, tables and plain facts of a model."""
    if isinstance(model, Vocabulary):
        return "vocabulary", {"terms": model.table}, {"n_docs": model.n_docs, "n_terms": model.n_terms, "size": model.size}
    if isinstance(model, TextSettings):
        tables = {"lemmas": model.lemmas} if model.lemmas is not None else {}
        return "text", tables, {"tokenizer": model.tokenizer, "weighting": model.weighting}
    if isinstance(model, WordVectors):
        return "vectors", {"vectors": model.table}, {"dim": model.dim}
    if isinstance(model, NmfModel):
        facts = {"k": model.k, "n_terms": model.n_terms, "gram": model.gram.tolist(), "error": model.error}
        return "nmf", {"terms": model.terms}, facts | {"errors": model.errors, "converged": model.converged}
    if isinstance(model, LdaModel):
        facts = {"k": model.k, "n_terms": model.n_terms, "alpha": model.alpha, "eta": model.eta}
        return "lda", {"terms": model.terms}, facts | {
            "totals": model.totals.tolist(), "bounds": model.bounds, "converged": model.converged
        }
    if isinstance(model, SequenceBayes):
        return "bayes", {"tokens": model.tokens}, {"labels": model.labels, "priors": model.priors, "unseen": model.unseen}
    if isinstance(model, SquaredHingeModel):
        fit = model.fit
        facts = {"classes": len(fit.weights), "steps": fit.steps, "passes": fit.passes}
        facts |= {"gradient": fit.gradient, "converged": fit.converged}
        return "svm", {"weights": _weight_table(spark, fit.weights)}, facts
    raise TypeError(f"no model kind for {type(model).__name__}")


def _model(kind: str, table, facts: dict):
    """The model of stored parts; ``table`` reads one of its tables by name."""
    if kind == "vocabulary":
        return Vocabulary(table("terms"), **facts)
    if kind == "text":
        return TextSettings(**{k: v for k, v in facts.items() if k != "has_lemmas"}, lemmas=table("lemmas") if facts["has_lemmas"] else None)
    if kind == "vectors":
        return WordVectors(table("vectors"), facts["dim"])
    if kind == "nmf":
        # The weights of the training rows are results, not part of the model.
        return NmfModel(**facts | {"gram": np.array(facts["gram"])}, terms=table("terms"), documents=None)
    if kind == "lda":
        return LdaModel(**facts | {"totals": np.array(facts["totals"])}, terms=table("terms"))
    if kind == "bayes":
        return SequenceBayes(table("tokens"), **facts)
    if kind == "svm":
        rows = table("weights").orderBy("feature").collect()
        weights = np.array([[r[c] for c in columns(facts["classes"])] for r in rows]).T
        return SquaredHingeModel(NewtonFit(weights, **{k: v for k, v in facts.items() if k != "classes"}))
    raise ValueError(f"unknown model kind {kind!r}")


def save_models(spark: SparkSession, path: str, name: str, **models) -> str:
    """Store models that belong together under ``name`` and return the version."""
    version, facts = uuid.uuid4().hex, {}
    for part, model in models.items():
        kind, tables, own = _parts(spark, model)
        if kind == "text":
            own["has_lemmas"] = bool(tables)
        for table, df in tables.items():
            df.write.parquet(f"{path}/{name}/{version}/{part}/{table}")
        facts[part] = {"kind": kind, **own}
    row = [(name, version, time.time(), json.dumps(facts))]
    spark.createDataFrame(row, VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(kind, version, saved_at) of everything stored, as written."""
    return spark.read.schema(VERSIONS).parquet(f"{path}/versions").drop("facts")


def load_models(spark: SparkSession, path: str, name: str, version: str | None = None) -> dict:
    """The models stored last under ``name``, or those of a ``version``."""
    found = spark.read.schema(VERSIONS).parquet(f"{path}/versions").filter(F.col("kind") == name)
    found = found.filter(F.col("version") == version) if version else found
    row = found.orderBy(F.desc("saved_at"), "version").first()
    if row is None:
        raise ValueError(f"no model {name!r} in {path}")
    out = {}
    for part, facts in json.loads(row["facts"]).items():
        folder = f"{path}/{name}/{row['version']}/{part}"
        kind = facts.pop("kind")
        out[part] = _model(kind, lambda table, folder=folder: spark.read.parquet(f"{folder}/{table}"), facts)
    return out
