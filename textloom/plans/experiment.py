"""Fitted pipelines on the corpus: features, topic models, classifiers and scoring."""

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession

from textloom.functions.text import plain_words
from textloom.operators import classify, lda, nmf
from textloom.operators.classify import ArticleModel, FeatureSet
from textloom.operators.vectors import (
    Vocabulary,
    bags,
    common_width,
    fit_vocabulary,
    mean_vectors,
    ml_vectors,
    sparse_rows,
    tokens,
)
from textloom.plans.corpus import part, split_corpus, word_vectors
from textloom.session import materialize


@dataclass(frozen=True)
class Prepared:
    """Tokenized once: bags of both splits and the vocabulary of the training split."""

    train: DataFrame
    test: DataFrame
    vocabulary: Vocabulary


def prepare(spark: SparkSession, sf_dir: str) -> Prepared:
    stored = materialize(bags(tokens(split_corpus(spark, sf_dir))), "bags")
    train = part(stored, "train")
    return Prepared(train, part(stored, "test"), fit_vocabulary(train))


def weighted_features(p: Prepared, weighting: str) -> FeatureSet:
    n_terms = p.vocabulary.n_terms
    train, test = (
        ml_vectors(sparse_rows(side, p.vocabulary, weighting), n_terms)
        for side in (p.train, p.test)
    )
    return FeatureSet(train, test, n_terms)


def stored_rows(p: Prepared, split: str = "train", weighting: str = "tfidf") -> DataFrame:
    side = p.train if split == "train" else p.test
    return materialize(sparse_rows(side, p.vocabulary, weighting), f"{weighting}-{split}")


def nmf_fit(p: Prepared, k: int = 8, max_iter: int = 200) -> nmf.NmfModel:
    return nmf.fit_nmf(stored_rows(p), p.vocabulary.n_terms, k=k, max_iter=max_iter)


def nmf_features(p: Prepared, k: int = 8) -> FeatureSet:
    model = nmf_fit(p, k)
    test = nmf.transform_nmf(model, stored_rows(p, "test"))
    sides = [
        classify.dense_features(nmf.as_array(table, k)) for table in (model.documents, test)
    ]
    return FeatureSet(sides[0], materialize(sides[1], "nmf-test"), k)


def lda_rows(p: Prepared, split: str = "train") -> DataFrame:
    """Stored count rows of a split, numbered for the topic model."""
    return lda.numbered(sparse_rows(p.train if split == "train" else p.test, p.vocabulary, "count"))


def lda_fit(p: Prepared, rows: DataFrame, k: int = 8) -> lda.LdaModel:
    return lda.fit_lda(rows, p.vocabulary.table, p.vocabulary.n_terms, k)


def lda_features(p: Prepared, k: int = 8) -> FeatureSet:
    train, test = lda_rows(p), lda_rows(p, "test")
    fit = lda_fit(p, train, k)
    sides = [classify.dense_features(lda.infer(side, fit)) for side in (train, test)]
    return FeatureSet(sides[0], sides[1], k)


def docvec_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """(id, category, vector) of both splits and the width: averages of the given word vectors.

    The table of vectors is an input; words without one count as zeros. All words take part, as
    averaging has no use for a stop list.
    """
    stored = materialize(bags(tokens(split_corpus(spark, sf_dir), plain_words)), "words")
    train = part(stored, "train")
    given = materialize(word_vectors(spark, sf_dir, fit_vocabulary(train)), "word-vectors")
    dim = common_width(given, "vector")
    # Both splits in one pass, so that they share the vectors of a block.
    means = materialize(mean_vectors(stored, given, dim, ["id", "category", "split"]), "docvec")
    return part(means, "train"), part(means, "test"), dim


def docvec_features(spark: SparkSession, sf_dir: str) -> FeatureSet:
    train, test, dim = docvec_parts(spark, sf_dir)
    return FeatureSet(classify.dense_features(train), classify.dense_features(test), dim)


def article_model(p: Prepared, factory=None) -> ArticleModel:
    features = weighted_features(p, "tfidf")
    factory = factory or classify.logistic(reg=1e-4)
    fitted = classify.train("tfidf", features.train, features.size, factory)
    return ArticleModel(p.vocabulary, fitted.model)


def feature_array(features: FeatureSet) -> DataFrame:
    """(id, category, vector) of the training rows of a dense feature set."""
    return features.train.select("id", "category", vector_to_array("features").alias("vector"))
