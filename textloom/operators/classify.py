"""Training, scoring, storing and comparing multiclass classifiers with Spark ML."""

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.feature import IndexToString, StringIndexer, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.arrays import argmax
from textloom.functions.text import plain_words, raw_tokens, tokenize
from textloom.operators.metrics import class_report, compare_models, model_scores
from textloom.operators.svm import NewtonSvc, SquaredHingeModel
from textloom.operators.vectors import (
    Vocabulary,
    bags,
    lazy_ml_vectors,
    sparse_rows,
    tokens,
)
from textloom.session import shared_dir

# An estimator factory gets the number of training rows, features and classes.
Factory = Callable[[int, int, int], object]


def linear_svc(
    c: float = 1.0, max_iter: int = 1000, tol: float = 1e-4, parallelism: int = 4
) -> Factory:
    """One-vs-rest linear SVM. ``c`` is the usual penalty on the summed loss.

    Spark averages the loss over rows, so the same trade-off is regParam = 1 / (c n). Spark
    uses the plain hinge loss, and every iteration is at least one pass over all rows, so far
    fewer of them are needed than coordinate steps in a single-machine solver. The tolerance is
    meant to end the fit; ``max_iter`` is a guard.
    """

    def build(n_rows: int, n_features: int, n_classes: int) -> OneVsRest:
        reg = 1.0 / (c * n_rows)
        svc = LinearSVC(maxIter=max_iter, tol=tol, regParam=reg, standardization=False)
        return OneVsRest(classifier=svc, parallelism=parallelism, labelCol="label")

    return build


def newton_svc(c: float = 1.0, tol: float = 1e-4, max_steps: int = 100) -> Factory:
    """One-vs-rest linear SVM with squared hinge loss, fitted by Newton steps on all classes at once.

    ``c`` is the penalty on the summed loss and the intercept is regularised like every weight.
    """

    def build(n_rows: int, n_features: int, n_classes: int) -> NewtonSvc:
        return NewtonSvc(n_features, n_classes, c, tol, max_steps)

    return build


def logistic(max_iter: int = 50, reg: float = 0.0, tol: float = 1e-4) -> Factory:
    """Multinomial regression; ``max_iter`` plays the part of epochs, ``reg`` of weight decay."""

    def build(n_rows: int, n_features: int, n_classes: int) -> LogisticRegression:
        return LogisticRegression(
            family="multinomial", maxIter=max_iter, regParam=reg, tol=tol
        )

    return build


def perceptron(hidden: Sequence[int] = (16,), max_iter: int = 100, seed: int = 42) -> Factory:
    """Feed-forward network; for short dense features, as its weights live on the driver."""

    def build(n_rows: int, n_features: int, n_classes: int) -> MultilayerPerceptronClassifier:
        layers = [n_features, *hidden, n_classes]
        return MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed)

    return build


@dataclass(frozen=True)
class FeatureSet:
    """Train and test rows with ``id``, ``category`` and a vector in ``features``."""

    train: DataFrame
    test: DataFrame
    size: int


@dataclass(frozen=True)
class Trained:
    """A fitted model, the steps of its optimizer and whether these ended before their limit.

    Both are null for models that do not tell.
    """

    name: str
    model: PipelineModel
    train_hours: float
    steps: int | None = None
    converged: bool | None = None


def steps_of(classifier, estimator) -> tuple[int | None, bool | None]:
    """(steps, converged) of a fitted classifier; of several binary ones the most and all."""
    if isinstance(classifier, SquaredHingeModel):
        return classifier.fit.steps, classifier.fit.converged
    if isinstance(classifier, OneVsRestModel):
        parts = [steps_of(m, estimator.getClassifier()) for m in classifier.models]
        told = [s for s, _ in parts if s is not None]
        return (max(told), all(c for _, c in parts)) if len(told) == len(parts) and told else (None, None)
    if not getattr(classifier, "hasSummary", False):
        return None, None
    summary = classifier.summary() if callable(classifier.summary) else classifier.summary
    return summary.totalIterations, summary.totalIterations < estimator.getMaxIter()


def train(name: str, rows: DataFrame, n_features: int, factory: Factory) -> Trained:
    """Fit label coding and classifier on the training rows; labels are coded in sorted order.

    Every partition gives sums as wide as the model in every step of an optimizer. The rows are kept in
    one partition per core, so that these sums do not grow in number with the rows.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    cached = rows.select("features", "category").coalesce(cores).persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = cached.count()
    indexer = StringIndexer(
        inputCol="category",
        outputCol="label",
        stringOrderType="alphabetAsc",
        handleInvalid="error",
    ).fit(cached)
    estimator = factory(n_rows, n_features, len(indexer.labels))
    decoder = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    started = time.monotonic()
    classifier = estimator.fit(indexer.transform(cached))
    hours = (time.monotonic() - started) / 3600
    cached.unpersist()
    # New articles have no label, so the stored model starts with the classifier.
    return Trained(name, PipelineModel([classifier, decoder]), hours, *steps_of(classifier, estimator))


def predict(trained: Trained, rows: DataFrame, split: str) -> DataFrame:
    """(model, split, id, y, p)."""
    scored = trained.model.transform(rows)
    return scored.select(
        F.lit(trained.name).alias("model"),
        F.lit(split).alias("split"),
        "id",
        F.col("category").alias("y"),
        F.col("predicted").alias("p"),
    )


def argmax_scores(df: DataFrame, scores: str) -> Column:
    """0-based class of the highest score in an array or vector column; first on ties."""
    column = F.col(scores)
    is_vector = df.schema[scores].dataType.typeName() not in ("array",)
    return argmax(vector_to_array(column) if is_vector else column)


@dataclass(frozen=True)
class Sweep:
    """The fitted models and their ``predictions`` (model, split, id, y, p)."""

    trained: list[Trained]
    predictions: DataFrame


def sweep_predictions(feature_sets: dict[str, FeatureSet], factories: dict[str, Factory]) -> Sweep:
    """Train every classifier on every feature set and predict both splits."""
    trained, predictions = [], None
    for set_name, features in feature_sets.items():
        for kind, factory in factories.items():
            name = f"{kind}_{set_name}" if len(factories) > 1 else set_name
            fitted = train(name, features.train, features.size, factory)
            trained.append(fitted)
            for split, rows in (("train", features.train), ("test", features.test)):
                part = predict(fitted, rows, split)
                predictions = part if predictions is None else predictions.unionByName(part)
    return Sweep(trained, predictions)


def model_reports(swept: Sweep, split: str = "test") -> DataFrame:
    """(model, class, precision, recall, f1, support) of every model, averages included."""
    reports = None
    for t in swept.trained:
        own = swept.predictions.filter((F.col("model") == t.name) & (F.col("split") == split))
        report = class_report(own).select(F.lit(t.name).alias("model"), "*")
        reports = report if reports is None else reports.unionByName(report)
    return reports


def sweep(feature_sets: dict[str, FeatureSet], factories: dict[str, Factory]) -> DataFrame:
    """Train every classifier on every feature set and compare them.

    One row per model: train and test accuracy, macro F1 on the test rows, hours of fitting, the
    optimizer's steps and whether it converged before their limit.
    """
    swept = sweep_predictions(feature_sets, factories)
    trained, predictions = swept.trained, swept.predictions
    spark = predictions.sparkSession
    hours = spark.createDataFrame(
        [(t.name, t.train_hours, t.steps, t.converged) for t in trained],
        "model string, train_hours double, steps long, converged boolean",
    )
    per_split = model_scores(predictions.withColumn("model", F.concat_ws("|", "model", "split")))
    named = compare_models(per_split).select(
        F.substring_index("model", "|", 1).alias("model"),
        F.substring_index("model", "|", -1).alias("split"),
        "accuracy",
        "f1_macro",
    )
    on_train = named.filter("split = 'train'").select("model", F.col("accuracy").alias("train_accuracy"))
    on_test = named.filter("split = 'test'").drop("split")
    return on_test.join(on_train, "model").join(hours, "model").select(
        "model", "accuracy", "train_accuracy", "f1_macro", "train_hours", "steps", "converged"
    )


def dense_features(df: DataFrame, vector: str = "vector") -> DataFrame:
    """(id, category, features) from an array column."""
    return df.select("id", "category", array_to_vector(vector).alias("features"))


def fit_word2vec(
    token_table: DataFrame, dim: int = 50, max_iter: int = 1, seed: int = 42, partitions: int = 8
):
    """Word vectors trained on the corpus; transforming averages the vectors of a document.

    ``partitions`` are trained apart and merged after each pass, so their number is part of the
    model and does not follow the cores of the cluster.
    """
    return Word2Vec(
        vectorSize=dim,
        minCount=2,
        maxIter=max_iter,
        numPartitions=partitions,
        seed=seed,
        inputCol="tokens",
        outputCol="features",
    ).fit(token_table)


# Tokenizers that a stored model can name.
TOKENIZERS = {"tokenize": tokenize, "plain_words": plain_words, "raw_tokens": raw_tokens}


@dataclass(frozen=True)
class ArticleModel:
    """A vocabulary and a classifier that together score raw article text.

    ``tokenizer`` names the tokenizer that the vocabulary was fitted with.
    """

    vocabulary: Vocabulary
    classifier: PipelineModel
    weighting: str = "tfidf"
    tokenizer: str = "tokenize"

    def score(self, articles: DataFrame) -> DataFrame:
        """Add ``predicted`` to (id, text) articles; works for batches of any size."""
        bag_table = bags(tokens(articles.select("id", "text"), TOKENIZERS[self.tokenizer]))
        rows = sparse_rows(bag_table, self.vocabulary, self.weighting)
        vectors = lazy_ml_vectors(rows, self.vocabulary.n_terms)
        return self.classifier.transform(vectors).select("id", "predicted")

    def score_only(self, articles: DataFrame, categories: Sequence[str]) -> DataFrame:
        """Scored articles whose predicted category is wanted."""
        return self.score(articles).filter(F.col("predicted").isin(list(categories)))

    def save(self, path: str | None = None) -> str:
        """Store the model in a directory, by default ``fine_tuned`` in the shared folder.

        Each save writes a folder of its own and adds its name to ``versions`` last, so readers
        see the old model or the new one, and a loaded model can be saved where it came from.
        """
        v, spark = self.vocabulary, self.vocabulary.table.sparkSession
        path = path or f"{shared_dir(spark)}/fine_tuned"
        version = uuid.uuid4().hex
        v.table.write.parquet(f"{path}/{version}/vocabulary")
        self.classifier.write().save(f"{path}/{version}/classifier")
        facts = [(version, time.time(), v.n_docs, v.n_terms, v.size, self.weighting, self.tokenizer)]
        schema = """version string, saved_at double, n_docs long, n_terms long, size long,
            weighting string, tokenizer string"""
        spark.createDataFrame(facts, schema).coalesce(1).write.mode("append").parquet(f"{path}/versions")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str | None = None) -> "ArticleModel":
        """The model that was saved last."""
        path = path or f"{shared_dir(spark)}/fine_tuned"
        facts = spark.read.parquet(f"{path}/versions").orderBy(F.desc("saved_at"), "version").first()
        folder = f"{path}/{facts['version']}"
        table = spark.read.parquet(f"{folder}/vocabulary")
        vocabulary = Vocabulary(table, facts["n_docs"], facts["n_terms"], facts["size"])
        classifier = PipelineModel.load(f"{folder}/classifier")
        return ArticleModel(vocabulary, classifier, facts["weighting"], facts["tokenizer"])
