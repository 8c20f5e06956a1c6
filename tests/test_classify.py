import pytest
from pyspark.sql import functions as F

from textloom.operators import classify
from textloom.operators import vectors as V
from textloom.operators.classify import ArticleModel, FeatureSet
from textloom.sources.articles import write_articles
from textloom.streaming import score as S


@pytest.fixture(scope="module")
def setup(spark, small_corpus):
    bags = V.stored_bags(small_corpus)
    vocabulary = V.fit_vocabulary(bags)
    features = V.ml_vectors(V.sparse_rows(bags, vocabulary), vocabulary.n_terms)
    return vocabulary, FeatureSet(features, features, vocabulary.n_terms)


def test_sweep_beats_the_majority(setup):
    _, features = setup
    kinds = {"svc": classify.linear_svc(max_iter=20), "logreg": classify.logistic(20)}
    rows = {r["model"]: r for r in classify.sweep({"tfidf": features}, kinds).collect()}
    assert set(rows) == {"svc_tfidf", "logreg_tfidf"}
    for r in rows.values():
        assert r["accuracy"] > 0.9 and r["f1_macro"] > 0.9 and r["train_hours"] > 0
        assert r["accuracy"] == r["train_accuracy"]


def test_perceptron_on_short_vectors(spark):
    rows = [(i, "ab"[i % 2], [float(i % 2), 1.0]) for i in range(40)]
    df = classify.dense_features(spark.createDataFrame(rows, "id long, category string, vector array<double>"))
    fitted = classify.train("mlp", df, 2, classify.perceptron((4,), 50))
    assert classify.predict(fitted, df, "train").filter("y = p").count() == 40


def test_rows_are_fitted_in_one_partition_per_core(spark, setup):
    """Every partition gives sums as wide as the model in every step, whatever the number of rows."""
    _, features = setup
    cores, seen = spark.sparkContext.defaultParallelism, []

    def factory(*sizes):
        estimator = classify.logistic(20)(*sizes)
        fit = estimator.fit
        estimator.fit = lambda rows: seen.append(rows.rdd.getNumPartitions()) or fit(rows)
        return estimator

    spread = features.train.repartition(3 * cores + 1)
    fitted = classify.train("m", spread, features.size, factory)
    assert seen == [cores]
    plain = classify.train("m", features.train, features.size, classify.logistic(20))
    ids = [{(r["id"], r["p"]) for r in classify.predict(f, features.test, "test").collect()} for f in (fitted, plain)]
    assert ids[0] == ids[1]


@pytest.mark.parametrize("factory", [classify.logistic(20), classify.linear_svc(max_iter=20)])
def test_stored_model_scores_batch_and_stream_alike(spark, small_corpus, setup, tmp_path, factory):
    vocabulary, features = setup
    fitted = classify.train("m", features.train, features.size, factory)
    model = ArticleModel(vocabulary, fitted.model)
    loaded = ArticleModel.load(spark, model.save(str(tmp_path / "model")))
    expected = {r["id"]: r["predicted"] for r in model.score(small_corpus).collect()}
    assert {r["id"]: r["predicted"] for r in loaded.score(small_corpus).collect()} == expected
    assert len(expected) == 26
    again = ArticleModel.load(spark, loaded.save(str(tmp_path / "model")))
    assert {r["id"]: r["predicted"] for r in again.score(small_corpus).collect()} == expected
    cars = loaded.score_only(small_corpus, ["cars"]).count()
    assert cars == sum(p == "cars" for p in expected.values())

    incoming, output = str(tmp_path / "in"), str(tmp_path / "out")
    empty = F.lit(None).cast("string")
    articles = small_corpus.filter("text <> ''").select(
        "id", "category", empty.alias("subcategory"), F.substring("text", 1, 2).alias("title"),
        F.expr("substring(text, 3)").alias("abstract"), empty.alias("url"),
        empty.alias("title_entities"), empty.alias("abstract_entities"),
    )
    write_articles(articles.repartition(3), incoming)
    S.score_arrivals(spark, loaded, incoming, output, str(tmp_path / "cp"), max_files=1).awaitTermination()
    scored = S.read_scored(spark, output)
    assert {int(r["id"]): r["predicted"] for r in scored.collect()} == {
        i: p for i, p in expected.items() if i != 24
    }
    assert scored.select("batch_id").distinct().count() > 1
    before = scored.count()
    S.score_arrivals(spark, loaded, incoming, output, str(tmp_path / "cp")).awaitTermination()
    assert S.read_scored(spark, output).count() == before
