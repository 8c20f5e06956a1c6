import pytest

from textloom.functions.sequences import END_ID, START_ID, UNKNOWN_ID
from textloom.operators import labels, metrics, sequences
from textloom.operators import vectors as V
from textloom.operators.classify import argmax_scores


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), ("a", "a")]
    return spark.createDataFrame(rows, "y string, p string")


def test_report_with_a_class_that_is_never_predicted(predictions):
    rows = {r["class"]: r for r in metrics.class_report(predictions).collect()}
    assert rows["c"]["precision"] == rows["c"]["f1"] == 0.0 and rows["c"]["support"] == 1
    assert rows["a"]["precision"] == pytest.approx(2 / 3) and rows["a"]["recall"] == pytest.approx(2 / 3)
    f1 = [2 / 3, 0.8, 0.0]
    assert rows["macro avg"]["f1"] == pytest.approx(sum(f1) / 3)
    assert rows["weighted avg"]["f1"] == pytest.approx((3 * f1[0] + 2 * f1[1]) / 6)
    assert metrics.macro_f1(predictions).first()[0] == pytest.approx(sum(f1) / 3)
    assert metrics.accuracy(predictions).first()[0] == pytest.approx(4 / 6)
    matrix = {r["y"]: (r["a"], r["b"]) for r in metrics.confusion_matrix(predictions, ["a", "b"]).collect()}
    assert matrix == {"a": (2, 1), "b": (0, 2), "c": (1, 0)}


def test_comparison_agrees_with_the_report(spark, predictions):
    from pyspark.sql import functions as F

    both = predictions.withColumn("model", F.lit("m")).union(
        predictions.select("y", "y").withColumn("model", F.lit("perfect"))
    )
    table = metrics.compare_models(metrics.model_scores(both))
    rows = {r["model"]: r for r in table.collect()}
    assert rows["m"]["accuracy"] == pytest.approx(4 / 6)
    assert rows["m"]["f1_macro"] == pytest.approx(metrics.macro_f1(predictions).first()[0])
    assert metrics.best_model(table).first()["model"] == "perfect"
    gate = metrics.challenger_gate(table, "perfect").first()
    assert gate["challenger"] == "m" and gate["promote"] is False


def test_labels_roundtrip_and_unseen_label_fails(spark):
    train = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "category string")
    fitted = labels.fit_labels(train)
    assert {(r["category"], r["code"]) for r in fitted.collect()} == {("a", 0), ("b", 1)}
    known = labels.encode_labels(train.na.drop(), fitted)
    assert labels.decode_labels(known.select("code"), fitted).filter("category = 'b'").count() == 2
    new = spark.createDataFrame([("z",)], "category string")
    assert labels.unseen_labels(new, fitted).collect() == [("z", 1)]
    with pytest.raises(Exception, match="not seen in training"):
        labels.encode_labels(new, fitted).collect()


def test_first_maximum_wins(spark):
    df = spark.createDataFrame([([0.5, 0.9, 0.9],)], "s array<double>")
    assert df.select(argmax_scores(df, "s")).first()[0] == 1


def test_sequences_of_every_length(spark):
    texts = ["", "cat dog", "cat dog cat dog", "cat dog cat dog cat", "cat unheard"]
    df = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "id long, text string, label long")
    vocabulary = V.fit_vocabulary(V.stored_bags(df))
    encoded = sequences.encode(df, vocabulary, 1, "label", max_len=6)
    rows = {r["id"]: r for r in encoded.collect()}
    cat, dog = 4, 5
    assert rows[0]["input_ids"] == [START_ID, END_ID, 0, 0, 0, 0]
    assert rows[1]["input_ids"] == [START_ID, cat, dog, END_ID, 0, 0]
    assert rows[2]["input_ids"] == rows[3]["input_ids"] == [START_ID, cat, dog, cat, dog, END_ID]
    assert rows[4]["input_ids"][1:3] == [cat, UNKNOWN_ID]
    assert rows[1]["attention_mask"] == [1, 1, 1, 1, 0, 0] and rows[1]["token_type_ids"] == [0] * 6
    assert rows[3]["label"] == 1
    assert "label" not in sequences.encode(df, vocabulary, max_len=6).columns
    assert sequences.model_inputs(encoded, "distilbert-base-uncased", train=False).columns == [
        "id", "input_ids", "attention_mask",
    ]
    assert "token_type_ids" in sequences.model_inputs(encoded, "xlnet-base-cased").columns
    with pytest.raises(ValueError):
        sequences.model_inputs(encoded, "gpt-2")
    with pytest.raises(TypeError):
        sequences.encode(df, vocabulary, text=1.5)


def test_unlisted_prediction_stops_the_matrix(spark):
    rows = spark.createDataFrame([("en", "en"), ("en", "xx")], "y string, p string")
    with pytest.raises(Exception, match="class not listed: xx"):
        metrics.confusion_matrix(rows, ["en", "fr"]).collect()


def test_first_model_is_promoted(spark):
    table = spark.createDataFrame([("new", 0.5)], "model string, f1_macro double")
    assert [r.promote for r in metrics.challenger_gate(table, "old").collect()] == [True]
