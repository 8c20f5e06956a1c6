import numpy as np
import pytest

from textloom.operators import bayes, classify, lda, nmf, registry
from textloom.operators import vectors as V
from textloom.operators.registry import TextSettings, WordVectors, load_models, save_models
from textloom.session import materialize


@pytest.fixture(scope="module")
def prepared(small_corpus):
    bags = V.stored_bags(small_corpus)
    vocabulary = V.fit_vocabulary(bags)
    return bags, vocabulary, materialize(V.sparse_rows(bags, vocabulary), "rows")


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_every_kind_scores_alike_after_loading(spark, prepared, tmp_path):
    bags, vocabulary, rows = prepared
    path = str(tmp_path / "models")
    vectors = spark.createDataFrame([("cat", [1.0, 2.0]), ("motor", [0.5, -1.0])], "term string, vector array<float>")
    features = V.ml_vectors(rows, vocabulary.n_terms)
    svm = classify.train("svc", features, vocabulary.n_terms, classify.newton_svc()).model.stages[0]
    sequences = rows.selectExpr(
        "id", "transform(indices, i -> i + 4) AS input_ids", "transform(indices, i -> 1) AS attention_mask",
        "if(category = 'cars', 0L, 1L) AS label",
    )
    made = {
        "vocabulary": vocabulary,
        "text": TextSettings(lemmas=spark.createDataFrame([("paws", "paw")], "surface string, lemma string")),
        "vectors": WordVectors(vectors, 2),
        "nmf": nmf.fit_nmf(rows, vocabulary.n_terms, k=2, max_iter=3),
        "lda": lda.fit_lda(rows, vocabulary.table, vocabulary.n_terms, k=2, max_iter=2),
        "bayes": bayes.fit_sequence_bayes(sequences, vocabulary.n_terms),
        "svm": svm,
    }
    save_models(spark, path, "all", **made)
    read = load_models(spark, path, "all")
    assert set(read) == set(made)
    assert read["text"].tokenizer == "tokenize" and rows_of(read["text"].lemmas) == rows_of(made["text"].lemmas)
    for a, b in ((made, read),):
        assert rows_of(V.sparse_rows(bags, a["vocabulary"])) == rows_of(V.sparse_rows(bags, b["vocabulary"]))
        assert rows_of(V.mean_vectors(bags, a["vectors"].table, 2)) == rows_of(V.mean_vectors(bags, b["vectors"].table, b["vectors"].dim))
        assert rows_of(nmf.transform_nmf(a["nmf"], rows)) == rows_of(nmf.transform_nmf(b["nmf"], rows))
        assert rows_of(lda.infer(rows, a["lda"])) == rows_of(lda.infer(rows, b["lda"]))
        assert rows_of(bayes.score_sequences(sequences, a["bayes"])) == rows_of(bayes.score_sequences(sequences, b["bayes"]))
        assert rows_of(a["svm"].transform(features)) == rows_of(b["svm"].transform(features))
        assert a["svm"].fit.steps == b["svm"].fit.steps


def test_last_version_is_loaded_and_older_ones_stay(spark, prepared, tmp_path):
    _, vocabulary, _ = prepared
    path = str(tmp_path / "models")
    first = save_models(spark, path, "words", text=TextSettings("plain_words"))
    save_models(spark, path, "words", text=TextSettings("raw_tokens"))
    save_models(spark, path, "other", vocabulary=vocabulary)
    assert load_models(spark, path, "words")["text"].tokenizer == "raw_tokens"
    assert load_models(spark, path, "words", first)["text"].tokenizer == "plain_words"
    assert registry.versions(spark, path).count() == 3
    # Tables without a name in ``versions`` are a save that did not end.
    vocabulary.table.write.parquet(f"{path}/words/unfinished/vocabulary/terms")
    assert load_models(spark, path, "words")["text"].tokenizer == "raw_tokens"
    with pytest.raises(ValueError, match="no model"):
        load_models(spark, path, "missing")
    with pytest.raises(TypeError):
        save_models(spark, path, "words", other=np.zeros(3))
