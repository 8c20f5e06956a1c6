"""The registered queries: every operator applied to the given tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import plain_words, raw_tokens, surface_tokens, tokenize
from textloom.operators import (
    bayes,
    classify,
    clean,
    labels,
    lda,
    metrics,
    nmf,
    ordering,
    ranking,
    reduce,
    registry,
    sequences,
    topics,
    vectors,
)
from textloom.operators.factors import ROW, columns, gram, numbered, with_keys
from textloom.operators.routes import numbered_rows, routes_of, row_blocks, term_rows, term_slices
from textloom.plans import corpus, experiment
from textloom.plans.corpus import CATEGORIES
from textloom.plans.flagship import top_words
from textloom.session import materialize, scratch_path
from textloom.sources import articles as article_source
from textloom.sources import results as result_sink
from textloom.streaming import score as streaming

SEQUENCE_LENGTH = 100
BATCH_SIZE = 32
SAMPLE_FRACTION = 0.2
SHARDS = 8
# A file with line breaks in its fields is read by one task.
ROWS_PER_FILE = 20_000


def _joined(column: str, alias: str):
    return F.array_join(F.transform(column, lambda v: v.cast("string")), " ").alias(alias)


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# Cleaning and profiling


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = corpus.articles(spark, sf_dir).select("title", "abstract", "category")
    before = clean.null_counts(loaded).withColumn("stage", F.lit("loaded"))
    after = clean.null_counts(clean.drop_nulls(loaded)).withColumn("stage", F.lit("complete"))
    return before.unionByName(after).select("stage", "column_name", "n_null")


def project_columns(spark, sf_dir):
    kept = clean.project(corpus.articles(spark, sf_dir), ["id", "title", "abstract", "category"])
    return kept.drop("abstract")


def clean_merge_text(spark, sf_dir):
    return corpus.complete_articles(spark, sf_dir)


def category_filter(spark, sf_dir):
    kept = clean.keep_categories(corpus.articles(spark, sf_dir), CATEGORIES)
    return kept.select("id", "category", "subcategory")


def funnel_shape(spark, sf_dir):
    steps = {
        "loaded": F.lit(True),
        "complete": F.col("title").isNotNull() & F.col("abstract").isNotNull(),
        "chosen": F.col("category").isin(CATEGORIES),
    }
    return clean.funnel(corpus.articles(spark, sf_dir), steps)


def table_shape(spark, sf_dir):
    return clean.shape(corpus.complete_articles(spark, sf_dir))


def preview_rows(spark, sf_dir):
    return clean.preview(corpus.complete_articles(spark, sf_dir), 10)


def distinct_labels(spark, sf_dir):
    return clean.distinct_count(corpus.articles(spark, sf_dir), "category")


def category_counts(spark, sf_dir):
    return ranking.category_counts(corpus.articles(spark, sf_dir))


def category_members(spark, sf_dir):
    return ranking.category_members(clean.working_table(corpus.articles(spark, sf_dir), CATEGORIES))


def exact_sample(spark, sf_dir):
    table = clean.working_table(corpus.articles(spark, sf_dir), CATEGORIES)
    return ordering.exact_sample(table.select("id", "category"), SAMPLE_FRACTION)


def row_index(spark, sf_dir):
    return ordering.shuffled_index(corpus.articles(spark, sf_dir).select("id", "category"))


def md5_split(spark, sf_dir):
    return clean.hash_split(corpus.complete_articles(spark, sf_dir)).select("id", "split")


# Tokens


def _token_view(spark, sf_dir, tokenizer) -> DataFrame:
    table = vectors.tokens(corpus.corpus(spark, sf_dir), tokenizer)
    return table.select("id", F.size("tokens").cast("long").alias("n_tokens"),
                        F.array_join("tokens", " ").alias("tokens"))


def tokenize_texts(spark, sf_dir):
    return _token_view(spark, sf_dir, tokenize)


def stopword_filter(spark, sf_dir):
    table = corpus.corpus(spark, sf_dir)
    kept = F.size(tokenize(F.col("text"))).cast("long")
    every = F.size(surface_tokens(F.col("text"), stop_words=None)).cast("long")
    return table.select("id", every.alias("n_words"), kept.alias("n_kept"))


def raw_token_list(spark, sf_dir):
    return _token_view(spark, sf_dir, raw_tokens)


def alphanumeric_words(spark, sf_dir):
    return _token_view(spark, sf_dir, plain_words)


def url_tokens(spark, sf_dir):
    """Words that dropping URL-like tokens removes from each web page, its address in front."""
    text = F.concat_ws(" ", "url", "html")
    with_urls = F.size(surface_tokens(text, urls=True)).cast("long")
    without = F.size(surface_tokens(text)).cast("long")
    pages = corpus.table(spark, sf_dir, "pages")
    return pages.select("page_id", (with_urls - without).alias("n_url_words"))


def lemma_table(token_table: DataFrame) -> DataFrame:
    """(surface, lemma): words ending in s whose stem is a word of the corpus as well."""
    words = token_table.select(F.explode("tokens").alias("word")).distinct()
    stems = words.select(F.concat("word", F.lit("s")).alias("surface"), F.col("word").alias("lemma"))
    return stems.join(words.select(F.col("word").alias("surface")), "surface")


def lemma_lookup(spark, sf_dir):
    table = materialize(vectors.tokens(corpus.corpus(spark, sf_dir)), "tokens")
    lemmas = materialize(lemma_table(table), "lemmas")
    lemmatized = vectors.lemmatize(table.select("id", "tokens"), lemmas)
    return lemmatized.select("id", F.array_join("tokens", " ").alias("tokens"))


def lemma_counts(spark, sf_dir):
    """Counts of lemmas per article, looked up for the distinct terms of its bag."""
    found = materialize(vectors.bags(vectors.tokens(corpus.corpus(spark, sf_dir).select("id", "text"))), "bags")
    lemmas = materialize(lemma_table(found.select(F.col("bag.term").alias("tokens"))), "lemmas")
    return vectors.lemma_bags(found, lemmas).select("id", F.inline("bag"))


# Vectors


def vocabulary(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    return _rounded(p.vocabulary.table, "idf").withColumn("term_id", F.col("term_id").cast("long"))


def term_counts(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    return vectors.term_counts(p.train, p.vocabulary).select("id", "term", "tf")


def _weights(spark, sf_dir, split: str) -> DataFrame:
    p = experiment.prepare(spark, sf_dir)
    side = p.train if split == "train" else p.test
    long = vectors.term_weights(side, p.vocabulary)
    return _rounded(long.select("id", "term", "weight"), "weight")


def tfidf(spark, sf_dir):
    return _weights(spark, sf_dir, "train")


def tfidf_holdout(spark, sf_dir):
    return _weights(spark, sf_dir, "test")


def counts_holdout(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    rows = vectors.sparse_rows(p.test, p.vocabulary, "count")
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    return rows.select(
        "id", F.size("indices").cast("long").alias("n_terms"), total.cast("long").alias("n_tokens")
    )


def matrix_shape(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    shapes = None
    for name, side in (("train", p.train), ("test", p.test)):
        rows = vectors.sparse_rows(side, p.vocabulary, "count")
        shape = vectors.matrix_shape(rows, p.vocabulary).withColumn("split", F.lit(name))
        shapes = shape if shapes is None else shapes.unionByName(shape)
    return _rounded(shapes, "density", digits=9)


def top_words_count(spark, sf_dir):
    return top_words(spark, sf_dir, "count")


def top_words_tfidf(spark, sf_dir):
    return top_words(spark, sf_dir, "tfidf")


def word_vector_lookup(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    given = materialize(corpus.word_vectors(spark, sf_dir, p.vocabulary), "word-vectors")
    dim = F.size("vector")
    looked_up = vectors.term_vectors(p.vocabulary, given, vectors.common_width(given, "vector"))
    as_double = F.transform("vector", lambda v: v.cast("double"))
    weighted = F.transform(as_double, lambda v, i: v * (i + 1))
    squared = F.transform(as_double, lambda v: v * v)

    def total(values):
        return F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 6)

    return looked_up.select(
        "term",
        dim.cast("long").alias("dim"),
        total(as_double).alias("total"),
        total(weighted).alias("position_weighted_total"),
        total(squared).alias("squared_norm"),
    )


def document_mean_vector(spark, sf_dir):
    raw = materialize(vectors.raw_bags(corpus.corpus(spark, sf_dir)), "raw-bags")
    vocabulary = vectors.fit_vocabulary(raw)
    given = materialize(corpus.word_vectors(spark, sf_dir, vocabulary), "word-vectors")
    dim = vectors.common_width(given, "vector")
    means = vectors.mean_vectors(raw, given, dim)
    return means.select(
        "id", F.posexplode(F.transform("vector", lambda v: F.round(v, 6))).alias("dim", "mean")
    ).withColumn("dim", F.col("dim").cast("long"))


def docvec_features(spark, sf_dir):
    """Averaged word vectors of both splits, as the classifiers get them."""
    train, test, _ = experiment.docvec_parts(spark, sf_dir)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    values = F.transform("vector", lambda v: F.round(v, 6))
    return both.select("id", "split", "category", F.posexplode(values).alias("dim", "value")).withColumn(
        "dim", F.col("dim").cast("long")
    )


def mean_vector(spark, sf_dir):
    table = corpus.table(spark, sf_dir, "embeddings")
    dim = vectors.common_width(table, "embedding")
    return _rounded(vectors.group_mean_vectors(table, "label", "embedding", dim), "mean")


# Labels and metrics


def label_encode(spark, sf_dir):
    split = clean.hash_split(corpus.complete_articles(spark, sf_dir))
    fitted = labels.fit_labels(corpus.part(split, "train"))
    return labels.encode_labels(corpus.part(split, "test"), fitted).select("id", "category", "code")


def label_decode(spark, sf_dir):
    encoded = label_encode(spark, sf_dir).select("id", "code")
    split = clean.hash_split(corpus.complete_articles(spark, sf_dir))
    fitted = labels.fit_labels(corpus.part(split, "train"))
    return labels.decode_labels(encoded, fitted).select("id", "code", "category")


def unseen_labels(spark, sf_dir):
    split = clean.hash_split(corpus.complete_articles(spark, sf_dir))
    train = clean.keep_categories(corpus.part(split, "train"), CATEGORIES)
    return labels.unseen_labels(corpus.part(split, "test"), labels.fit_labels(train))


def _marked(spark, sf_dir) -> DataFrame:
    return corpus.marker_predictions(clean.hash_split(
        clean.working_table(corpus.articles(spark, sf_dir), CATEGORIES)))


def accuracy_by_split(spark, sf_dir):
    return _rounded(metrics.accuracy(_marked(spark, sf_dir), "split"), "accuracy")


def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_marked(spark, sf_dir), [*CATEGORIES, "de"])


def class_report(spark, sf_dir):
    return _rounded(metrics.class_report(_marked(spark, sf_dir)), "precision", "recall", "f1")


def macro_f1(spark, sf_dir):
    return _rounded(metrics.macro_f1(_marked(spark, sf_dir)), "f1_macro")


def _comparison(spark, sf_dir) -> DataFrame:
    table = clean.hash_split(clean.working_table(corpus.articles(spark, sf_dir), CATEGORIES))
    scores = metrics.model_scores(corpus.model_predictions(table))
    return _rounded(metrics.compare_models(scores), "accuracy", "f1_macro")


def model_comparison(spark, sf_dir):
    return _comparison(spark, sf_dir)


def best_model(spark, sf_dir):
    return metrics.best_model(_comparison(spark, sf_dir))


def challenger_gate(spark, sf_dir):
    return metrics.challenger_gate(_comparison(spark, sf_dir), "constant")


def argmax_logits(spark, sf_dir):
    table = corpus.table(spark, sf_dir, "embeddings")
    return table.select("vec_id", classify.argmax_scores(table, "embedding").alias("prediction"))


# Sequences


def _encoded(spark, sf_dir) -> DataFrame:
    table = corpus.split_corpus(spark, sf_dir)
    train = corpus.part(table, "train")
    fitted = labels.fit_labels(train)
    words = vectors.fit_vocabulary(vectors.stored_bags(train, plain_words))
    coded = labels.encode_labels(table, fitted).select("id", "text", "code")
    return sequences.encode(coded, words, "text", "code", SEQUENCE_LENGTH)


def encode_sequence(spark, sf_dir):
    return _encoded(spark, sf_dir).select("id", _joined("input_ids", "input_ids"), "label")


def attention_mask(spark, sf_dir):
    return _encoded(spark, sf_dir).select(
        "id",
        _joined("attention_mask", "attention_mask"),
        _joined("token_type_ids", "token_type_ids"),
    )


def family_inputs(spark, sf_dir):
    inputs = sequences.model_inputs(_encoded(spark, sf_dir), "distilbert-base-uncased")
    return inputs.select(
        "id", _joined("input_ids", "input_ids"), _joined("attention_mask", "attention_mask"), "label"
    )


def sequence_bayes(spark, sf_dir):
    """A classifier over encoded sequences, fitted on the training rows and read on the others."""
    table = corpus.split_corpus(spark, sf_dir)
    train = corpus.part(table, "train")
    fitted = labels.fit_labels(train)
    words = vectors.fit_vocabulary(vectors.stored_bags(train, plain_words))

    def encoded(side):
        coded = labels.encode_labels(side, fitted).select("id", "text", "code")
        return sequences.encode(coded, words, "text", "code", SEQUENCE_LENGTH)

    model = bayes.fit_sequence_bayes(materialize(encoded(train), "sequences"), words.n_terms)
    held_out = materialize(encoded(corpus.part(table, "test")), "sequences")
    scored = bayes.score_sequences(held_out.withColumn("key", F.struct("id", "label")), model, "key")
    return _rounded(scored.select("key.id", "key.label", "predicted", "score"), "score")


def batch_assign(spark, sf_dir):
    table = corpus.complete_articles(spark, sf_dir).select("id")
    in_order = ordering.assign_batches(table, BATCH_SIZE).withColumnRenamed("batch", "in_order")
    shuffled = ordering.assign_batches(in_order, BATCH_SIZE, shuffle=True)
    return shuffled.withColumnRenamed("batch", "shuffled")


def shard_assign(spark, sf_dir):
    return ordering.assign_shards(corpus.complete_articles(spark, sf_dir).select("id"), SHARDS)


# Topics and dimension reduction


def _start(key: str, a: int, b: int) -> list[str]:
    return [
        f"0.1D + (({key} * {a} + {i * b}) % 10) / 10 AS {c}" for i, c in enumerate(columns(8))
    ]


def nmf_one_step(spark, sf_dir):
    """One update of W and then of H from a fixed start, both factors in one table."""
    p = experiment.prepare(spark, sf_dir)
    rows = experiment.stored_rows(p).filter("id IS NOT NULL")
    # Rows that repeat an id are one document here.
    whole = rows.groupBy("id").agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("indices", "values")))
    rows = numbered(whole)
    x = routes_of(rows)
    w = row_blocks(x, rows.filter(F.size("indices") > 0).selectExpr(ROW, *_start("id", 7, 3)), 8)
    h = p.vocabulary.table.selectExpr("term_id", *_start("term_id", 11, 5))
    found = nmf.update(x, w, term_slices(x, h, 8), 8, gram(h, 8))
    terms = nmf.update_terms(found, 8, nmf.documents_gram(found, 8))
    h = materialize(term_rows(x, terms, 8), "nmf-step")
    w = materialize(numbered_rows(x, nmf.updated_documents(found), 8), "nmf-step")
    x.unpersist()
    w = with_keys(rows.filter(F.size("indices") > 0), w)
    documents = w.select(F.lit("document").alias("side"), F.col("id").alias("key"), *columns(8))
    terms = h.select(
        F.lit("term").alias("side"), F.col("term_id").cast("long").alias("key"), *columns(8)
    )
    return _rounded(documents.unionByName(terms), *columns(8))


def nmf_topics(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    return nmf.long_factor(experiment.nmf_fit(p).documents, "id", 8)


def nmf_top_words(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    return topics.top_topic_words(nmf.topic_terms(experiment.nmf_fit(p)), p.vocabulary)


def nmf_error(spark, sf_dir):
    model = experiment.nmf_fit(experiment.prepare(spark, sf_dir))
    steps = list(enumerate(model.errors, start=1))
    return spark.createDataFrame(steps, "iteration long, reconstruction_error double")


def nmf_holdout(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    model = experiment.nmf_fit(p)
    return nmf.transform_nmf(model, experiment.stored_rows(p, "test")).drop("category")


def nmf_holdout_optimality(spark, sf_dir):
    """Whether the weights of every held-out document are the non-negative optimum."""
    p = experiment.prepare(spark, sf_dir)
    model, rows = experiment.nmf_fit(p), experiment.stored_rows(p, "test")
    return nmf.optimality(model, rows, nmf.transform_nmf(model, rows).drop("category"))


def _lda(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    rows = experiment.lda_rows(p)
    return p, rows, experiment.lda_fit(p, rows)


def lda_topics(spark, sf_dir):
    _, rows, fit = _lda(spark, sf_dir)
    return lda.infer(rows, fit).select("id", "category", "vector")


def lda_top_words(spark, sf_dir):
    p, _, fit = _lda(spark, sf_dir)
    return topics.top_topic_words(lda.topic_terms(fit), p.vocabulary)


def lda_quality(spark, sf_dir):
    _, rows, fit = _lda(spark, sf_dir)
    values = {**lda.quality(rows, fit), "steps": float(len(fit.bounds)), "converged": float(fit.converged)}
    return spark.createDataFrame(list(values.items()), "measure string, value double")


def _lda_from_fixed_start(spark, sf_dir):
    """Numbered count rows and a model whose parameters are given by a rule."""
    p = experiment.prepare(spark, sf_dir)
    terms = p.vocabulary.table.selectExpr("term_id", *_start("term_id", 11, 5))
    model = lda.model_of(materialize(terms, "lda-start"), 8, p.vocabulary.n_terms)
    return experiment.lda_rows(p), model


def lda_one_step(spark, sf_dir):
    """Topic-term parameters after one step with one update of the documents."""
    rows, model = _lda_from_fixed_start(spark, sf_dir)
    after, _ = lda.step(routes_of(rows), model, 1, 0.0)
    return _rounded(nmf.long_factor(after.terms, "term_id", 8), "weight")


def lda_document_bounds(spark, sf_dir):
    """Topic shares and bound of every training document under given topics, after one update."""
    rows, model = _lda_from_fixed_start(spark, sf_dir)
    found = lda.infer(rows, model, 1, 0.0)
    shares = [F.round(F.get("vector", F.lit(i)), 6).alias(c) for i, c in enumerate(columns(8))]
    return _rounded(found.select("id", "category", *shares, "bound"), "bound")


def pca_points(spark, sf_dir):
    """Two-dimensional points of all training documents over the whole vocabulary."""
    p = experiment.prepare(spark, sf_dir)
    points = {
        name: reduce.sparse_pca(
            experiment.stored_rows(p, "train", weighting), p.vocabulary.n_terms
        ).points
        for name, weighting in (("counts", "count"), ("tfidf", "tfidf"))
    }
    return reduce.category_points(points)


def pca_topic_points(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    points = {
        "nmf": reduce.dense_pca(nmf.as_array(experiment.nmf_fit(p).documents, 8)),
        "lda": reduce.dense_pca(experiment.feature_array(experiment.lda_features(p))),
    }
    return reduce.category_points(points)


def pca_docvec_points(spark, sf_dir):
    features = experiment.docvec_features(spark, sf_dir)
    points = {"docvec": reduce.dense_pca(experiment.feature_array(features))}
    return reduce.category_points(points)


def embedding_points(spark, sf_dir):
    table = corpus.table(spark, sf_dir, "embeddings")
    return reduce.dense_pca(table.select(F.col("vec_id").alias("id"), "label", "embedding"), "embedding")


# Classifiers


def svc_tfidf(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    features = {"tfidf": experiment.weighted_features(p, "tfidf")}
    return classify.sweep(features, {"svc": classify.newton_svc()})


def svc_counts(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    features = {"counts": experiment.weighted_features(p, "count")}
    return classify.sweep(features, {"svc": classify.newton_svc()})


def svc_nmf(spark, sf_dir):
    features = {"nmf": experiment.nmf_features(experiment.prepare(spark, sf_dir))}
    return classify.sweep(features, {"svc": classify.newton_svc()})


def svc_lda(spark, sf_dir):
    features = {"lda": experiment.lda_features(experiment.prepare(spark, sf_dir))}
    return classify.sweep(features, {"svc": classify.newton_svc()})


def svc_docvec(spark, sf_dir):
    features = {"docvec": experiment.docvec_features(spark, sf_dir)}
    return classify.sweep(features, {"svc": classify.newton_svc()})


def logreg_scores(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    features = experiment.weighted_features(p, "tfidf")
    fitted = classify.train("logreg", features.train, features.size, classify.logistic(reg=1e-4))
    return classify.predict(fitted, features.test, "test")


def mlp_scores(spark, sf_dir):
    features = experiment.docvec_features(spark, sf_dir)
    fitted = classify.train("mlp", features.train, features.size, classify.perceptron())
    return classify.predict(fitted, features.test, "test")


def classifier_sweep(spark, sf_dir):
    features = {"docvec": experiment.docvec_features(spark, sf_dir)}
    factories = {"logreg": classify.logistic(reg=1e-4), "mlp": classify.perceptron()}
    return classify.sweep(features, factories)


def classifier_report(spark, sf_dir):
    """Precision, recall and F1 per category of a trained classifier on the held-out rows."""
    features = {"tfidf": experiment.weighted_features(experiment.prepare(spark, sf_dir), "tfidf")}
    swept = classify.sweep_predictions(features, {"logreg": classify.logistic(reg=1e-4)})
    return _rounded(classify.model_reports(swept), "precision", "recall", "f1")


def results_table(spark, sf_dir):
    path = scratch_path(spark, "results")
    found = svc_tfidf(spark, sf_dir).drop("train_accuracy", "steps", "converged")
    result_sink.write_results(found, path)
    return result_sink.read_results(spark, path)


def saved_model_scores(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    path = experiment.article_model(p).save(scratch_path(spark, "model"))
    model = classify.ArticleModel.load(spark, path)
    return model.score(corpus.part(corpus.split_corpus(spark, sf_dir), "test"))


def saved_factors(spark, sf_dir):
    """Held-out documents under stored topic models and those that were stored: largest differences."""
    p = experiment.prepare(spark, sf_dir)
    rows = experiment.stored_rows(p)
    made = {"nmf": nmf.fit_nmf(rows, p.vocabulary.n_terms, max_iter=5), "vocabulary": p.vocabulary}
    made["lda"] = lda.fit_lda(rows, p.vocabulary.table, p.vocabulary.n_terms, max_iter=3)
    path = scratch_path(spark, "models")
    registry.save_models(spark, path, "topics", **made)
    read = registry.load_models(spark, path, "topics")
    parts = []
    for name, models in (("before", made), ("after", read)):
        bags = materialize(vectors.sparse_rows(p.test, models["vocabulary"]), "held-out")
        shares = lda.infer(bags, models["lda"]).select("id", "vector", F.lit("lda").alias("model"))
        weights = nmf.as_array(nmf.transform_nmf(models["nmf"], bags).drop("category"), 8)
        both = shares.unionByName(weights.withColumn("model", F.lit("nmf")))
        parts.append(both.select("model", "id", F.posexplode("vector").alias("topic", name)))
    differs = F.count_if(F.abs(F.col("before") - F.col("after")) > 1e-9).alias("differs")
    return parts[0].join(parts[1], ["model", "id", "topic"]).groupBy("model", "id").agg(differs)


def new_article_filter(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    model = experiment.article_model(p)
    return model.score_only(corpus.part(corpus.split_corpus(spark, sf_dir), "test"), ["fr", "es"])


# Files and streams


def _as_files(spark, sf_dir, path: str) -> None:
    article_source.write_articles(_small_files(corpus.articles(spark, sf_dir)), path)


def _small_files(table: DataFrame, key="id") -> DataFrame:
    """Rows placed by ``key`` for files that one task each can read, at least a few of them for streams."""
    return table.repartition(max(8, -(-table.count() // ROWS_PER_FILE)), key)


def tsv_scan(spark, sf_dir):
    path = scratch_path(spark, "tsv")
    _as_files(spark, sf_dir, path)
    read = article_source.read_articles(spark, path)
    return read.select(F.col("id").cast("long").alias("id"), "category", "title", "abstract")


def tsv_splits(spark, sf_dir):
    """Write both splits in the folder layout of the loader and load them by split and size."""
    root = scratch_path(spark, "splits")
    split = corpus.articles(spark, sf_dir).withColumn("text", F.coalesce("title", F.lit("")))
    split = clean.hash_split(split)
    for name, side in (("train", "train"), ("validation", "test")):
        path = article_source.split_path(root, name)
        article_source.write_articles(_small_files(corpus.part(split, side)), path)
    train, test = article_source.load_splits(spark, root)
    both = train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )
    return both.groupBy("split", "category").agg(F.count("*").alias("n"))


def entity_rows(spark, sf_dir):
    """The first and last word of each title as entities, written as JSON and parsed again."""
    words = F.filter(F.split("title", "[^A-Za-z]+"), lambda w: w != "")
    entity = [
        F.struct(
            F.get(words, i).alias("Label"),
            F.lit(kind).alias("Type"),
            F.concat(F.lit("Q"), F.length(F.get(words, i))).alias("WikidataId"),
            F.lit(1.0).alias("Confidence"),
            F.array(F.instr(F.col("title"), F.get(words, i)) - 1).alias("OccurrenceOffsets"),
            F.array(F.get(words, i), F.upper(F.get(words, i))).alias("SurfaceForms"),
        )
        for kind, i in (("F", F.lit(0)), ("L", F.size(words) - 1))
    ]
    json = F.when(F.size(words) > 0, F.to_json(F.array(*entity)))
    table = corpus.articles(spark, sf_dir).withColumn("title_entities", json)
    return article_source.entity_rows(table).select(
        "id",
        "label",
        "type",
        "wikidata_id",
        "confidence",
        _joined("occurrence_offsets", "occurrence_offsets"),
        F.array_join("surface_forms", " ").alias("surface_forms"),
    )


def daily_arrivals(spark, sf_dir):
    incoming, output = scratch_path(spark, "incoming"), scratch_path(spark, "arrived")
    _as_files(spark, sf_dir, incoming)
    query = streaming.ingest_arrivals(
        spark, incoming, output, scratch_path(spark, "stream"), max_files=4
    )
    query.awaitTermination()
    arrived = spark.read.schema(article_source.ARTICLE_SCHEMA).parquet(output)
    return arrived.select(F.col("id").cast("long").alias("id"), "category", "title", "abstract")


def stream_score(spark, sf_dir):
    p = experiment.prepare(spark, sf_dir)
    model = experiment.article_model(p)
    incoming, output = scratch_path(spark, "incoming"), scratch_path(spark, "scored")
    _as_files(spark, sf_dir, incoming)
    query = streaming.score_arrivals(
        spark, model, incoming, output, scratch_path(spark, "stream"), max_files=4
    )
    query.awaitTermination()
    return streaming.read_scored(spark, output).select("id", "predicted")


def stream_redelivered(spark, sf_dir):
    """All articles delivered twice, in two runs of a stream: how often and how they were scored."""
    p = experiment.prepare(spark, sf_dir)
    model = experiment.article_model(p)
    incoming, output = scratch_path(spark, "incoming"), scratch_path(spark, "scored")
    checkpoint = scratch_path(spark, "stream")
    arriving = corpus.articles(spark, sf_dir)
    for seed in (1, 2):
        article_source.write_articles(_small_files(arriving, F.xxhash64(F.lit(seed), "id")), f"{incoming}/delivery={seed}")
        query = streaming.score_arrivals(spark, model, f"{incoming}/*", output, checkpoint, max_files=4)
        query.awaitTermination()
    scored = streaming.read_scored(spark, output)
    batch = model.score(streaming.arriving_text(arriving)).withColumnRenamed("predicted", "expected")
    compared = scored.withColumn("id", F.col("id").cast("long")).join(batch, "id")
    return compared.groupBy("id").agg(
        F.count("*").alias("times"), F.count_if(~F.col("predicted").eqNullSafe(F.col("expected"))).alias("differs")
    )


QUERIES = {
    f.__name__: f
    for f in (
        null_profile, project_columns, clean_merge_text, category_filter, funnel_shape,
        table_shape, preview_rows, distinct_labels, category_counts, category_members,
        exact_sample, row_index, md5_split, tokenize_texts, stopword_filter, raw_token_list,
        alphanumeric_words, url_tokens, lemma_lookup, lemma_counts, vocabulary, term_counts, tfidf,
        tfidf_holdout, counts_holdout, matrix_shape, top_words_count, top_words_tfidf,
        word_vector_lookup, document_mean_vector, docvec_features, mean_vector, label_encode, label_decode,
        unseen_labels, accuracy_by_split, confusion_matrix, class_report, macro_f1,
        model_comparison, best_model, challenger_gate, argmax_logits, encode_sequence,
        attention_mask, family_inputs, sequence_bayes, batch_assign, shard_assign, nmf_one_step, nmf_topics,
        nmf_top_words, nmf_error, nmf_holdout, nmf_holdout_optimality, lda_one_step, lda_document_bounds, lda_topics, lda_top_words, lda_quality,
        pca_points, pca_topic_points, pca_docvec_points, embedding_points, svc_tfidf, svc_counts, svc_nmf, svc_lda, svc_docvec,
        logreg_scores, mlp_scores, classifier_sweep, classifier_report, results_table, saved_model_scores,
        saved_factors, new_article_filter, tsv_scan, tsv_splits, entity_rows, daily_arrivals, stream_score, stream_redelivered,
    )
}
