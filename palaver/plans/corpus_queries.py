"""Queries over labelled corpora: preparation, vectors, models, evaluation, file formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from palaver import session
from palaver.functions import text
from palaver.functions.scalars import fixed
from palaver.operators import corpus, evaluation, forest, vectors
from palaver.plans import bindings, stages
from palaver.plans.registry import query
from palaver.sources import files

LABELS = ("toxic", "low_quality")


def labelled(spark, folder):
    """Documents with their labels; ``toxic`` as given, ``low_quality`` from the quality mark."""
    labels = bindings.table(spark, folder, "labels").select(
        "doc_id", "toxic", (1 - F.col("quality")).alias("low_quality"))
    documents = session.spread(bindings.table(spark, folder, "documents"), "doc_id").select(
        "doc_id", F.col("text").alias("comment_text"))
    return corpus.join_labels(documents, labels, "doc_id")


def marked(spark, folder):
    """Labels with every seventh row marked as unused."""
    def unless_unused(name):
        return F.when(F.col("doc_id") % 7 == 0, F.lit(-1)).otherwise(F.col(name)).alias(name)
    return labelled(spark, folder).select("doc_id", "comment_text", *[unless_unused(c) for c in LABELS])


def _lists(spark, folder):
    """Prepared documents as their words in text order: tokenised once, written on first use."""
    documents = session.spread(bindings.table(spark, folder, "documents"), "doc_id").select(
        "doc_id", F.col("text").alias("comment_text"))
    return spark.read.parquet(bindings.stored(spark, folder, "word-lists", lambda path: vectors.placed(
        corpus.prepare(documents), "doc_id", vectors.vocabulary_tokens("comment_text")).write.parquet(path)))


def _vocabulary(spark, folder):
    lists = _lists(spark, folder)
    return spark.read.parquet(bindings.stored(
        spark, folder, "vocabulary", lambda path: vectors.vocabulary_of(lists).write.parquet(path)))


def _codes(spark, folder):
    """Prepared documents as word numbers, read by sequences and embeddings."""
    lists, words = _lists(spark, folder), _vocabulary(spark, folder)
    return spark.read.parquet(bindings.stored(
        spark, folder, "codes", lambda path: vectors.codes(lists, words, "doc_id").write.parquet(path)))


@query
def prepare_corpus(spark, folder):
    documents = session.spread(bindings.table(spark, folder, "documents"), "doc_id").select(
        "doc_id", F.col("text").alias("comment_text"))
    return corpus.prepare(documents, strict=True)


@query
def substitute_text(spark, folder):
    """Ordered substitutions and the signs dropped after them, before tokenising."""
    return bindings.texts(spark, folder).select(
        "comment_id", text.drop_punctuation(text.substitute("message")).alias("message"))


@query
def expand_abbreviations(spark, folder):
    split = bindings.texts(spark, folder).select("comment_id", text.tokens("message").alias("words"))
    return split.select("comment_id", text.expand_abbreviations("words").alias("message"))


@query
def tweet_tokens(spark, folder):
    """Tokens of a tweet without handles; repeated letters stay as they are."""
    return bindings.texts(spark, folder).select(
        "comment_id", F.array_join(text.tweet_tokens("message", shorten=False), " ").alias("tokens"))


@query
def stopword_filter(spark, folder):
    split = bindings.texts(spark, folder).select("comment_id", text.long_tokens("message").alias("words"))
    return split.select("comment_id", F.array_join(text.drop_stopwords("words"), " ").alias("message"))


@query
def label_prevalence(spark, folder):
    """Shares of the labels over all rows and over the used ones."""
    rows = marked(spark, folder)
    every = corpus.label_prevalence(rows, LABELS).withColumn("scope", F.lit("all"))
    used = corpus.label_prevalence(corpus.used_rows(rows), LABELS).withColumn("scope", F.lit("used"))
    return every.unionByName(used)


@query
def labelled_comments(spark, folder):
    return labelled(spark, folder)


@query
def valid_labels(spark, folder):
    texts, labels = corpus.split_columns(corpus.used_rows(marked(spark, folder)).withColumn("id", F.col("doc_id")))
    return labels.select("doc_id", *LABELS)


# --- vectors ---------------------------------------------------------------------------------


@query
def tfidf(spark, folder):
    """Texts are tokenised once, to counted terms, which both the fit and the weights read."""
    documents = session.spread(bindings.table(spark, folder, "documents"), "doc_id").select("doc_id", "text")
    lists = session.written(vectors.counted(documents, "doc_id", vectors.tfidf_tokens("text")), "counted")
    weights = vectors.weights(lists, session.written(vectors.idf_of(lists), "idf"), "doc_id")
    return weights.select("doc_id", "term", "n", fixed("tfidf", 6).alias("tfidf"))


@query
def vocabulary(spark, folder):
    return _vocabulary(spark, folder)


@query
def text_codes(spark, folder):
    """Prepared texts as word numbers in text order, of any length."""
    return _codes(spark, folder).select("doc_id", F.array_join("codes", " ").alias("codes"))


def _sequences(spark, folder, *arguments):
    coded = _codes(spark, folder).select("doc_id", vectors.pad("codes", *arguments).alias("sequence"))
    return coded.select("doc_id", F.array_join("sequence", " ").alias("sequence"))


@query
def padded_sequences_post(spark, folder):
    return _sequences(spark, folder, 20, "post", "post")


@query
def padded_sequences_pre(spark, folder):
    return _sequences(spark, folder, 200, "pre", "pre")


def _matrix(spark, folder):
    """The word of rank r takes the vector numbered r - 1."""
    given = bindings.table(spark, folder, "embeddings").select(
        (F.col("vec_id") + 1).alias("index"), F.col("embedding").alias("vector"))
    return vectors.embedding_matrix(_vocabulary(spark, folder), given, 64, "index")


@query
def vocab_embeddings(spark, folder):
    """Word, rank and the first, last and summed vector values."""
    matrix = _matrix(spark, folder)
    total = F.aggregate("vector", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return matrix.select(
        "word", "index", fixed(F.get("vector", F.lit(0)), 6).alias("first_value"),
        fixed(F.get("vector", F.lit(63)), 6).alias("last_value"), fixed(total, 5).alias("total"),
    )


@query
def mean_embedding(spark, folder):
    means = vectors.mean_of_codes(_codes(spark, folder), _matrix(spark, folder), "doc_id", 64)
    return means.select("doc_id", F.posexplode("vector").alias("dim", "value")).select(
        "doc_id", "dim", fixed("value", 5).alias("value"))


# --- evaluation ------------------------------------------------------------------------------


def _judged(spark, folder):
    """Rule predictions with the true labels of their documents."""
    predictions = stages.analyse(bindings.texts(spark, folder)).select(
        "doc_id", "comment_id", "toxicity_score", "is_toxic",
        F.col("is_toxic").cast("int").alias("predicted_toxic"),
        (F.col("toxic_word_count") > 0).cast("int").alias("predicted_low_quality"),
    )
    truth = bindings.table(spark, folder, "labels").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"), "toxic",
        (1 - F.col("quality")).alias("low_quality"))
    return evaluation.join_truth(predictions, truth)


@query
def prediction_label_join(spark, folder):
    return _judged(spark, folder).select("comment_id", "toxicity_score", "is_toxic", "toxic", "low_quality")


@query
def label_metrics(spark, folder):
    return evaluation.label_report(_judged(spark, folder), {
        "toxic": ("toxic", "predicted_toxic"), "low_quality": ("low_quality", "predicted_low_quality")})


@query
def macro_f1(spark, folder):
    judged = _judged(spark, folder).withColumn("_p", F.col("predicted_low_quality").cast("double"))
    return evaluation.macro_f1(judged, {"toxic": ("toxic", "toxicity_score"), "low_quality": ("low_quality", "_p")})


# --- models ----------------------------------------------------------------------------------


def _trained(spark, folder):
    """Labelled texts and the forest fitted on them, each written on first use in an application."""
    rows = spark.read.parquet(bindings.stored(spark, folder, "labelled", lambda path: corpus.prepare(
        labelled(spark, folder)).write.parquet(path)))
    path = bindings.stored(spark, folder, "forest", lambda path: forest.save_model(forest.fit_forest(rows, "comment_text", LABELS), path))
    return rows, forest.load_model(spark, path)


@query
def forest_predictions(spark, folder):
    """The stored forest of the labelled texts, over the same texts."""
    rows, model = _trained(spark, folder)
    found = forest.predict(model, rows)
    return found.select("doc_id", *[
        F.round(F.get("probabilities", F.lit(i)), 6).alias(f"p_{c}") for i, c in enumerate(LABELS)])


@query
def predict_labels(spark, folder):
    rows, model = _trained(spark, folder)
    found = forest.predict(model, rows).select("doc_id", forest.label_map(LABELS).alias("_m"))
    return found.select("doc_id", *[F.element_at("_m", c).alias(c) for c in LABELS])


@query
def model_or_rule_score(spark, folder):
    """Model score where a model is stored, rule score where none is."""
    rows, model = _trained(spark, folder)
    rows = stages.rule_stage(rows, "comment_text", "rule_score")
    scored = forest.score_with_fallback(rows, model, "rule_score").withColumn("source", F.lit("model"))
    absent = forest.load_model(spark, session.run_folder(spark, "absent"))
    plain = forest.score_with_fallback(rows, absent, "rule_score").withColumn("source", F.lit("rules"))
    return scored.unionByName(plain).select("doc_id", "source", "toxicity_score")


@query
def label_split(spark, folder):
    """Which labelled texts train the model and which test it."""
    return labelled(spark, folder).select("doc_id", corpus.held_out("doc_id").alias("held_out"))


@query
def forest_report(spark, folder):
    """Forests fitted on the training part, measured on the held-out part."""
    rows = session.written(corpus.prepare(labelled(spark, folder)), "labelled")
    model = forest.fit_forest(rows.filter(~corpus.held_out("doc_id")), "comment_text", LABELS)
    found = forest.predict(model, rows.filter(corpus.held_out("doc_id")))
    flags = forest.label_map(LABELS)
    judged = found.select(*LABELS, *[F.element_at(flags, c).alias(f"predicted_{c}") for c in LABELS])
    return evaluation.label_report(judged, {c: (c, f"predicted_{c}") for c in LABELS})


# --- file formats ----------------------------------------------------------------------------


@query
def csv_roundtrip(spark, folder):
    """Labelled documents to CSV and back, quotes and line breaks included."""
    rows = labelled(spark, folder)
    path = session.run_folder(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query
def embedding_text_load(spark, folder):
    """Vectors to text lines and back."""
    path = session.run_folder(spark, "vectors")
    given = bindings.table(spark, folder, "embeddings").select(
        F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("word"), F.col("embedding").alias("vector"))
    files.write_word_vectors(given, path)
    read = files.read_word_vectors(spark, path, 64)
    return read.select("word", F.posexplode("vector").alias("dim", "value")).select(
        "word", "dim", fixed("value", 6).alias("value"))


@query
def param_table_scan(spark, folder):
    """Bound parameters in SQL text over a table."""
    return files.query(
        spark,
        "SELECT event_id, ts, user_id, value FROM {events} WHERE event_type = :kind AND value >= :least",
        {"events": bindings.table(spark, folder, "events")}, kind="click", least=20.0,
    )


