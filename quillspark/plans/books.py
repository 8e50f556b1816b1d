"""The book flow: pages to chunks, profile, vector table, tuned classifiers and answers."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text as X
from ..operators import classify, features, learners, metrics, profile, split, vectorize
from ..operators import words as WD
from ..operators.collection import Collection
from ..session import scratch_path, stored
from ..sources import artefacts


@dataclass
class BookResults:
    """What a run leaves. ``models`` holds the fitted models by name, ``fitted`` vocabulary, chosen features, scaling and projection."""

    chunks: DataFrame
    analysis: dict[str, DataFrame] = field(default_factory=dict)
    leaderboard: DataFrame | None = None
    tuning: dict[str, DataFrame] = field(default_factory=dict)
    predictions: dict[str, DataFrame] = field(default_factory=dict)
    models: dict = field(default_factory=dict)
    fitted: dict = field(default_factory=dict)
    labels: DataFrame | None = None
    collection: Collection | None = None


def analyse(pages: DataFrame) -> dict[str, DataFrame]:
    """Statistics, vocabulary size and word frequencies of the cleaned pages."""
    cleaned = WD.clean_pages(pages).select(X.clean_book(F.col("text")).alias("clean"))
    frequency = profile.word_frequency(cleaned, "clean")
    return {"stats": profile.text_stats(cleaned, "clean"), "vocab_size": profile.vocabulary_size(cleaned, "clean"),
            "word_freq": frequency, "most_common": profile.top_words(frequency),
            "histogram": profile.length_histogram(cleaned, "clean")}


def feature_rows(chunks: DataFrame, n_components: int = V.N_COMPONENTS, kind: str = "tfidf", reducer: str = "pca", fit_on: str = "train",
                 select: bool = True, reduce: bool = True, fitted: dict | None = None) -> tuple[DataFrame, DataFrame, int]:
    """``(dense, sparse, size)`` for ``(id, label, text, is_test)`` chunks: selected, scaled and projected features, and weights.

    ``fit_on='train'`` fits vocabulary, selection and projection on the training rows only; ``'all'`` on every row. ``select=False`` keeps every term,
    ``reduce=False`` leaves out scaling and projection. What was fitted is put into ``fitted``.
    """
    if reducer not in ("pca", "svd"):
        raise ValueError("reducer must be 'pca' or 'svd'")
    if fit_on not in ("train", "all"):
        raise ValueError("fit_on must be 'train' or 'all'")
    if kind not in ("tfidf", "count"):
        raise ValueError("vectorizer kind must be 'tfidf' or 'count'")
    spec = vectorize.BOOK_TFIDF if kind == "tfidf" else vectorize.BOOK_COUNT
    fitted = {} if fitted is None else fitted

    def base(df: DataFrame) -> DataFrame:
        return df if fit_on == "all" else df.filter("is_test = 0")

    vocab = fitted["vocabulary"] = vectorize.fit(base(chunks), "text", spec)
    sparse = vectorize.sparse_rows(chunks, "text", vocab, "id", ("label", "is_test")).withColumnRenamed("weight", "vector")
    sparse = stored(sparse, "sparse")
    chosen = fitted["features"] = features.select_k_best(base(sparse), "label", min(500, n_components)) if select else list(range(vocab.size))
    dense = stored(features.densify(sparse, chosen), "selected")
    if not reduce:
        return dense, sparse, vocab.size
    scale = features.standard_scaler if reducer == "pca" else features.minmax_scaler
    scaled = scale(base(dense))(dense)
    axes = fitted["projection"] = features.fit_projection(base(scaled), len(chosen), n_components, centre=reducer == "pca")
    return stored(features.project(scaled, axes), "projected"), sparse, vocab.size


def _fit(name: str, size: int):
    """What fits the named model on rows and parameters, and what predicts rows with it."""
    if name == "Naive Bayes":
        fit = lambda rows, p: classify.NaiveBayes(size, **p).fit(rows)
        return fit, lambda m, rows: m.predict(rows, "id").select("id", F.col("label").alias("y"), "p")
    if name == "SVM":
        return (lambda rows, p: learners.KernelMachine(**p).fit(rows)), (lambda m, rows: m.predict(rows))
    fit = {"Random Forest": learners.random_forest, "Logistic Regression": learners.logistic}[name]
    return (lambda rows, p: fit(rows, **p)), learners.shown


def train(chunks: DataFrame, tune: bool = True, spaces: dict[str, dict] | None = None, models: tuple[str, ...] = tuple(learners.SEARCH),
          n_components: int = V.N_COMPONENTS, kind: str = "tfidf", reducer: str = "pca", fit_on: str = "train", select: bool = True, reduce: bool = True,
          folder: str | None = None) -> BookResults:
    """Tune, fit and judge each model on a stratified split with five stratified folds. ``label`` holds class names.

    The whole search space is tried unless ``spaces`` names a smaller one for a model. With ``folder``, the fitted models, vocabulary and projection are saved.
    """
    codes = split.encode_labels(chunks, "label")
    rows = chunks.join(F.broadcast(codes), "label").select(
        F.col("chunk_id").alias("id"), F.col("label_idx").cast("double").alias("label"), "text")
    rows = stored(split.stratified(rows, "label", "id"), "split")
    results, board = BookResults(chunks, labels=codes), None
    dense, sparse, size = feature_rows(rows, n_components, kind, reducer, fit_on, select, reduce, results.fitted)
    for order, name in enumerate(models):
        bayes = name == "Naive Bayes"
        data = sparse if bayes else learners.to_vectors(dense)
        train_rows, test_rows = (data.filter(f"is_test = {t}").drop("is_test").persist() for t in (0, 1))
        folded = split.stratified_folds(train_rows, "label", "id").persist()
        fit, predict = _fit(name, size)
        run = lambda a, b, p, fit=fit, predict=predict: predict(fit(a, p), b)
        params: dict = {}
        if tune:
            space = (spaces or {}).get(name, learners.SEARCH[name])
            results.tuning[name] = stored(learners.tune(name, folded, space, run), "tuning")
            best = results.tuning[name].orderBy(F.desc("cv_mean"), "order").head()["order"]
            params = learners.grid(space)[best]
        results.models[name] = fit(train_rows, params)
        results.predictions[name] = stored(predict(results.models[name], test_rows), "predictions")
        folds = learners.cross_validate(name, folded, params, lambda a, b, p=params, r=run: r(a, b, p))
        scored = metrics.leaderboard(results.predictions[name].withColumn("model", F.lit(name)), folds.withColumn("model", F.lit(name)))
        row = scored.withColumn("model_order", F.lit(order)).withColumn("params", F.lit(repr(params or "Default"))).withColumn(
            "features", F.lit("TF-IDF" if bayes else "PCA"))
        board = row if board is None else board.unionByName(row)
        for cached in (train_rows, test_rows, folded):
            cached.unpersist()
    results.leaderboard = stored(board, "leaderboard")
    if folder is not None:
        save_models(results, folder)
    return results


def save_models(results: BookResults, folder: str) -> None:
    """Every fitted model under its name, the vocabulary and the projection."""
    for name, model in results.models.items():
        artefacts.save_model(model, os.path.join(folder, name.lower().replace(" ", "_")))
    artefacts.save_vocabulary(results.chunks.sparkSession, results.fitted["vocabulary"], os.path.join(folder, "vocabulary"))
    if "projection" in results.fitted:
        artefacts.save_projection(results.chunks.sparkSession, results.fitted["projection"], os.path.join(folder, "projection"))


def reports(results: BookResults) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Class report and confusion table of each model's test rows."""
    return {name: (metrics.report(p, "y", "p"), metrics.confusion(p, "y", "p")) for name, p in results.predictions.items()}


def best_model(results: BookResults) -> DataFrame:
    return metrics.best_model(results.leaderboard, "model_order")


def run_books(pages: DataFrame, folder: str | None = None, analysis: bool = True, train_models: bool = True, tune: bool = True,
              label: str = "label", **training) -> BookResults:
    """Every step from page records to trained models. The chunks become a stored collection; it, and the models, are kept in ``folder`` if given."""
    spark = pages.sparkSession
    chunks = stored(WD.chunk_table(pages), "chunks")
    named = chunks if label == "label" else chunks.withColumn("label", F.col(label))
    models = os.path.join(folder, "models") if folder else None
    results = train(named, tune, folder=models, **training) if train_models else BookResults(chunks)
    results.chunks = chunks
    results.collection = Collection.make(spark, os.path.join(folder, "collection") if folder else scratch_path(spark, "collection"), chunks)
    results.analysis = analyse(pages) if analysis else {}
    return results


def answer_questions(results: BookResults, questions: DataFrame, k: int = V.TOP_K, legacy_query: bool = False) -> DataFrame:
    """Answers from the run's collection, which is read, not made again."""
    return results.collection.answer(questions, k, legacy_query)
