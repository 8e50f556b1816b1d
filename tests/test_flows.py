"""Both flows from rows to results, their stored collection and their saved models."""

import os
import random

from pyspark.sql import functions as F

from quillspark.operators import classify
from quillspark.operators.collection import Collection
from quillspark.plans import books, reviews
from quillspark.session import scratch_path
from quillspark.sources import artefacts

SUBJECTS = {"garden.pdf": "soil seeds water roots flowers spring leaves shade".split(), "motor.pdf": "engine wheels brakes petrol pistons gears clutch belts".split()}
SMALL = {"Naive Bayes": {"alpha": [0.1, 1.0]}}


def text(rng, words, n=60):
    return " ".join(rng.choice(words + ["common", "shared"]) for _ in range(n))


def test_books_flow(spark):
    rng = random.Random(1)
    pages = spark.createDataFrame([(i, s, i + 1, text(rng, SUBJECTS[s])) for i, s in enumerate(list(SUBJECTS) * 30)], "row_id long, source string, page int, text string")
    folder = scratch_path(spark, "books")
    results = books.run_books(pages, folder, spaces=SMALL, models=tuple(SMALL), n_components=4)
    board = {r["model"]: r for r in results.leaderboard.collect()}
    assert set(board) == set(SMALL) and all(r["f1"] > 0.9 for r in board.values())
    assert books.best_model(results).count() == 1 and set(books.reports(results)) == set(SMALL)
    assert sorted(os.listdir(f"{folder}/models")) == ["naive_bayes", "projection", "vocabulary"]
    assert artefacts.load_vocabulary(spark, f"{folder}/models/vocabulary") == results.fitted["vocabulary"]
    assert classify.NaiveBayes.load(f"{folder}/models/naive_bayes").labels == [0.0, 1.0]
    questions = spark.createDataFrame([(1, "Which petrol engine has brakes?"), (2, "zzz")], "q_id long, query string")
    first = books.answer_questions(results, questions).orderBy("q_id").collect()
    again = Collection(spark, f"{folder}/collection").answer(questions).orderBy("q_id").collect()
    assert first == again and "From motor.pdf" in first[0]["answer"] and first[1]["best_score"] == 0


def test_reviews_features_and_models(spark):
    rng = random.Random(2)
    words = {5.0: "great lovely perfect bought happy cats".split(), 1.0: "broken awful refund returned angry cat".split(), 3.0: "average fine plain usual nothing cats".split()}
    rows = [(i, text(rng, words[r], 12), r) for i, r in enumerate([5.0, 1.0, 3.0] * 30)] + [(100, None, 5.0), (101, "lost rating", None)]
    given = spark.createDataFrame(rows, "row_id long, reviewText string, overall double").repartition(2)
    p, models = reviews.prepare(given, 6), {}
    assert {r["overall"]: r["n"] for r in p["rows"].groupBy("overall").agg(F.count("*").alias("n")).collect()} == {1: 30, 3: 30, 5: 30}
    assert "cats" not in {t for r in p["rows"].collect() for t in r["tokens"]}
    assert reviews.regress(p["dense"], models).count() == 3
    placed, terms = reviews.clusters(p, 3, models)
    assert placed.count() == 90 and terms.count() > 0
    folder = scratch_path(spark, "reviews")
    reviews.save_models(p, models, folder)
    assert sorted(os.listdir(folder)) == ["count_vec", "kmeans", "multiple_linear_regression", "pca", "tfidf"]
    assert artefacts.load_projection(spark, f"{folder}/pca").axes.shape == p["axes"].axes.shape
