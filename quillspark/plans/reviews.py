"""The review flow: rated texts to features, regressors, classifiers, clusters and rules."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators import classify, cluster, features, learners, metrics, rules, split, vectorize
from ..operators import words as WD
from ..session import stored
from ..sources import artefacts
from ..sources.files import write_csv


def prepare(reviews: DataFrame, n_components: int = V.REVIEW_COMPONENTS) -> dict:
    """Clean rows, TF-IDF and count rows, and principal components (fitted on all rows, not scaled)."""
    rows = stored(WD.rated_reviews(reviews), "rated")
    tfidf = vectorize.fit(rows, "clean_joined", vectorize.REVIEW_TFIDF)
    counts = vectorize.fit(rows, "clean_joined", vectorize.REVIEW_COUNT)
    sparse = vectorize.sparse_rows(rows, "clean_joined", tfidf, "row_id", ("overall", "sentiment"))
    sparse = stored(sparse.withColumnRenamed("weight", "vector"), "tfidf")
    counted = vectorize.sparse_rows(rows, "clean_joined", counts, "row_id", ("sentiment",)).withColumnRenamed("weight", "vector")
    axes = features.fit_projection(sparse, tfidf.size, n_components)
    dense = stored(features.project(sparse, axes), "components")
    return {"rows": rows, "tfidf": tfidf, "counts": counts, "sparse": sparse, "counted": counted, "axes": axes, "dense": dense}


def _sides(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    split_rows = split.at_random(rows.withColumn("id", F.col("row_id")).withColumn("label", F.col(label).cast("double")), "id")
    return split_rows.filter("is_test = 0").persist(), split_rows.filter("is_test = 1").persist()


def regress(dense: DataFrame, models: dict | None = None) -> DataFrame:
    """mae, mse, rmse and r2 of the first component, all components, and second-degree terms of the first five."""
    train, test = _sides(dense, "overall")
    shapes = {"simple": lambda d: features.densify(d, [0]), "multiple": lambda d: d, "polynomial": features.poly_features}
    table = None
    for name, shape in shapes.items():
        model = learners.linear_regression(learners.to_vectors(shape(train)))
        if models is not None and name == "multiple":
            models["multiple_linear_regression"] = model
        row = metrics.regression(learners.shown(model, learners.to_vectors(shape(test))), "y", "p").withColumn("model", F.lit(name))
        table = row if table is None else table.unionByName(row)
    return table


def classify_all(dense: DataFrame, counted: DataFrame, count_size: int, rounds: int = 50, trees: int = 100, models: dict | None = None) -> DataFrame:
    """accuracy, precision, recall and f1 of every classifier on the same test rows. The fitted ones that are saved are put into ``models``."""
    models = {} if models is None else models

    def kept(name: str, model):
        models[name] = model
        return model

    train, test = _sides(dense, "sentiment")
    vt, vs = learners.to_vectors(train).persist(), learners.to_vectors(test).persist()
    ct, cs = _sides(counted, "sentiment")
    made = {
        "Logistic": lambda: learners.shown(kept("logistic_regression", learners.logistic(vt, max_iter=300)), vs),
        "NaiveBayes": lambda: classify.naive_bayes(ct, cs, "id", count_size).select("id", F.col("label").alias("y"), "p"),
        "KNN": lambda: classify.knn(train, test, (3,)),
        "DecisionTree": lambda: learners.shown(learners.decision_tree(vt), vs),
        "SVM": lambda: learners.support_vectors(vt, vs),
        "RandomForest": lambda: learners.shown(learners.random_forest(vt, trees), vs),
        "Bagging": lambda: learners.shown(kept("bagging", learners.bagging(vt)), vs),
        "AdaBoost": lambda: learners.AdaBoost(rounds).fit(vt).predict(vs),
        "GradientBoosting": lambda: learners.shown(learners.gradient_boosting(vt, trees), vs),
        "MLP": lambda: learners.shown(kept("mlp_classifier", learners.perceptron(vt)), vs),
    }
    table = None
    for name, make in made.items():
        row = metrics.binary(make(), "y", "p").withColumn("model", F.lit(name))
        table = row if table is None else table.unionByName(row)
    return table


def forest_folds(dense: DataFrame, k: int = 3, trees: int = 100) -> DataFrame:
    """Scores of a random forest on ``k`` shuffled folds of the training rows."""
    train, _ = _sides(dense, "sentiment")
    folded = split.random_folds(learners.to_vectors(train), "id", k).persist()
    run = (lambda a, b: learners.shown(learners.random_forest(a, trees), b))
    return learners.cross_validate("Random Forest", folded, {}, run)


def clusters(prepared: dict, k: int = 4, models: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """``(row_id, cluster_kmeans, cluster_agg)`` and the top terms of each k-means cluster."""
    rows = learners.to_vectors(prepared["dense"].select(F.col("row_id").alias("id"), "vector")).persist()
    fitted = cluster.kmeans(rows, k)
    if models is not None:
        models["kmeans"] = fitted
    flat = cluster.assign(fitted, rows).select(F.col("id").alias("row_id"), F.col("cluster").alias("cluster_kmeans"))
    flat = stored(flat, "clusters")
    agg = cluster.ward(rows, k).select(F.col("id").alias("row_id"), F.col("cluster").alias("cluster_agg"))
    sparse = prepared["sparse"].withColumnRenamed("vector", "weight")
    weights = vectorize.long_rows(sparse, prepared["tfidf"], "row_id").join(
        flat.select("row_id", F.col("cluster_kmeans").alias("cluster")), "row_id")
    terms = cluster.top_terms(weights, flat.select("row_id", F.col("cluster_kmeans").alias("cluster")))
    return flat.join(agg, "row_id"), terms


def save_models(prepared: dict, models: dict, folder: str) -> None:
    """The eight artefacts: both vocabularies, the projection, and five fitted models."""
    spark = prepared["rows"].sparkSession
    artefacts.save_vocabulary(spark, prepared["tfidf"], os.path.join(folder, "tfidf"))
    artefacts.save_vocabulary(spark, prepared["counts"], os.path.join(folder, "count_vec"))
    artefacts.save_projection(spark, prepared["axes"], os.path.join(folder, "pca"))
    for name, model in models.items():
        artefacts.save_model(model, os.path.join(folder, name))


def run_reviews(reviews: DataFrame, folder: str | None = None, min_support: float = 0.01, max_len: int | None = None,
                rounds: int = 50, trees: int = 100, n_components: int = V.REVIEW_COMPONENTS) -> dict[str, DataFrame]:
    """Every step from rated texts to result tables; with ``folder``, the derived rows are also written as CSV and the fitted models are saved."""
    p, models = prepare(reviews, n_components), {}
    placed, terms = clusters(p, models=models)
    items = p["rows"].select("row_id", F.array_distinct("tokens").alias("items"))
    sets = rules.frequent_itemsets(items, min_support, max_len)
    out = {
        "ratings": p["rows"].groupBy("overall").agg(F.count(F.lit(1)).alias("n")).orderBy("overall"),
        "explained_variance": features.explained_variance(p["dense"], p["axes"]),
        "regression": regress(p["dense"], models),
        "classification": classify_all(p["dense"], p["counted"], p["counts"].size, rounds, trees, models),
        "forest_folds": forest_folds(p["dense"], trees=trees),
        "clusters": placed, "cluster_terms": terms, "itemsets": sets,
        "rules": rules.top_rules(rules.association_rules(sets)),
    }
    out["processed"] = p["rows"].join(placed, "row_id")
    if folder is not None:
        write_csv(out["processed"], os.path.join(folder, "processed_reviews"))
        save_models(p, models, os.path.join(folder, "models"))
    return out
