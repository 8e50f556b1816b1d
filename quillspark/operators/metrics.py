"""Evaluation tables. Rows are counted per (label, prediction) first; everything after works on those counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, and 0 where ``bottom`` is 0."""
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(0.0))


def binary(df: DataFrame, y: str, p: str) -> DataFrame:
    """accuracy, precision, recall and f1 of class 1."""
    def total(test: Column) -> Column:
        return F.sum(test.cast("long"))

    c = df.agg(total((F.col(y) == 1) & (F.col(p) == 1)).alias("tp"), total(F.col(p) == 1).alias("pp"),
               total(F.col(y) == 1).alias("yy"), total(F.col(y) == F.col(p)).alias("hit"), F.count(F.lit(1)).alias("n"))
    precision, recall = ratio(F.col("tp"), F.col("pp")), ratio(F.col("tp"), F.col("yy"))
    return c.select(ratio(F.col("hit"), F.col("n")).alias("accuracy"), precision.alias("precision"),
                    recall.alias("recall"), ratio(2 * F.col("tp"), F.col("pp") + F.col("yy")).alias("f1"))


def counts(df: DataFrame, y: str, p: str, *groups: str) -> DataFrame:
    return df.groupBy(*groups, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, y: str, p: str) -> DataFrame:
    """``(y, p, n)`` for every pair of labels, zeros included."""
    found = counts(df, y, p)
    labels = found.select(F.explode(F.array("y", "p")).alias("label")).distinct()
    # every label gets the list of all labels: labels squared, which is the size of the result
    listed = labels.groupBy().agg(F.collect_set("label").alias("all"))
    grid = labels.join(F.broadcast(listed), F.array_contains("all", F.col("label"))).select(
        F.col("label").alias("y"), F.explode("all").alias("p"))
    return grid.join(found, ["y", "p"], "left").select("y", "p", F.coalesce("n", F.lit(0)).alias("n"))


def per_class(found: DataFrame, *groups: str) -> DataFrame:
    """precision, recall, f1 and support of each class from the counts."""
    y, p = F.col("y"), F.col("p")
    sides = found.select(*groups, F.explode(F.array(
        F.struct(y.alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed"),
                 F.when(y == p, F.col("n")).otherwise(0).alias("hit")),
        F.struct(p.alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed"),
                 F.lit(0).cast("long").alias("hit")))).alias("s")).select(*groups, "s.*")
    t = sides.groupBy(*groups, "label").agg(*[F.sum(c).alias(c) for c in ("support", "claimed", "hit")])
    return t.select(*groups, "label", ratio(F.col("hit"), F.col("claimed")).alias("precision"),
                    ratio(F.col("hit"), F.col("support")).alias("recall"),
                    ratio(2 * F.col("hit"), F.col("support") + F.col("claimed")).alias("f1"), "support", "hit")


def report(df: DataFrame, y: str, p: str) -> DataFrame:
    """One row per class, then accuracy, macro and weighted averages."""
    classes = per_class(counts(df, y, p))
    names = ("precision", "recall", "f1")
    n, hit = F.sum("support"), F.sum("hit")
    macro = classes.agg(*[F.avg(c).alias(c) for c in names], n.alias("support")).withColumn("label", F.lit("macro avg"))
    weighted = classes.agg(*[ratio(F.sum(F.col(c) * F.col("support")), n).alias(c) for c in names],
                           n.alias("support")).withColumn("label", F.lit("weighted avg"))
    accuracy = classes.agg(*[ratio(hit, n).alias(c) for c in names], n.alias("support")).withColumn("label", F.lit("accuracy"))
    shown = classes.drop("hit").withColumn("label", F.col("label").cast("string"))
    return shown.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def scores(df: DataFrame, y: str, p: str, *groups: str) -> DataFrame:
    """accuracy and weighted f1 per group."""
    classes = per_class(counts(df, y, p, *groups), *groups)
    n = F.sum("support")
    return classes.groupBy(*groups).agg(ratio(F.sum("hit"), n).alias("accuracy"),
                                        ratio(F.sum(F.col("f1") * F.col("support")), n).alias("f1"))


def fold_summary(fold_scores: DataFrame, *groups: str) -> DataFrame:
    return fold_scores.groupBy(*groups).agg(F.avg("f1").alias("cv_mean"), F.stddev_pop("f1").alias("cv_std"))


def leaderboard(predictions: DataFrame, cv: DataFrame, model: str = "model") -> DataFrame:
    return scores(predictions, "y", "p", model).join(fold_summary(cv, model), model, "left")


def best_model(board: DataFrame, order: str) -> DataFrame:
    """Highest weighted f1; the model trained first wins a tie."""
    return board.orderBy(F.desc("f1"), order).limit(1)


def regression(df: DataFrame, y: str, p: str) -> DataFrame:
    """mae, mse, rmse and r2 in one pass over the rows."""
    e = F.col(y) - F.col(p)
    t = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(y).alias("spread"))
    return t.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.col("spread")).alias("r2"))
