"""Nearest-neighbour and naive Bayes classifiers as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import nearest
from .features import long_form

MAX_CLASSES = 1000


def knn(train: DataFrame, test: DataFrame, ks: tuple[int, ...] = (3,), cells: bool | None = None) -> DataFrame:
    """``(id, y, p, k)``: majority label of the ``k`` nearest training rows, ties to the smaller label.

    One neighbour search serves every ``k``. Both sides have ``id``, ``vector`` and ``label``.
    """
    near = nearest.top_k(test.select("id", "vector"), train.select("id", "vector"), max(ks), cells=cells)
    served = F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank"))
    labels = train.select(F.col("id").alias("item_id"), F.col("label").alias("p"))
    votes = near.join(labels, "item_id").select("q_id", "p", F.explode(served).alias("k"))
    counted = votes.groupBy("q_id", "k", "p").agg(F.count(F.lit(1)).alias("votes"))
    most = F.max("votes").alias("most")
    won = counted.groupBy("q_id", "k").agg(F.min_by("p", F.struct((-F.col("votes")).alias("v"), F.col("p"))).alias("p"), most)
    return test.select("id", F.col("label").alias("y")).join(won.withColumnRenamed("q_id", "id"), "id").select("id", "y", "p", "k")


class NaiveBayes:
    """Multinomial naive Bayes on non-negative sparse rows (``label``, ``idx``, ``vector``)."""

    def __init__(self, size: int, alpha: float = 1.0, fit_prior: bool = True):
        if alpha <= 0:
            raise ValueError("alpha must be positive")
        self.size, self.alpha, self.fit_prior = size, alpha, fit_prior

    def fit(self, rows: DataFrame) -> NaiveBayes:
        """Two aggregates: rows per class, and weight per (class, feature), both combined map-side."""
        found = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).orderBy("label").limit(MAX_CLASSES + 1).collect()
        if len(found) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        total = sum(r["n"] for r in found)
        self.labels = [r["label"] for r in found]
        self.prior = [r["n"] / total if self.fit_prior else 1.0 / len(found) for r in found]
        sums = [F.sum(F.when(F.col("label") == c, F.col("x"))) for c in self.labels]
        per = long_form(rows, ["label"]).groupBy("feature").agg(F.array(*[F.coalesce(s, F.lit(0.0)) for s in sums]).alias("s"))
        weights = {r["feature"]: r["s"] for r in per.collect()}  # at most one row per vocabulary term
        mass = [sum(w[c] for w in weights.values()) + self.alpha * self.size for c in range(len(self.labels))]
        none = [0.0] * len(self.labels)
        self.table = [(i, [weights.get(i, none)[c] + self.alpha for c in range(len(self.labels))]) for i in range(self.size)]
        self.mass = mass
        return self

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        kind = "string" if isinstance(self.labels[0], str) else "double"
        spark.createDataFrame(self.table, "feature int, raw array<double>").write.mode("overwrite").parquet(f"{path}/features")
        spark.createDataFrame(list(zip(range(len(self.labels)), self.labels, self.prior, self.mass)), f"place int, label {kind}, prior double, mass double").write.mode(
            "overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, path: str) -> NaiveBayes:
        spark = SparkSession.active()
        table = spark.read.parquet(f"{path}/features").orderBy("feature").collect()
        classes = spark.read.parquet(f"{path}/classes").orderBy("place").collect()
        made = cls(len(table))
        made.table = [(r["feature"], r["raw"]) for r in table]
        made.labels, made.prior, made.mass = ([r[c] for r in classes] for c in ("label", "prior", "mass"))
        return made

    def predict(self, rows: DataFrame, key: str) -> DataFrame:
        """``(key, label, p, score)``; the sums of a row are complete before the shuffle.

        Feature likelihoods are broadcast: one row per vocabulary term.
        """
        lit = rows.sparkSession.createDataFrame(self.table, "feature int, raw array<double>")
        logs = F.transform("raw", lambda w, c: F.log(w / F.get(F.lit(self.mass), c)))
        table = lit.select("feature", logs.alias("logp"))
        pairs = F.arrays_zip(F.col("idx").alias("idx"), F.col("vector").alias("vector"))
        long = rows.select(key, "label", F.explode_outer(pairs).alias("e")).select(
            key, "label", F.col("e.idx").alias("feature"), F.col("e.vector").alias("x"))
        n = len(self.labels)
        sums = [F.coalesce(F.sum(F.col("x") * F.get("logp", F.lit(c))), F.lit(0.0)) + F.log(F.lit(self.prior[c])) for c in range(n)]
        scored = long.join(F.broadcast(table), "feature", "left").groupBy(key, "label").agg(F.array(*sums).alias("s"))
        scored = scored.withColumn("score", F.array_max("s"))
        best = F.get(F.lit(self.labels), (F.array_position("s", F.col("score")) - 1).cast("int"))
        return scored.select(key, "label", best.alias("p"), "score")


def naive_bayes(train: DataFrame, test: DataFrame, key: str, size: int, alpha: float = 1.0, fit_prior: bool = True) -> DataFrame:
    return NaiveBayes(size, alpha, fit_prior).fit(train).predict(test, key)
