"""Learners on ``pyspark.ml``: rows have ``id``, a numeric ``label`` and an array ``vector``."""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..session import cut_lineage, forget, scratch_path
from . import metrics, split

DEEPEST = 30
CHECKPOINT_EVERY = 10
PARALLEL = 8
#: Spark's driver holds all nodes of the trees it grows and of a model it applies, some 500 bytes of heap for each row of each tree. So many rows times trees
#: are grown at a time.
GROWN = 600_000
SEED_STEP = 1_000_003

# fixed values: the search spaces, as far as Spark's learners know the parameters
SEARCH = {
    "SVM": {"C": [0.1, 1, 10, 100], "gamma": ["scale", "auto", 0.001, 0.01], "kernel": ["linear", "rbf", "poly"],
            "class_weight": ["balanced", None]},
    "Naive Bayes": {"alpha": [0.01, 0.1, 0.5, 1.0, 1.5], "fit_prior": [True, False]},
    "Random Forest": {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20, 30], "min_samples_leaf": [1, 2, 4],
                      "class_weight": ["balanced", None]},
    "Logistic Regression": {"C": [0.01, 0.1, 1, 10, 100], "penalty": ["l1", "l2"], "class_weight": ["balanced", None]},
}
Predictor = Callable[[DataFrame], DataFrame]


def to_vectors(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.transform("vector", lambda x: x.cast("double")))).drop("vector")


def weighted(rows: DataFrame, class_weight: str | None) -> DataFrame:
    """Add ``w``: 1, or the balanced class weight. One row per class is joined."""
    if class_weight is None:
        return rows.withColumn("w", F.lit(1.0))
    return rows.join(F.broadcast(split.class_weights(rows, "label").select("label", F.col("weight").alias("w"))), "label")


def shown(model: Model | Forest, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select("id", F.col("label").alias("y"), F.col("prediction").alias("p"))


def logistic(train: DataFrame, C: float = 1.0, penalty: str = "l2", class_weight: str | None = None, max_iter: int = 1000) -> Model:
    data = weighted(train, class_weight)
    return LogisticRegression(weightCol="w", regParam=1.0 / (C * train.count()), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                              standardization=False, maxIter=max_iter).fit(data)


class Forest:
    """A forest that the driver does not hold at once. ``models`` gives its parts one after another; one is grown or loaded after the last is gone."""

    def __init__(self, models: Callable[[], Iterator[Model]]):
        self.models = models

    @cached_property
    def featureImportances(self) -> DenseVector:
        total = 0.0
        for model in self.models():
            total = total + sum(t.featureImportances.toArray() for t in getattr(model, "trees", [model]))
            del model
            gc.collect()  # else Python keeps the part alive in the driver's heap
        return DenseVector(total / (total.sum() or 1.0))

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``rawPrediction, probability, prediction`` from the votes of all trees. The votes so far are stored after each part."""
        spark, old = rows.sparkSession, None
        for model in self.models():
            vote = "rawPrediction" if hasattr(model, "trees") else "probability"  # a single tree's counts are no votes
            judged = model.transform(rows)
            votes = vector_to_array(vote)
            judged = judged.withColumn("_votes", votes if old is None else F.zip_with(votes, "_votes", lambda x, y: x + y))
            judged = judged.drop("rawPrediction", "probability", "prediction")
            new = scratch_path(spark, "votes")
            judged.write.parquet(new)
            rows = spark.read.schema(judged.schema).parquet(new)
            if old is not None:
                forget(spark, old)
            old = new
            del model, judged
            gc.collect()
        total = F.aggregate("_votes", F.lit(0.0), lambda s, x: s + x)
        return rows.withColumns({"rawPrediction": array_to_vector("_votes"), "probability": array_to_vector(F.transform("_votes", lambda x: x / total)),
                                 "prediction": (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")}).drop("_votes")

    def save(self, path: str) -> None:
        """One folder for each tree: Spark saves no model of many nodes."""
        n = 0
        for model in self.models():
            for tree in getattr(model, "trees", [model]):
                tree.write().overwrite().save(f"{path}/tree-{n:05}")
                n += 1
            del model, tree
            gc.collect()
        SparkSession.active().createDataFrame([(n,)], "trees int").write.mode("overwrite").parquet(f"{path}/forest")

    @classmethod
    def load(cls, path: str) -> Forest:
        n = SparkSession.active().read.parquet(f"{path}/forest").head()[0]
        return cls(lambda: (DecisionTreeClassificationModel.load(f"{path}/tree-{i:05}") for i in range(n)))


def grown(estimator: RandomForestClassifier, train: DataFrame) -> Model | Forest:
    """One model, or where its nodes would be more than the driver should hold, a :class:`Forest` of as many trees, which grows its parts when it is used.

    The parts of a forest differ in their seeds. Each use, as to predict rows or to save the trees, grows them again.
    """
    trees = estimator.getNumTrees()
    leaves = min(-(-train.count() // estimator.getMinInstancesPerNode()), 1 << estimator.getMaxDepth())
    parts = min(trees, -(-trees * leaves // GROWN))
    if parts <= 1:
        return estimator.fit(train)
    seeds = [V.SEED + SEED_STEP * i for i in range(parts)]
    sizes = [trees * (i + 1) // parts - trees * i // parts for i in range(parts)]
    return Forest(lambda: (estimator.copy({estimator.numTrees: n, estimator.seed: s}).fit(train) for n, s in zip(sizes, seeds)))


def random_forest(train: DataFrame, n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1,
                  class_weight: str | None = None) -> Model | Forest:
    return grown(RandomForestClassifier(weightCol="w", numTrees=n_estimators, maxDepth=max_depth or DEEPEST, minInstancesPerNode=min_samples_leaf,
                                        featureSubsetStrategy="sqrt", cacheNodeIds=True, seed=V.SEED), weighted(train, class_weight))


def decision_tree(train: DataFrame, max_depth: int = DEEPEST) -> Model:
    return DecisionTreeClassifier(maxDepth=max_depth, seed=V.SEED).fit(train)


def bagging(train: DataFrame, n_trees: int = 10) -> Model | Forest:
    return grown(RandomForestClassifier(numTrees=n_trees, maxDepth=DEEPEST, featureSubsetStrategy="all", bootstrap=True, cacheNodeIds=True, seed=V.SEED), train)


def gradient_boosting(train: DataFrame, n_trees: int = 100, depth: int = 3, rate: float = 0.1) -> Model:
    return GBTClassifier(maxIter=n_trees, maxDepth=depth, stepSize=rate, seed=V.SEED).fit(train)


def perceptron(train: DataFrame, hidden: int = 128, max_iter: int = 200) -> Model:
    size = train.select("features").head()["features"].size
    classes = int(train.agg(F.max("label")).head()[0]) + 1
    return MultilayerPerceptronClassifier(layers=[size, hidden, classes], maxIter=max_iter, seed=V.SEED).fit(train)


def linear_regression(train: DataFrame, label: str = "label") -> Model:
    return LinearRegression(labelCol=label, regParam=0.0, solver="normal").fit(train)


def kernel_map(rows: DataFrame, kernel: str, gamma: float, components: int = 256, seed: int = V.SEED, size: int | None = None) -> DataFrame:
    """Features whose dot product is, or approaches, the kernel.

    Random Fourier features (Rahimi and Recht, 2007) for ``rbf``, a tensor sketch (Pham and Pagh, 2013) of degree 3 for ``poly``, ``(gamma x.z)^3``.
    """
    if kernel == "linear":
        return rows
    if kernel not in ("rbf", "poly"):
        raise ValueError("kernel must be 'linear', 'rbf' or 'poly'")
    size = size or rows.select("features").head()["features"].size
    rng = np.random.default_rng(seed)
    if kernel == "poly":
        places = rng.integers(0, components, (3, size))
        sketches = np.zeros((3, size, components))
        for t in range(3):
            sketches[t, np.arange(size), places[t]] = rng.choice([-1.0, 1.0], size) * math.sqrt(gamma)
        held = rows.sparkSession.sparkContext.broadcast(sketches)

        @F.pandas_udf("array<double>")
        def sketch(x):
            if not len(x):
                return type(x)([])
            rows_ = np.stack(x.to_list())
            product_ = np.prod([np.fft.rfft(rows_ @ s, axis=1) for s in held.value], axis=0)
            made = np.fft.irfft(product_, n=components, axis=1)
            made[np.abs(made) < 1e-9 * np.linalg.norm(made, axis=1, keepdims=True)] = 0.0  # the solver would scale up what rounding leaves in empty places
            return type(x)(list(made))

        return rows.withColumn("features", array_to_vector(sketch(vector_to_array("features"))))
    shared = rows.sparkSession.sparkContext.broadcast(
        (rng.standard_normal((size, components)) * math.sqrt(2 * gamma), rng.uniform(0, 2 * math.pi, components)))

    @F.pandas_udf("array<double>")
    def lift(x):
        axes, shift = shared.value
        z = np.cos(np.stack(x.to_list()) @ axes + shift) * math.sqrt(2.0 / components) if len(x) else np.zeros((0, components))
        return type(x)(list(z))

    return rows.withColumn("features", array_to_vector(lift(vector_to_array("features"))))


def gamma_value(train: DataFrame, gamma: str | float) -> float:
    """``auto`` is 1 / features; ``scale`` also divides by the variance over all entries."""
    if not isinstance(gamma, str):
        return float(gamma)
    size = train.select("features").head()["features"].size
    if gamma == "auto":
        return 1.0 / size
    sums = train.select(F.explode(vector_to_array("features")).alias("x")).agg(F.var_pop("x")).head()[0]
    return 1.0 / (size * sums) if sums else 1.0


def margin_machine(total_weight: float, C: float, max_iter: int = 100) -> LinearSVC:
    """Spark divides the losses by the weights' sum; features are penalised as they are."""
    return LinearSVC(regParam=1.0 / (C * total_weight), maxIter=max_iter, weightCol="w", standardization=False)


def coupled(pairwise: np.ndarray) -> np.ndarray:
    """Class probabilities from pairwise ones (second method of Wu, Lin and Weng, 2004).

    ``pairwise[n, i, j]`` is the probability of class i against j. The p with sum 1 that minimises the squares of ``r_ji p_i - r_ij p_j`` solves a linear system.
    """
    n, k, _ = pairwise.shape
    swapped = pairwise.transpose(0, 2, 1)
    system = np.ones((n, k + 1, k + 1))
    system[:, :k, :k] = -swapped * pairwise
    at = np.arange(k)
    system[:, at, at] = (np.where(np.eye(k, dtype=bool), 0.0, swapped) ** 2).sum(axis=2)
    system[:, k, k] = 0
    wanted = np.zeros((n, k + 1, 1))
    wanted[:, k] = 1
    p = np.maximum(np.linalg.solve(system, wanted)[:, :k, 0], 0.0)
    return p / p.sum(axis=1, keepdims=True)


class KernelMachine:
    """Support vector machines on the kernel's features, one per pair of classes, which vote; with ``probability`` also coupled class probabilities.

    A pair's probability is a logistic function of its margin (Platt, 1999), fitted on margins of rows that the machine has not seen, fold by fold. The
    machines of all pairs and folds are fitted at the same time, ``parallel`` of them, and applied in one pass.
    """

    def __init__(self, C: float = 1.0, gamma: str | float = "scale", kernel: str = "rbf", class_weight: str | None = None, max_iter: int = 100,
                 probability: bool = False, folds: int = 3, parallel: int = PARALLEL):
        self.C, self.gamma, self.kernel, self.class_weight, self.max_iter = C, gamma, kernel, class_weight, max_iter
        self.probability, self.folds, self.parallel = probability, folds, parallel

    def fit(self, train: DataFrame) -> KernelMachine:
        self.size = train.select("features").head()["features"].size
        self.scale = 0.0 if self.kernel == "linear" else gamma_value(train, self.gamma)
        data = kernel_map(weighted(train, self.class_weight), self.kernel, self.scale, size=self.size)
        square = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x * x)
        self.norm = math.sqrt(data.agg(F.avg(square)).head()[0] or 1.0)  # rows of length one on average; the solver's first steps fail on long ones
        short = array_to_vector(F.transform(vector_to_array("features"), lambda x: x / self.norm))
        data = split.random_folds(data, "id", self.folds).select("label", short.alias("features"), "w", "fold").persist()
        self.classes = [r[0] for r in data.select("label").distinct().orderBy("label").collect()]
        pairs = [(a, b) for i, a in enumerate(self.classes) for b in self.classes[i + 1:]]
        left_out = [None, *range(self.folds)] if self.probability else [None]
        with ThreadPoolExecutor(self.parallel) as pool:
            made = list(pool.map(lambda j: self._machine(data, *j), [(p, f) for p in pairs for f in left_out]))
            made = [made[i:i + len(left_out)] for i in range(0, len(made), len(left_out))]
            platt = list(pool.map(lambda j: self._platt(data, *j), [(p, m[1:]) for p, m in zip(pairs, made)]))
        data.unpersist()
        self.axes = np.array([m[0][0] for m in made]).reshape(len(made), -1) / self.norm
        self.offset = np.array([m[0][1] for m in made])
        self.platt = np.array(platt).reshape(-1, 2)
        return self

    def _rows(self, data: DataFrame, pair: tuple[float, float]) -> DataFrame:
        return data.filter(F.col("label").isin(*pair)).withColumn("label", (F.col("label") == pair[0]).cast("double"))

    def _machine(self, data: DataFrame, pair: tuple[float, float], left_out: int | None) -> tuple[np.ndarray, float] | None:
        """The machine of a pair, on all its rows or on those outside a fold; none if these are of one class."""
        rows = self._rows(data, pair)
        if left_out is not None:
            rows = rows.filter(F.col("fold") != left_out)
            if rows.select("label").distinct().count() < 2:
                return None
        model = margin_machine(rows.agg(F.sum("w")).head()[0], self.C * self.norm ** 2, self.max_iter).fit(rows)
        return model.coefficients.toArray(), model.intercept

    def _platt(self, data: DataFrame, pair: tuple[float, float], machines: list[tuple[np.ndarray, float] | None]) -> tuple[float, float]:
        """The logistic function of a pair; ``machines`` are those that have not seen fold 0, 1 and so on."""
        unseen, rows = None, self._rows(data, pair)
        for f, machine in enumerate(machines):
            if machine is None:
                continue
            one, shift = machine
            margin = F.aggregate(F.zip_with(vector_to_array("features"), F.lit(one.tolist()), lambda x, y: x * y), F.lit(float(shift)), lambda s, x: s + x)
            part = rows.filter(F.col("fold") == f).select("label", array_to_vector(F.array(margin)).alias("features"))
            unseen = part if unseen is None else unseen.unionAll(part)
        if not self.probability:
            return 0.0, 0.0
        if unseen is None or unseen.select("label").distinct().count() < 2:
            return 1.0, 0.0
        fitted = LogisticRegression(standardization=False, regParam=1e-3).fit(unseen)
        return float(fitted.coefficients[0]), fitted.intercept

    def predict(self, rows: DataFrame) -> DataFrame:
        """``(id, y, p)`` and, with ``probability``, ``probabilities`` in order of ``classes``."""
        k, shared = len(self.classes), rows.sparkSession.sparkContext.broadcast((self.axes, self.offset, self.platt))
        first, second = np.triu_indices(k, 1)
        wants = self.probability

        @F.pandas_udf("struct<place: int, probabilities: array<double>>")
        def judged(x: pd.Series) -> pd.DataFrame:
            axes, offset, platt = shared.value
            n = len(x)
            margins = np.stack(x.to_list()) @ axes.T + offset if n and len(axes) else np.zeros((n, len(axes)))
            votes = np.zeros((n, k))
            np.add.at(votes.T, first, (margins > 0).T)
            np.add.at(votes.T, second, (margins <= 0).T)
            shown: list = [None] * n
            if wants and n:
                pairwise = np.full((n, k, k), 0.5)
                r = np.clip(1.0 / (1.0 + np.exp(-(margins * platt[:, 0] + platt[:, 1]))), 1e-7, 1 - 1e-7)
                pairwise[:, first, second], pairwise[:, second, first] = r, 1 - r
                shown = list(coupled(pairwise))
            return pd.DataFrame({"place": votes.argmax(axis=1), "probabilities": shown})

        lifted = kernel_map(rows, self.kernel, self.scale, size=self.size).select("id", "label", judged(vector_to_array("features")).alias("j"))
        named = F.get(F.lit([float(c) for c in self.classes]), F.col("j.place"))
        shown = [F.col("j.probabilities").alias("probabilities")] if wants else []
        return lifted.select("id", F.col("label").alias("y"), named.alias("p"), *shown)

    def save(self, path: str) -> None:
        """One row for the machine, one per pair of classes."""
        spark = SparkSession.active()
        spark.createDataFrame([(self.kernel, float(self.scale), int(self.size), [float(c) for c in self.classes], self.probability)],
                              "kernel string, scale double, size int, classes array<double>, probability boolean").write.mode("overwrite").parquet(f"{path}/machine")
        rows = [(i, a.tolist(), float(o), p.tolist()) for i, (a, o, p) in enumerate(zip(self.axes, self.offset, self.platt))]
        spark.createDataFrame(rows, "pair int, axes array<double>, offset double, platt array<double>").write.mode("overwrite").parquet(f"{path}/pairs")

    @classmethod
    def load(cls, path: str) -> KernelMachine:
        spark = SparkSession.active()
        r = spark.read.parquet(f"{path}/machine").head()
        made = cls(kernel=r["kernel"], probability=r["probability"])
        made.scale, made.size, made.classes = r["scale"], r["size"], list(r["classes"])
        pairs = spark.read.parquet(f"{path}/pairs").orderBy("pair").collect()
        made.axes, made.offset, made.platt = (np.array([q[c] for q in pairs]) for c in ("axes", "offset", "platt"))
        return made


def support_vectors(train: DataFrame, test: DataFrame, C: float = 1.0, gamma: str | float = "scale", kernel: str = "rbf",
                    class_weight: str | None = None, max_iter: int = 100) -> DataFrame:
    """``(id, y, p)`` of a :class:`KernelMachine` for two classes; for more, of one machine per class against the rest, which takes fewer fits."""
    if int(train.agg(F.max("label")).head()[0]) < 2:
        return KernelMachine(C, gamma, kernel, class_weight, max_iter).fit(train).predict(test)
    g = 0.0 if kernel == "linear" else gamma_value(train, gamma)
    held = weighted(train, class_weight)
    machine = margin_machine(held.agg(F.sum("w")).head()[0], C, max_iter)
    fitted = OneVsRest(classifier=machine, weightCol="w", parallelism=PARALLEL).fit(kernel_map(held, kernel, g))
    return shown(fitted, kernel_map(test, kernel, g))


def margin_probability(train: DataFrame, test: DataFrame, C: float = 1.0, kernel: str = "linear", gamma: str | float = "scale") -> DataFrame:
    """``(id, y, p, probability)``: the probability of the last class."""
    machine = KernelMachine(C, gamma, kernel, probability=True).fit(train)
    return machine.predict(test).select("id", "y", "p", F.element_at("probabilities", -1).alias("probability"))


class AdaBoost:
    """Boosted one-split trees, multi-class (Zhu, Zou, Rosset and Hastie, 2009)."""

    def __init__(self, rounds: int = 50):
        self.rounds = rounds
        self.stumps: list[Model] = []
        self.votes: list[float] = []
        self.errors: list[float] = []

    def fit(self, train: DataFrame) -> AdaBoost:
        """Each round reads the rows once to fit and once to weigh; lineage is cut every few rounds."""
        self.classes = int(train.agg(F.max("label")).head()[0]) + 1
        data = train.select("id", "label", "features").withColumn("w", F.lit(1.0) / train.count()).persist()
        for step in range(self.rounds):
            stump = DecisionTreeClassifier(maxDepth=1, weightCol="w", seed=V.SEED, rawPredictionCol="", probabilityCol="").fit(data)
            judged = stump.transform(data)
            miss = (F.col("prediction") != F.col("label")).cast("double")
            row = judged.agg(F.sum(miss * F.col("w")).alias("e"), F.sum("w").alias("t")).head()
            error = row["e"] / row["t"]
            if error >= 1.0 - 1.0 / self.classes:
                break
            vote = math.log((1 - error) / error) + math.log(self.classes - 1) if error > 0 else 1.0
            self.stumps.append(stump)
            self.votes.append(vote)
            self.errors.append(error)
            if error == 0:
                break
            scale = (1 - error) + error * math.exp(vote)
            raised = judged.withColumn("w", F.col("w") / row["t"] * F.exp(F.lit(vote) * miss) / scale).drop("prediction")
            if (step + 1) % CHECKPOINT_EVERY == 0:
                raised = cut_lineage(raised)
            following = raised.persist()
            following.count()
            data.unpersist()
            data = following
        self.weights = data.select("id", "w")
        return self

    def save(self, path: str) -> None:
        PipelineModel(self.stumps).write().overwrite().save(f"{path}/stumps")
        SparkSession.active().createDataFrame([(self.classes, self.votes, self.errors)], "classes int, votes array<double>, errors array<double>").write.mode(
            "overwrite").parquet(f"{path}/votes")

    @classmethod
    def load(cls, path: str) -> AdaBoost:
        made = cls()
        made.stumps = PipelineModel.load(f"{path}/stumps").stages
        r = SparkSession.active().read.parquet(f"{path}/votes").head()
        made.classes, made.votes, made.errors, made.rounds = r["classes"], list(r["votes"]), list(r["errors"]), len(made.stumps)
        return made

    def predict(self, rows: DataFrame) -> DataFrame:
        tally = [F.lit(0.0)] * self.classes
        data = rows.select("id", "label", "features")
        for i, (stump, vote) in enumerate(zip(self.stumps, self.votes)):
            data = stump.copy({stump.predictionCol: f"p{i}"}).transform(data)
            tally = [t + F.when(F.col(f"p{i}") == c, vote).otherwise(0.0) for c, t in enumerate(tally)]
        scored = data.select("id", "label", F.array(*tally).alias("s"))
        best = (F.array_position("s", F.array_max("s")) - 1).cast("double")
        return scored.select("id", F.col("label").alias("y"), best.alias("p"))


def importances(model: Model | Forest, train: DataFrame, top: int = 20) -> DataFrame:
    """Components of highest importance. The numbers name components, not terms."""
    values = model.featureImportances.toArray()
    rows = sorted(((int(i), float(v)) for i, v in enumerate(values)), key=lambda r: (-r[1], r[0]))[:top]
    return train.sparkSession.createDataFrame(rows, "component int, importance double")


def predictor(name: str, train: DataFrame, params: dict) -> Predictor:
    """Fit the named model and return what turns rows into ``(id, y, p)``."""
    if name == "SVM":
        return lambda rows: support_vectors(train, rows, **params)
    if name == "Random Forest":
        return lambda rows, m=random_forest(train, **params): shown(m, rows)
    if name == "Logistic Regression":
        return lambda rows, m=logistic(train, **params): shown(m, rows)
    raise ValueError(f"unknown model {name}")


def fold_scores(runs: list[tuple[tuple, Callable]], folded: DataFrame, parallel: int = PARALLEL) -> dict[tuple, tuple[float, float]]:
    """``(accuracy, f1)`` for each ``(key, fit_predict)`` and fold, as ``{(*key, fold): ...}``.

    Fits run at the same time, ``parallel`` of them, over folds that the caller keeps in memory; each gives back two numbers.
    """
    folds = [r[0] for r in folded.select("fold").distinct().orderBy("fold").collect()]
    sides = {f: (folded.filter(F.col("fold") != f), folded.filter(F.col("fold") == f)) for f in folds}

    def judge(task: tuple) -> tuple[tuple, tuple[float, float]]:
        key, run, fold = task
        r = metrics.scores(run(*sides[fold]), "y", "p").head()
        return (*key, fold), (r["accuracy"], r["f1"])

    with ThreadPoolExecutor(parallel) as pool:
        return dict(pool.map(judge, [(key, run, f) for key, run in runs for f in folds]))


def cross_validate(name: str, folded: DataFrame, params: dict, fit_predict: Callable | None = None) -> DataFrame:
    """``(fold, accuracy, f1)`` over the ``fold`` column."""
    run = fit_predict or (lambda train, rows: predictor(name, train, params)(rows))
    found = fold_scores([((), run)], folded)
    return folded.sparkSession.createDataFrame([(f, a, s) for (f,), (a, s) in sorted(found.items())], "fold int, accuracy double, f1 double")


def grid(space: dict) -> list[dict]:
    """Every combination; ``gamma`` has no part in a linear kernel, so there only its first value counts."""
    made = [dict(zip(space, values)) for values in product(*space.values())]
    return [p for p in made if p.get("kernel") != "linear" or p.get("gamma") in (None, space.get("gamma", [None])[0])]


def tune(name: str, folded: DataFrame, space: dict | None = None, fit_predict: Callable | None = None, parallel: int = PARALLEL) -> DataFrame:
    """``(model, order, params, cv_mean, cv_std)``: mean and deviation of weighted f1 per parameter set, the best one first. Searches all of ``SEARCH``
    unless given a ``space``."""
    sets = grid(SEARCH[name] if space is None else space)
    run = fit_predict or (lambda train, rows, p: predictor(name, train, p)(rows))
    found = fold_scores([((i,), lambda train, rows, p=p: run(train, rows, p)) for i, p in enumerate(sets)], folded, parallel)
    f1 = {i: [s for (n, _), (_, s) in found.items() if n == i] for i in range(len(sets))}
    rows = [(name, i, repr(p), float(np.mean(f1[i])), float(np.std(f1[i]))) for i, p in enumerate(sets)]
    table = folded.sparkSession.createDataFrame(rows, "model string, order int, params string, cv_mean double, cv_std double")
    return table.orderBy(F.desc("cv_mean"), "order")


def save(model, path: str) -> None:
    """A Spark model in Spark's format; naive Bayes, AdaBoost and a :class:`Forest` by their own ``save``."""
    if isinstance(model, Model):
        PipelineModel([model]).write().overwrite().save(path)
    else:
        model.save(path)


def load(path: str) -> Model:
    return PipelineModel.load(path).stages[0]
