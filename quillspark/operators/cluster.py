"""Clustering: k-means, two-stage Ward, and the terms that mark a cluster."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .features import each

MICRO_CLUSTERS = 256


def kmeans(rows: DataFrame, k: int = 4, seed: int = V.SEED) -> KMeansModel:
    return KMeans(k=k, seed=seed, maxIter=100).fit(rows)


def assign(model: KMeansModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).select("id", F.col("prediction").alias("cluster"))


def kmeans_step(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """One assignment and update from given ``(cluster, centre)`` rows: ``(cluster, n, feature, x)``.

    The centres are few and are applied as constants.
    """
    fixed = [(r["cluster"], [float(x) for x in r["centre"]]) for r in centres.orderBy("cluster").collect()]
    gaps = [F.struct(F.round(F.aggregate(F.zip_with("vector", F.lit(c), lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                                         lambda s, x: s + x), 9).alias("d"), F.lit(name).alias("cluster")) for name, c in fixed]
    near = rows.select(F.transform("vector", lambda x: x.cast("double")).alias("vector")).select(
        F.array_min(F.array(*gaps))["cluster"].alias("cluster"), "vector")
    long = each(near, ["cluster"], F.col("vector"), "v", place="feature")
    return long.groupBy("cluster", "feature").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("x"))


def ward_merge(centres: np.ndarray, sizes: np.ndarray, k: int) -> list[int]:
    """Merge weighted centres bottom-up by least growth of squared error until ``k`` groups remain."""
    groups = [[i] for i in range(len(centres))]
    c, n = centres.astype(float).copy(), sizes.astype(float).copy()
    while len(groups) > k:
        gap = ((c[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        cost = gap * (n[:, None] * n[None, :]) / (n[:, None] + n[None, :])
        np.fill_diagonal(cost, np.inf)
        a, b = sorted(np.unravel_index(cost.argmin(), cost.shape))
        c[a] = (c[a] * n[a] + c[b] * n[b]) / (n[a] + n[b])
        n[a] += n[b]
        groups[a] += groups[b]
        c, n = np.delete(c, b, axis=0), np.delete(n, b)
        del groups[b]
    label = [0] * len(centres)
    for g, members in enumerate(groups):
        for m in members:
            label[m] = g
    return label


def ward(rows: DataFrame, k: int = 4, micro: int = MICRO_CLUSTERS, seed: int = V.SEED) -> DataFrame:
    """``(id, cluster)``: k-means to at most ``micro`` centres on Spark, Ward merging of those few centres, then a map back."""
    small = KMeans(k=micro, seed=seed, maxIter=20).fit(rows)
    placed = assign(small, rows).persist()
    sizes = {r["cluster"]: r["n"] for r in placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    used = sorted(sizes)
    centres = np.array([small.clusterCenters()[i] for i in used])
    merged = dict(zip(used, ward_merge(centres, np.array([sizes[i] for i in used]), k)))
    lookup = F.lit([merged.get(i, -1) for i in range(max(used) + 1)])
    return placed.select("id", F.get(lookup, F.col("cluster")).alias("cluster"))


def top_terms(weights: DataFrame, clusters: DataFrame, top: int = 10) -> DataFrame:
    """``(cluster, rank, term, weight)``: terms of highest mean weight over all rows of a cluster.

    ``weights`` is ``(cluster, term, weight)``. Sums per (cluster, term) are combined map-side; ranking sees only them.
    """
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    sums = weights.groupBy("cluster", "term").agg(F.sum("weight").alias("s"))
    means = sums.join(F.broadcast(sizes), "cluster").select("cluster", "term", F.round(F.col("s") / F.col("n"), 9).alias("weight"))
    place = F.row_number().over(W.partitionBy("cluster").orderBy(F.desc("weight"), "term"))
    return means.withColumn("rank", place).filter(F.col("rank") <= top)
