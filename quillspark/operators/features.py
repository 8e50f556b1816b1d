"""Feature selection, scaling, projection and expansion.

Statistics are one aggregate per feature and are small once aggregated; they are then applied row by row
as constants, so the data itself is not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.text import each
from .nearest import _matrix

STEP_ROWS = 512
EXTRA_COLUMNS = 20
CONSTANT = 1e-12


def long_form(df: DataFrame, keep: list[str]) -> DataFrame:
    """``(keep.., feature, x)`` from dense ``vector`` or sparse ``idx`` and ``vector`` columns."""
    if "idx" not in df.columns:
        return each(df, keep, F.col("vector"), "x", place="feature").withColumn("x", F.col("x").cast("double"))
    pairs = F.arrays_zip(F.col("idx").alias("idx"), F.col("vector").alias("vector"))
    return each(df, keep, pairs, "e").select(
        *keep, F.col("e.idx").alias("feature"), F.col("e.vector").cast("double").alias("x"))


def f_scores(df: DataFrame, label: str) -> DataFrame:
    """ANOVA F of each feature against the label. Absent entries count as zero; constant features score null."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    whole = sizes.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")).head()
    n, k = whole["n"], whole["k"]
    sums = long_form(df, [label]).groupBy("feature", label).agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    per = sums.join(F.broadcast(sizes), label).groupBy("feature").agg(
        F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n_c")).alias("b"))
    if n is None or k < 2 or n <= k:
        raise ValueError("scores need two labels or more, and more rows than labels")
    between = (F.col("b") - F.col("s") * F.col("s") / n) / (k - 1)
    within = (F.col("q") - F.col("b")) / (n - k)
    return per.select("feature", F.when(within > 1e-15, between / within).alias("f"))


def select_k_best(df: DataFrame, label: str, k: int) -> list[int]:
    """The ``k`` features of highest F, in feature order."""
    best = f_scores(df, label).orderBy(F.desc_nulls_last("f"), "feature").limit(k)
    return sorted(r["feature"] for r in best.collect())


def densify(df: DataFrame, features: list[int]) -> DataFrame:
    """Dense ``vector`` of the chosen features only."""
    if "idx" not in df.columns:
        return df.withColumn("vector", F.array(*[F.get("vector", F.lit(i)) for i in features]))
    at = [F.coalesce(F.get("vector", F.array_position("idx", F.lit(i)).cast("int") - 1), F.lit(0.0)) for i in features]
    return df.withColumn("vector", F.array(*at)).drop("idx")


def column_stats(df: DataFrame) -> dict[str, list[float]]:
    """Per-feature mean, population deviation, minimum and maximum of a dense ``vector`` column."""
    t = long_form(df, []).groupBy("feature").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    rows = sorted(t.collect(), key=lambda r: r["feature"])
    return {c: [r[c] for r in rows] for c in ("mean", "std", "min", "max")}


def _affine(df: DataFrame, shift: list[float], scale: list[float]) -> DataFrame:
    """A column whose scale is rounding residue of its values is constant and becomes 0."""
    low, factor = F.lit(shift), F.lit([0.0 if s <= CONSTANT * max(abs(m), abs(m + s)) else 1.0 / s for m, s in zip(shift, scale)])
    return df.withColumn("vector", F.transform(
        "vector", lambda x, i: (x.cast("double") - F.get(low, i)) * F.get(factor, i)))


def standard_scaler(df: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Fit on ``df``: zero mean and unit population deviation; constant features become 0."""
    s = column_stats(df)
    return lambda rows: _affine(rows, s["mean"], s["std"])


def minmax_scaler(df: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Fit on ``df``: the range of each feature becomes 0 to 1."""
    s = column_stats(df)
    return lambda rows: _affine(rows, s["min"], [b - a for a, b in zip(s["min"], s["max"])])


def standard_scale(df: DataFrame) -> DataFrame:
    return standard_scaler(df)(df)


def minmax_scale(df: DataFrame) -> DataFrame:
    return minmax_scaler(df)(df)


def poly_terms(vector: Column, n: int) -> list[tuple[str, Column]]:
    """The first ``n`` entries, then all their products of two, named by position."""
    x = [F.get(vector, F.lit(i)).cast("double") for i in range(n)]
    return [(f"x{i}", x[i]) for i in range(n)] + [(f"x{i}_x{j}", x[i] * x[j]) for i in range(n) for j in range(i, n)]


def poly_features(df: DataFrame, n: int = 5) -> DataFrame:
    return df.withColumn("vector", F.array(*[c for _, c in poly_terms(F.col("vector"), n)]))


@dataclass
class Projection:
    """Axes of a principal component (centred) or truncated singular value (not centred) projection."""

    mean: np.ndarray
    axes: np.ndarray
    variance_ratio: list[float]


def _pass(df: DataFrame, dim: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """AᵀAQ, the column sums and the column square sums of the rows, added up by Spark per feature."""
    shared = df.sparkSession.sparkContext.broadcast(q)
    width = q.shape[1] + 2
    cols = [c for c in ("idx", "vector") if c in df.columns]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, width))
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                x = _matrix(part.column("vector"), part.column("idx") if "idx" in cols else None, dim)
                total[:, :-2] += x.T @ (x @ shared.value)
                total[:, -2] += x.sum(axis=0)
                total[:, -1] += (x * x).sum(axis=0)
        values = pa.ListArray.from_arrays(np.arange(0, dim * width + 1, width, dtype=np.int32), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), values], names=["i", "v"])

    parts = df.select(*cols).mapInArrow(partial, "i int, v array<double>")
    summed = parts.groupBy("i").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    rows = summed.select("i", vector_to_array("v").alias("v")).toArrow().sort_by("i")
    out = np.array(rows.column("v").combine_chunks().flatten()).reshape(dim, width)
    return out[:, :-2], out[:, -2], out[:, -1]


def fit_projection(df: DataFrame, dim: int, k: int, centre: bool = True, seed: int = V.SEED, tolerance: float = 1e-8) -> Projection:
    """Leading axes by block Krylov iteration (Musco and Musco, 2015).

    One rule for all sizes: a pass over the rows adds a block to the basis until every kept axis ``q`` fulfils ``|AᵀAq - qλ| <= tolerance * λ_max``, or
    the basis spans everything the rows span, which is exact.
    """
    n = df.count()
    k = max(1, min(k, dim, n))
    fresh = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, min(dim, k + EXTRA_COLUMNS))))[0]
    basis, images = np.zeros((dim, 0)), np.zeros((dim, 0))
    while True:
        z, sums, squares = _pass(df, dim, fresh)
        mean = sums / n
        if centre:
            z = z - n * np.outer(mean, mean @ fresh)
        basis, images = np.hstack([basis, fresh]), np.hstack([images, z])
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        lead = np.argsort(values)[::-1][:k]
        axes = basis @ turn[:, lead]
        top = max(abs(values[lead[0]]), np.finfo(float).tiny)
        left = np.linalg.norm(images @ turn[:, lead] - axes * values[lead], axis=0).max()
        if basis.shape[1] >= dim or left <= tolerance * top:
            break
        rest = z - basis @ (basis.T @ z)
        rest -= basis @ (basis.T @ rest)
        u, size, _ = np.linalg.svd(rest, full_matrices=False)
        fresh = u[:, size > 1e-13 * top][:, :dim - basis.shape[1]]
        if not fresh.shape[1]:
            break
        fresh = np.linalg.qr(fresh - basis @ (basis.T @ fresh))[0]
    flip = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(lead))])
    axes = axes * np.where(flip == 0, 1, flip)
    total = (squares - n * mean * mean).sum()
    own = values[lead] if centre else values[lead] - n * (mean @ axes) ** 2
    ratios = own / total if total > 0 else np.zeros(len(lead))
    return Projection(mean if centre else np.zeros(dim), axes, [float(r) for r in ratios])


def project(df: DataFrame, p: Projection) -> DataFrame:
    """Replace ``vector`` (and ``idx``) by the coordinates on the axes; other columns pass through."""
    kept = [c for c in df.columns if c not in ("idx", "vector")]
    shared = df.sparkSession.sparkContext.broadcast((p.axes, p.mean @ p.axes))
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("vector", T.ArrayType(T.DoubleType()))])
    dim, k = p.axes.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, shift = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                x = _matrix(part.column("vector"), part.column("idx") if "idx" in part.schema.names else None, dim)
                y = (x @ axes - shift).ravel()
                offsets = np.arange(0, len(y) + 1, k, dtype=np.int32)
                arrays = [part.column(c) for c in kept] + [pa.ListArray.from_arrays(offsets, pa.array(y))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "vector"])

    return df.mapInArrow(run, schema)


def explained_variance(df: DataFrame, p: Projection) -> DataFrame:
    rows = [(i, r) for i, r in enumerate(p.variance_ratio)]
    return df.sparkSession.createDataFrame(rows, "component int, ratio double")
