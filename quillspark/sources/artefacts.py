"""Saving and loading what was fitted: vocabularies and projections as Parquet, learners in Spark's own format."""

from __future__ import annotations

import numpy as np
from pyspark.sql import SparkSession

from ..operators.features import Projection
from ..operators.learners import load as load_model  # noqa: F401
from ..operators.learners import save as save_model  # noqa: F401
from ..operators.vectorize import VectorizerSpec, Vocabulary


def save_vocabulary(spark: SparkSession, vocab: Vocabulary, path: str) -> None:
    vocab.table(spark).write.mode("overwrite").parquet(f"{path}/terms")
    s = vocab.spec
    head = [(vocab.n_docs, s.low, s.high, s.min_df, float(s.max_df), s.max_features, s.sublinear, s.kind)]
    spark.createDataFrame(head, "n_docs long, low int, high int, min_df int, max_df double, max_features int,"
                                " sublinear boolean, kind string").write.mode("overwrite").parquet(f"{path}/spec")


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    head = spark.read.parquet(f"{path}/spec").head().asDict()
    rows = spark.read.parquet(f"{path}/terms").select("term", "term_idx", "tf", "df").orderBy("term_idx").collect()
    n_docs = head.pop("n_docs")
    return Vocabulary(VectorizerSpec(**head), n_docs, tuple(tuple(r) for r in rows))


def save_projection(spark: SparkSession, p: Projection, path: str) -> None:
    rows = [(i, float(m), [float(x) for x in a]) for i, (m, a) in enumerate(zip(p.mean, p.axes))]
    spark.createDataFrame(rows, "feature int, mean double, axes array<double>").write.mode("overwrite").parquet(f"{path}/axes")
    spark.createDataFrame([(p.variance_ratio,)], "ratio array<double>").write.mode("overwrite").parquet(f"{path}/variance")


def load_projection(spark: SparkSession, path: str) -> Projection:
    rows = spark.read.parquet(f"{path}/axes").orderBy("feature").collect()
    ratio = spark.read.parquet(f"{path}/variance").head()["ratio"]
    return Projection(np.array([r["mean"] for r in rows]), np.array([r["axes"] for r in rows]), list(ratio))
