"""Repeatable splits, folds and class weights.

The order is an MD5 hash of seed and key, so a row falls on the same side on every run and cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from .numbering import hash_bucket, hash_order, rank_in_groups


def hex_below(share: float) -> str:
    """First eight hexadecimal digits that are no longer below ``share`` of the hash range."""
    return f"{-int(-share * 2**32 // 1):08x}"


def stratified(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = V.SEED) -> DataFrame:
    """Add ``is_test``: the first ``round(test_share * n)`` rows of each label in hash order."""
    ranked = _ranked(df, label, key, seed)
    test = (F.col("_rank") <= F.round(F.col("_total") * test_share)).cast("int")
    return ranked.withColumn("is_test", test).drop("_rank", "_total")


def at_random(df: DataFrame, key: str, test_share: float = 0.2, seed: int = V.SEED) -> DataFrame:
    """Add ``is_test`` by a threshold on the hash: no sort and no shuffle."""
    return df.withColumn("is_test", (hash_bucket(hash_order(seed, key), 8) < hex_below(test_share)).cast("int"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = V.SEED) -> DataFrame:
    ranked = _ranked(df, label, key, seed)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_total")


def random_folds(df: DataFrame, key: str, k: int = 3, seed: int = V.SEED) -> DataFrame:
    place = hash_bucket(hash_order(seed, key), 8)
    fold: Column = F.lit(0)
    for i in range(1, k):
        fold = fold + (place >= hex_below(i / k)).cast("int")
    return df.withColumn("fold", fold)


def _ranked(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    order = hash_order(seed, key)
    return rank_in_groups(df, [label], [order, F.col(key)], hash_bucket(order), "_rank", total="_total")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight n / (k * n_label); one row per label."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = W.partitionBy(F.lit(0))  # over labels, not rows
    return sizes.select(label, "n", (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"))


def encode_labels(df: DataFrame, label: str) -> DataFrame:
    """``(label, label_idx)``: distinct labels in sorted order, numbered from 0."""
    rows = df.select(label).distinct()
    return rows.withColumn("label_idx", (F.row_number().over(W.partitionBy(F.lit(0)).orderBy(label)) - 1).cast("int"))
