"""Corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X


def text_stats(df: DataFrame, text: str) -> DataFrame:
    """mean, median, min, max and population deviation of words, characters and sentences: one pass, one row each.

    The exact median keeps one counter per distinct length, not per text.
    """
    measured = df.select(
        X.word_count(F.col(text)).alias("word_count"), F.length(text).alias("char_count"),
        X.sentence_count(F.col(text)).alias("sentence_count"))
    measured = measured.withColumn("doc_length", F.col("char_count"))
    names = ["word_count", "char_count", "sentence_count", "doc_length"]
    stats = [F.struct(
        F.lit(n).alias("metric"), F.avg(n).alias("mean"), F.percentile(n, F.lit(0.5)).alias("median"),
        F.min(n).cast("double").alias("min"), F.max(n).cast("double").alias("max"),
        F.stddev_pop(n).alias("std")) for n in names]
    return measured.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def word_frequency(df: DataFrame, text: str) -> DataFrame:
    return X.each(df, [], X.words(F.col(text)), "word").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def vocabulary_size(df: DataFrame, text: str, approximate: bool = False) -> DataFrame:
    words = X.each(df, [], X.words(F.col(text)), "word")
    if approximate:
        return words.agg(F.approx_count_distinct("word").alias("vocab_size"))
    return words.distinct().agg(F.count(F.lit(1)).alias("vocab_size"))


def top_words(frequency: DataFrame, top_n: int = 20) -> DataFrame:
    return frequency.orderBy(F.desc("n"), "word").limit(top_n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def length_histogram(df: DataFrame, text: str, width: int = 50) -> DataFrame:
    """Texts per word-count bin of ``width``, starting at the smallest count."""
    counted = df.select(X.word_count(F.col(text)).alias("words")).groupBy("words").agg(F.count(F.lit(1)).alias("n"))
    low = F.min("words").over(W.partitionBy(F.lit(0)))  # one row per distinct length by now
    start = F.col("low") + F.floor((F.col("words") - F.col("low")) / width) * width
    return counted.withColumn("low", low).groupBy(start.cast("int").alias("bin_start")).agg(F.sum("n").alias("n"))


def cloud_weights(frequency: DataFrame) -> DataFrame:
    """Count of each word relative to the most frequent one."""
    top = frequency.agg(F.max("n")).scalar()
    return frequency.select("word", (F.col("n") / top).alias("weight"))
