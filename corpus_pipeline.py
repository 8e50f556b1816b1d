"""The corpus pipeline: language identification, near copies, personal data, mixture of sources, packing.

Every stage takes the documents that its predecessor kept and all stages but the last give back the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm import langid, mixing, packing, shingle_join, surrogates
from quillspark.llm.queries import tokenizer_path
from quillspark.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones taught; the others go. ``lang`` becomes the language found."""
    named = langid.annotated(docs, langid.learn(docs)).filter(~F.col("rejected"))
    return named.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, once. Documents without an id stay."""
    found = shingle_join.jaccard_components(docs)
    kept = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    once = F.row_number().over(W.partitionBy("doc_id").orderBy("text"))
    single = docs.join(kept, "doc_id", "left_semi").withColumn("_once", once).filter(F.col("_once") == 1)
    return single.select(*docs.columns).unionAll(docs.filter(F.col("doc_id").isNull()))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    made = surrogates.with_surrogates(docs)
    return made.select(*[F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str, seed: int = 17) -> DataFrame:
    """Each document as often as the mix takes it. A part of a document counts as a whole one with the part's share of chances, by a seeded hash."""
    chance = F.pmod(F.xxhash64(F.lit(seed + 3), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    copies = F.floor(F.max(F.col("taken") / F.col("size")) + F.first(chance)).cast("int")
    taken = mixing.mix(docs, seed=seed).filter(F.col("taken") > 0).groupBy("doc_id").agg(copies.alias("_copies"))
    taken = taken.filter(F.col("_copies") > 0).select(F.col("doc_id").alias("_id"), "_copies")
    met = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")))
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [("language", language), ("near_copies", near_copies), ("personal_data", personal_data), ("mixture", mixture),
                                   ("sequences", sequences)]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
