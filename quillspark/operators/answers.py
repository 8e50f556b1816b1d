"""Answering questions from chunks by retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..session import scratch_path
from .collection import Collection, question_terms

__all__ = ["answer", "gate", "question_terms"]


def answer(chunks: DataFrame, questions: DataFrame, k: int = V.TOP_K, legacy_query: bool = False) -> DataFrame:
    """Answers from a collection made for these chunks. Make a :class:`Collection` to ask more than once."""
    made = Collection.make(chunks.sparkSession, scratch_path(chunks.sparkSession, "collection"), chunks)
    return made.answer(questions, k, legacy_query)


def gate(best: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Mark questions whose best score reaches ``threshold``; the others get the refusal text."""
    ok = F.col("best_score") >= threshold
    return best.withColumn("answerable", ok.cast("int")).withColumn(
        "answer", F.when(ok, F.col("answer")).otherwise(F.lit(V.REFUSAL)))
