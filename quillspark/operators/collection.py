"""A stored collection of passages: vector table, inverted index and what an answer shows, written once and opened for every batch of questions."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text as X
from ..session import forget, scratch_path, stored
from . import embed, vectorize
from . import words as WD
from .inverted_index import InvertedIndex, _ranked
from .vector_table import VectorTable, one_per_id

PASSAGE = "id string, source string, page int, snippet string"


def question_terms(questions: DataFrame, legacy_query: bool = False) -> DataFrame:
    """The text of each question that is compared with the chunks.

    ``legacy_query`` keeps only words the question repeats and stems them, as a page would be treated.
    """
    rows = questions.select(F.col("q_id").alias("row_id"), F.col("query").alias("text"))
    if legacy_query:
        ready = WD.preprocess(rows, use_stemming=True)
    else:
        ready = WD.preprocess(rows, use_stemming=False, min_freq=1)
    return ready.select(F.col("row_id").alias("q_id"), F.array_join("final_tokens", " ").alias("terms"))


class Collection:
    """Passages with their vectors in a folder. The vocabulary is fitted when the collection is made; later passages and all questions are weighed by it.

    A search reads the index for the questions' terms; the passages shown are read from a narrow table. No batch of questions reads the texts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.table = VectorTable(spark, os.path.join(path, "table"))
        self.index = InvertedIndex(spark, os.path.join(path, "index"))

    @classmethod
    def make(cls, spark: SparkSession, path: str, chunks: DataFrame, spec: vectorize.VectorizerSpec = vectorize.BOOK_TFIDF) -> Collection:
        """A new collection of ``chunk_id, source, page, text`` and, if there, ``original_text``."""
        made, given = cls(spark, path), scratch_path(spark, "given")
        chunks.write.parquet(given)  # read several times, to fit and to add
        chunks = spark.read.schema(chunks.schema).parquet(given)
        made.index.save_vocabulary(vectorize.fit(chunks, "text", spec))
        made.add(chunks)
        forget(spark, given)
        return made

    def add(self, chunks: DataFrame) -> None:
        """Index the chunks whose id is new, and store them with their vectors. Of several chunks with one id the first by its other columns counts."""
        original = "original_text" if "original_text" in chunks.columns else "text"
        rows = one_per_id(chunks.select(F.col("chunk_id").cast("string").alias("id"), "source", "page", "text", F.col(original).alias("original_text")))
        if self.table.exists():
            rows = rows.join(self.table.rows().select("id"), "id", "left_anti")
        rows = stored(rows, "added")
        vocab = self.index.vocabulary()
        sparse = stored(vectorize.sparse_rows(rows, "text", vocab, "id"), "weights")
        vectors = embed.hashed_projection(sparse, vocab, "id")
        self.index.add(sparse, "id")
        rows.select("id", "source", F.col("page").cast("int").alias("page"), X.snippet(F.col("text")).alias("snippet")).write.mode("append").parquet(self._passages())
        self.table.add(rows.join(vectors, "id").select("id", F.col("text").alias("document"), F.col("embedding").cast("array<float>").alias("embedding"),
                                                       F.struct("source", F.col("page").cast("int").alias("page"), "original_text").alias("metadata")), unique=True)

    def delete(self, ids: DataFrame) -> None:
        self.index.delete(ids)
        self.table.delete(ids)

    def _passages(self) -> str:
        return os.path.join(self.path, "passages")

    def search(self, questions: DataFrame, k: int = V.TOP_K, legacy_query: bool = False, counter=None) -> DataFrame:
        """``(q_id, chunk_id, distance, rank)`` by cosine. Where fewer than ``k`` passages share a term, those with the smallest ids follow at distance 1."""
        vocab = self.index.vocabulary()
        asked = vectorize.sparse_rows(question_terms(questions, legacy_query), "terms", vocab, "q_id").persist()
        found = self.index.search(asked, k, counter=counter).select("q_id", "item_id", "distance").persist()
        first = [r["id"] for r in self.table.rows().select("id").orderBy("id").limit(2 * k).collect()]
        counts = found.groupBy("q_id").agg(F.collect_list("item_id").alias("have"))
        short = asked.select("q_id").join(counts, "q_id", "left").filter(F.coalesce(F.size("have"), F.lit(0)) < k)
        left = F.array_except(F.lit(first) if first else F.array().cast("array<string>"), F.coalesce("have", F.array().cast("array<string>")))
        more = short.select("q_id", F.explode(left).alias("item_id"), F.lit(1.0).alias("distance"))
        return _ranked(found.unionAll(more), k).withColumnRenamed("item_id", "chunk_id")

    def answer(self, questions: DataFrame, k: int = V.TOP_K, legacy_query: bool = False) -> DataFrame:
        """``(q_id, n_hits, best_score, answer)``: one text per question with the ``k`` best passages."""
        hits = stored(self.search(questions, k, legacy_query), "hits").withColumnRenamed("chunk_id", "id")
        placed = self.spark.read.schema(PASSAGE).parquet(self._passages()).join(hits, "id")
        part = F.format_string("From %s, page %d:\n%s\n\n", "source", "page", "snippet")
        found = placed.groupBy("q_id").agg(
            F.sort_array(F.collect_list(F.struct("rank", part.alias("part")))).alias("parts"),
            F.max(1.0 - F.col("distance")).alias("best_score"))
        head = F.replace(F.lit(V.ANSWER_HEAD), F.lit("{query}"), F.col("query"))
        body = F.array_join(F.transform("parts", lambda p: p["part"]), "")
        return questions.join(found, "q_id", "left").select(
            "q_id", F.coalesce(F.size("parts"), F.lit(0)).alias("n_hits"),
            F.coalesce("best_score", F.lit(0.0)).alias("best_score"),
            F.concat(head, F.coalesce(body, F.lit(""))).alias("answer"))
