"""The supplied tables, and the page, review, vector and question views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import rank_in_groups
from ..session import small_side

PAGE_BUCKET = 1 << 14


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rehash an input that has fewer splits than there are cores; larger inputs are left as they are read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"), "doc_id")


def page_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Page records: a source's documents in order of ``doc_id`` are its pages, null ids last.

    Only ids are numbered. A row is known by its file and its place there, so null and repeated ids keep their rows. Up to ``BROADCAST_ROWS`` numbers go
    to the texts by broadcast; beyond that each text is shuffled once, which a collection avoids by storing the page when it is ingested.
    """
    docs = table(spark, folder, "documents").withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    bucket = F.coalesce(F.floor(F.col("doc_id") / PAGE_BUCKET), F.lit((1 << 63) - 1))
    ids = docs.select("_file", "_row", "doc_id", "source")
    pages = rank_in_groups(ids, ["source"], [F.asc_nulls_last("doc_id"), "_file", "_row"], bucket, "page").select("_file", "_row", F.col("page").cast("int").alias("page"))
    met = spread(docs, "doc_id").join(small_side(pages), ["_file", "_row"])
    return met.select(F.col("doc_id").alias("row_id"), "source", "page", "lang", "text")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder).select(
        F.col("doc_id").alias("row_id"), "source", "lang", "text")


def marked_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents wrapped in the marks that the clean-up steps look for."""
    n = F.col("doc_id").cast("string")
    marked = F.concat(
        F.lit("Chapter "), n, F.lit(" Intro\n "), n, F.lit(" \n"), F.col("text"),
        F.lit(" Page 3 of 12 see https://example.com/a?b=1 or www.example.org"), F.lit(" "),
        F.lit("mail me@example.com <b>end</b> 2024"))
    return texts(spark, folder).select(F.col("doc_id").alias("row_id"), "source", marked.alias("text"))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Rated texts; the rating is null where no label exists."""
    docs = texts(spark, folder).select("doc_id", "text")
    rating = (1 + 2 * F.col("quality") + 2 * (1 - F.col("toxic"))).cast("double")
    return docs.join(table(spark, folder, "labels"), "doc_id", "left").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("reviewText"), rating.alias("overall"))


def review_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``reviews`` without the rating. Texts are not moved to their labels: labels are counted, and only ids with several go to the texts."""
    several = table(spark, folder, "labels").groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("_n")).filter(F.col("_n") > 1)
    met = texts(spark, folder).select("doc_id", "text").join(small_side(several), "doc_id", "left")
    each = F.explode(F.array_repeat(F.lit(0), F.coalesce("_n", F.lit(1))))
    return met.select(F.col("doc_id").alias("row_id"), F.col("text").alias("reviewText"), each.alias("_copy")).drop("_copy")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("vec_id"), "text", "source")
    return table(spark, folder, "embeddings").join(docs, "vec_id", "left").select(
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("id"), "vec_id",
        F.coalesce("text", F.lit("")).alias("document"), "embedding", "label",
        F.struct(F.coalesce("source", F.lit("")).alias("source"), F.col("label").alias("page")).alias("metadata"))


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").filter(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("q_id"), F.col("text").alias("query"))
