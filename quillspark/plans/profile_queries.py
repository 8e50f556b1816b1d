"""Counts, statistics and frequency tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text as X
from ..operators import profile as P
from ..operators import words as WD
from ..sources import tables
from . import sqltext as S
from .registry import query


def cleaned(spark, folder):
    return tables.documents(spark, folder).select("row_id", X.clean_book(F.col("text")).alias("clean"))


def tokens_of(spark, folder):
    return WD.review_tokens(tables.reviews(spark, folder)).select(
        "row_id", F.array_join("tokens", " ").alias("clean_joined"), F.size("tokens").alias("review_len"))


_SENTENCES = f"CAST(len(list_filter(regexp_split_to_array(clean, {S.lit(V.SENTENCE_END)}), lambda s: trim(s) <> '')) AS INT)"
S.add_table("sentences", ("cleaned",), f"SELECT row_id, {_SENTENCES} AS n_sentences FROM cleaned")
S.add_table("measured", ("cleaned",), f"SELECT len({S.words('clean')}) AS word_count, length(clean) AS char_count,"
                                      f" {_SENTENCES} AS sentence_count FROM cleaned")
S.add_table("word_freq", ("book_words",), "SELECT word, count(*) AS n FROM book_words GROUP BY word")
S.add_table("cloud", ("review_tokens",), "SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM review_tokens) GROUP BY word")


@query("text_stats", S.with_tables("measured", " UNION ALL ".join(
    f"SELECT '{metric}' AS metric, {S.r6(f'avg({c})')} AS mean, {S.r6(f'median({c})')} AS median,"
    f" CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\", {S.r6(f'stddev_pop({c})')} AS std FROM measured"
    for metric, c in (("word_count", "word_count"), ("char_count", "char_count"),
                      ("sentence_count", "sentence_count"), ("doc_length", "char_count")))))
def text_stats(spark, folder):
    stats = P.text_stats(cleaned(spark, folder), "clean")
    return stats.select("metric", *[X.rounded(F.col(c)).alias(c) for c in ("mean", "median", "min", "max", "std")])


@query("word_freq", S.with_tables("word_freq", "SELECT word, n FROM word_freq"))
def word_freq(spark, folder):
    return P.word_frequency(cleaned(spark, folder), "clean")


@query("vocab_size", S.with_tables("book_words", "SELECT count(DISTINCT word) AS vocab_size FROM book_words"))
def vocab_size(spark, folder):
    return P.vocabulary_size(cleaned(spark, folder), "clean")


@query("top_words", S.with_tables("word_freq", "SELECT word, n FROM word_freq ORDER BY n DESC, word LIMIT 20"))
def top_words(spark, folder):
    return P.top_words(P.word_frequency(cleaned(spark, folder), "clean"))


@query("sentence_count", S.with_tables("sentences", "SELECT row_id, n_sentences FROM sentences"))
def sentence_count(spark, folder):
    return cleaned(spark, folder).select("row_id", X.sentence_count(F.col("clean")).alias("n_sentences"))


@query("rating_counts", S.with_tables("reviews", "SELECT CAST(overall AS INT) AS overall, count(*) AS n FROM reviews"
                                      " WHERE overall IS NOT NULL GROUP BY 1 ORDER BY 1"))
def rating_counts(spark, folder):
    rated = tables.reviews(spark, folder).na.drop(subset=["overall"]).select(F.col("overall").cast("int").alias("overall"))
    return P.value_counts(rated, "overall").orderBy("overall")


@query("cluster_sizes", "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY 1 ORDER BY n DESC, cluster")
def cluster_sizes(spark, folder):
    rows = tables.table(spark, folder, "embeddings").select(F.col("label").alias("cluster"))
    return P.value_counts(rows, "cluster").orderBy(F.desc("n"), "cluster")


@query("avg_review_len", S.with_tables("review_tokens", f"SELECT {S.r6('avg(len(tokens))')} AS mean_tokens FROM review_tokens"))
def avg_review_len(spark, folder):
    return tokens_of(spark, folder).agg(X.rounded(F.avg("review_len")).alias("mean_tokens"))


@query("length_histogram", S.with_tables(
    "measured", "SELECT CAST(low + ((word_count - low) // 50) * 50 AS INT) AS bin_start, count(*) AS n FROM measured,"
    " (SELECT min(word_count) AS low FROM measured) GROUP BY 1"))
def length_histogram(spark, folder):
    return P.length_histogram(cleaned(spark, folder), "clean")


@query("cloud_weights", S.with_tables("cloud", f"SELECT word, {S.r6('n / (SELECT max(n) FROM cloud)')} AS weight FROM cloud"))
def cloud_weights(spark, folder):
    weights = P.cloud_weights(P.word_frequency(tokens_of(spark, folder), "clean_joined"))
    return weights.select("word", X.rounded(F.col("weight")).alias("weight"))


@query("corpus_counts", S.with_tables(
    "chunks", "SELECT (SELECT count(*) FROM documents) AS n_rows, count(DISTINCT row_id) AS n_pages, count(*) AS n_chunks,"
    " count(DISTINCT source) AS n_sources FROM chunks"))
def corpus_counts(spark, folder):
    pages = tables.page_docs(spark, folder)
    per_page = WD.chunk_table(pages).groupBy("row_id", "source").agg(F.count(F.lit(1)).alias("n"))
    per_source = per_page.groupBy("source").agg(F.count(F.lit(1)).alias("pages"), F.sum("n").alias("chunks"))
    totals = per_source.agg(F.sum("pages").alias("n_pages"), F.sum("chunks").alias("n_chunks"),
                            F.count(F.lit(1)).alias("n_sources"))
    rows = tables.table(spark, folder, "documents").agg(F.count(F.lit(1))).scalar()
    return totals.withColumn("n_rows", rows)
