"""Token tables: page and review preprocessing, chunks, stems and lemmas."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions import fixed_values as V
from ..functions import porter
from ..functions import text as X
from ..session import BROADCAST_ROWS, fits, stored

SALTS = 32
KNOWN = 200_000

# fixed values: noun endings and what replaces them
NOUN_ENDINGS = [("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
                ("men", "man"), ("ies", "y"), ("s", "")]


def clean_pages(pages: DataFrame) -> DataFrame:
    """Pages after mark removal; those left empty are dropped."""
    return pages.withColumn("text", X.clean_page(F.col("text"))).filter(F.col("text") != "")


def book_columns(pages: DataFrame, min_freq: int = 2) -> DataFrame:
    """Add every intermediate column of page preprocessing; unread ones are pruned from the plan."""
    df = (pages.withColumn("cleaned_text", X.clean_book(F.col("text")))
          .withColumn("tokens", X.book_tokens(F.col("cleaned_text")))
          .withColumn("filtered_tokens", X.book_stopped(F.col("tokens")))
          .withColumn("length_filtered_tokens", X.keep_lengths(F.col("filtered_tokens"))))
    return X.keep_repeated(df, "length_filtered_tokens", "rare_filtered_tokens", min_freq)


def review_tokens(reviews: DataFrame, lemmas: bool = False) -> DataFrame:
    df = reviews.withColumn("clean", X.clean_review(F.col("reviewText")))
    df = df.withColumn("tokens", X.review_stopped(X.review_tokens(F.col("clean"))))
    return lemmatise(df, "tokens", "tokens") if lemmas else df


def rated_reviews(reviews: DataFrame, min_tokens: int = 3, lemmas: bool = True) -> DataFrame:
    """Reviews ready for modelling: no nulls, integer rating, sentiment, at least ``min_tokens`` tokens, lemmatised."""
    df = review_tokens(reviews.na.drop(subset=["reviewText", "overall"]), lemmas)
    return (df.withColumn("overall", F.col("overall").cast("int"))
            .withColumn("sentiment", (F.col("overall") >= 4).cast("int"))
            .withColumn("clean_joined", F.array_join("tokens", " "))
            .withColumn("review_len", F.size("tokens"))
            .filter(F.col("review_len") >= min_tokens))


def chunk_table(pages: DataFrame, size: int = V.CHUNK_WORDS, overlap: int = V.CHUNK_OVERLAP) -> DataFrame:
    """Clean pages cut into word windows, each with its source, page, original text and label.

    A page left empty gives no window, so it needs no filter of its own.
    """
    cleaned = pages.withColumn("original_text", X.clean_page(F.col("text"))).drop("text")
    cleaned = cleaned.withColumn("cleaned", X.clean_book(F.col("original_text")))
    cut = X.with_chunks(cleaned, "cleaned", size, overlap).drop("cleaned").withColumnRenamed("chunk", "text")
    return (cut.withColumn("chunk_id", F.concat_ws("_", F.lit("doc"), F.col("row_id"), F.col("chunk_idx")))
            .withColumn("label", X.source_label(F.col("source"))))


def _with_stems(words: pa.Array, known: dict[str, str]) -> pa.Array:
    """The stem of each word, made once per distinct word of the array; ``known`` keeps stems between arrays, up to ``KNOWN``."""
    coded = words.cast(pa.string()).dictionary_encode()
    stems = []
    for word in coded.dictionary.to_pylist():
        made = known.get(word)
        if made is None:
            made = porter.stem(word)
            if len(known) < KNOWN:
                known[word] = made
        stems.append(made)
    return pa.array(stems, pa.string()).take(coded.indices)


def _relisted(lists: pa.ListArray, values: pa.Array) -> pa.ListArray:
    """Lists with new ``values``, in the place of ``lists.flatten()``."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    ends = pc.cumulative_sum(pa.concat_arrays([pa.array([0], pa.int32()), sizes.cast(pa.int32())]))
    return pa.ListArray.from_arrays(ends, values, mask=lists.is_null() if lists.null_count else None)


@arrow_udf(T.StringType())
def _stem(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known: dict[str, str] = {}
    for words in batches:
        yield _with_stems(words, known)


@arrow_udf(T.ArrayType(T.StringType()))
def _stem_lists(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known: dict[str, str] = {}
    for lists in batches:
        yield _relisted(lists, _with_stems(lists.flatten(), known))


def _in_place(udf, tokens: str) -> Column:
    """``udf`` of an array column. Spark does not run a function in Python whose argument holds a lambda; naming the column twice keeps the projection
    that computes it from being merged into the call."""
    return F.when(F.col(tokens).isNotNull(), udf(F.col(tokens)))


def stem_tokens(tokens: str) -> Column:
    """Stems of an array of words, in its own row."""
    return _in_place(_stem_lists, tokens)


def stem_table(words: DataFrame) -> DataFrame:
    """One stem per distinct word."""
    return words.select("word").distinct().select("word", _stem("word").alias("stem"))


def _guesses(word: Column) -> Column:
    made = [F.when(word.endswith(old), F.concat(F.expr(f"left(word, length(word) - {len(old)})"), F.lit(new)))
            for old, new in NOUN_ENDINGS]
    return F.array_compact(F.array(*made))


def lemma_table(words: DataFrame) -> DataFrame:
    """Words whose singular, by the noun endings, is itself a word of the corpus. The distinct words and the answer are written, so the texts that
    ``words`` come from are read once."""
    known = stored(words.select("word").distinct(), "words")
    tried = known.filter(F.col("word").endswith("s") & ~F.col("word").endswith("ss") | F.col("word").endswith("men"))
    tried = tried.select("word", F.explode(_guesses(F.col("word"))).alias("lemma"))
    found = tried.join(known.select(F.col("word").alias("lemma")), "lemma", "left_semi")
    best = F.min(F.struct(F.length("lemma").alias("size"), F.col("lemma").alias("lemma")))
    return stored(found.groupBy("word").agg(best.alias("best")).select("word", F.col("best.lemma").alias("lemma")), "lemmas")


def look_up(tokens: DataFrame, mapping: DataFrame, key: str, value: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``value`` from ``mapping`` (one row per key), keeping the key itself where there is none.

    A mapping within ``rows`` is broadcast. A larger one is copied over salts, and the tokens of a frequent
    word are spread over them, so no task gets all of its occurrences.
    """
    mapping = mapping.filter(F.col(value) != F.col(key)).select(key, F.col(value).alias("_value"))
    if fits(mapping, rows):
        joined = tokens.join(F.broadcast(mapping), key, "left")
    else:
        salted = tokens.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in ("row_id", "pos") if c in tokens.columns]),
                                                   F.lit(SALTS)).cast("int"))
        copies = mapping.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies, [key, "_salt"], "left").drop("_salt")
    return joined.withColumn(value, F.coalesce("_value", key)).drop("_value")


def distinct_words(df: DataFrame, tokens: str) -> DataFrame:
    """``word``: the words of an array column, made distinct batch by batch before the shuffle."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0).flatten().unique().cast(pa.string()).drop_null()], names=["word"])

    return df.select(tokens).mapInArrow(words, "word string").distinct()


def lemmatise(df: DataFrame, tokens: str, out: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``out``: the tokens of an array column with plural nouns replaced by their singular, if that is a word of ``df``.

    The words with a singular are a small part of the vocabulary. Up to ``rows`` of them are sent to the tasks, and each row's tokens are replaced in place;
    beyond that tokens are joined and gathered by ``row_id``.
    """
    table = lemma_table(distinct_words(df, tokens))
    head = table.limit(rows + 1).toArrow()
    if head.num_rows > rows:
        return map_tokens(df, tokens, out, table)
    shared = df.sparkSession.sparkContext.broadcast((head.column("word").combine_chunks(), head.column("lemma").combine_chunks()))

    @arrow_udf(T.ArrayType(T.StringType()))
    def replaced(lists: pa.Array) -> pa.Array:
        words, lemmas = shared.value
        flat = lists.flatten().cast(pa.string())
        if not len(words):
            return _relisted(lists, flat)
        return _relisted(lists, pc.coalesce(lemmas.take(pc.index_in(flat, value_set=words)), flat))

    return df.withColumn(out, _in_place(replaced, tokens))


def map_tokens(df: DataFrame, tokens: str, out: str, table: DataFrame) -> DataFrame:
    """Replace each token of an array column by a table with a row per word, by a join. Rows need distinct ids ``row_id``."""
    longs = X.each(df, ["row_id"], F.col(tokens), "word", place="pos")
    value = next(c for c in table.columns if c != "word")
    mapped = look_up(longs, table, "word", value)
    lists = mapped.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("pos", value))).alias("_pairs"))
    lists = lists.select("row_id", F.transform("_pairs", lambda p: p[value]).alias(out))
    empty = F.array().cast("array<string>")
    return df.join(lists, "row_id", "left").withColumn(out, F.coalesce(out, empty))


def preprocess(pages: DataFrame, use_stemming: bool = True, use_lemmatization: bool = False,
               min_freq: int = 2, keep: Sequence[str] | None = None) -> DataFrame:
    """The full preprocessing record of each page; stems first when both switches are on. Lemmas need the words of all pages before those of a page: with
    ``keep``, the columns wanted besides ``final_tokens``, these are written once instead of made twice."""
    df = book_columns(pages, min_freq).withColumnRenamed("text", "original_text")
    df = df.withColumn("final_tokens", stem_tokens("rare_filtered_tokens") if use_stemming else F.col("rare_filtered_tokens"))
    if keep is not None:
        df = df.select(*keep, "final_tokens")
        df = stored(df, "record") if use_lemmatization else df
    return lemmatise(df, "final_tokens", "final_tokens") if use_lemmatization else df
