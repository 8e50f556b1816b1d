"""Scans, clean-up, tokens, chunks and small projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import text as X
from ..operators import words as WD
from ..session import scratch_path, stored
from ..sources import files, tables
from . import sqltext as S
from .registry import query


@query("csv_scan", S.with_tables("reviews", "SELECT row_id, reviewText, overall FROM reviews"))
def csv_scan(spark, folder):
    path = scratch_path(spark, "csv-scan")
    files.write_csv(tables.reviews(spark, folder), path)
    return files.read_csv(spark, path, files.REVIEW_SCHEMA)


@query("csv_sink_roundtrip", S.with_tables(
    "review_tokens", "SELECT row_id, overall, '[' || array_to_string(list_transform(tokens, lambda t: '\"' || t || '\"'), ',') || ']' AS tokens,"
    " array_to_string(tokens, ' ') AS clean_joined FROM review_tokens WHERE overall IS NOT NULL"))
def csv_sink_roundtrip(spark, folder):
    path = scratch_path(spark, "csv-sink")
    rows = WD.review_tokens(tables.reviews(spark, folder).na.drop(subset=["overall"])).select(
        "row_id", F.col("overall").cast("int").alias("overall"), "tokens", F.array_join("tokens", " ").alias("clean_joined"))
    files.write_csv(rows, path)
    back = files.read_csv(spark, path, "row_id LONG, overall INT, tokens STRING, clean_joined STRING")
    return back.withColumn("clean_joined", F.coalesce("clean_joined", F.lit("")))


@query("page_scan", "SELECT * FROM (SELECT page_id, regexp_extract(url, '[^/]+$', 0) AS source, "
                    f"{S.strip_markup('html')} AS text FROM pages) WHERE text <> ''")
def page_scan(spark, folder):
    return files.scan_pages(tables.spread(tables.table(spark, folder, "pages"), "page_id"))


@query("file_slug", "SELECT doc_id AS row_id, lower(translate(concat(upper(source), ': [', lang, '] notes'), ' :[]', '_'))"
                    " || '.pdf' AS slug FROM documents")
def file_slug(spark, folder):
    name = F.concat(F.upper("source"), F.lit(": ["), F.col("lang"), F.lit("] notes"))
    return tables.documents(spark, folder).select("row_id", X.file_slug(name).alias("slug"))


@query("ingest_incremental", "SELECT doc_id, source, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def ingest_incremental(spark, folder):
    incoming = tables.table(spark, folder, "documents").select("doc_id", "source", "lang")
    return files.not_ingested(incoming, tables.table(spark, folder, "labels"), "doc_id")


@query("quarantine_split", S.with_tables(
    "reviews", f"SELECT row_id, CASE WHEN overall IS NULL THEN 'no rating' WHEN {S.clean_page('reviewText')} = ''"
    " THEN 'no text' END AS reason FROM reviews"))
def quarantine_split(spark, folder):
    rows = tables.reviews(spark, folder)
    checks = [(F.col("overall").isNull(), "no rating"), (X.clean_page(F.col("reviewText")) == "", "no text")]
    return files.split_rejects(rows, checks).select("row_id", "reason")


@query("clean_page", S.with_tables(
    "marked", "page_docs", f"SELECT row_id, 1 AS is_marked, {S.clean_page('text')} AS text FROM marked UNION ALL"
    f" SELECT row_id, 0 AS is_marked, {S.clean_page('text')} AS text FROM page_docs"))
def clean_page(spark, folder):
    both = tables.marked_docs(spark, folder).select("row_id", F.lit(1).alias("is_marked"), "text").unionByName(
        tables.documents(spark, folder).select("row_id", F.lit(0).alias("is_marked"), "text"))
    return both.withColumn("text", X.clean_page(F.col("text")))


@query("clean_a", S.with_tables("marked", f"SELECT row_id, {S.clean_book('text')} AS clean FROM marked"))
def clean_a(spark, folder):
    return tables.marked_docs(spark, folder).select("row_id", X.clean_book(F.col("text")).alias("clean"))


@query("clean_b", S.with_tables(
    "marked", f"SELECT row_id AS row_id, {S.clean_review('text')} AS clean FROM marked UNION ALL"
    f" SELECT -1 - page_id AS row_id, {S.clean_review('html')} AS clean FROM pages"))
def clean_b(spark, folder):
    pages = tables.table(spark, folder, "pages").select((-1 - F.col("page_id")).alias("row_id"), F.col("html").alias("text"))
    rows = tables.marked_docs(spark, folder).select("row_id", "text").unionByName(pages)
    return rows.select("row_id", X.clean_review(F.col("text")).alias("clean"))


@query("drop_empty_pages", S.with_tables("kept_pages", "SELECT row_id, source, page, text FROM kept_pages"))
def drop_empty_pages(spark, folder):
    return WD.clean_pages(tables.page_docs(spark, folder)).select("row_id", "source", "page", "text")


@query("drop_null_reviews", S.with_tables(
    "reviews", "SELECT row_id, overall FROM reviews WHERE reviewText IS NOT NULL AND overall IS NOT NULL"))
def drop_null_reviews(spark, folder):
    return tables.reviews(spark, folder).na.drop(subset=["reviewText", "overall"]).select("row_id", "overall")


@query("cast_rating", S.with_tables(
    "reviews", "SELECT row_id, CAST(trunc(overall + 0.75) AS INT) AS overall FROM reviews WHERE overall IS NOT NULL"))
def cast_rating(spark, folder):
    rated = tables.reviews(spark, folder).filter(F.col("overall").isNotNull())
    return rated.select("row_id", (F.col("overall") + 0.75).cast("int").alias("overall"))


@query("min_length_filter", S.with_tables("review_tokens", "SELECT row_id, CAST(len(tokens) AS INT) AS review_len"
                                          " FROM review_tokens WHERE len(tokens) >= 3"))
def min_length_filter(spark, folder):
    rows = WD.review_tokens(tables.reviews(spark, folder)).select("row_id", F.size("tokens").alias("review_len"))
    return rows.filter(F.col("review_len") >= 3)


@query("sentiment_label", S.with_tables(
    "reviews", "SELECT row_id, CAST(overall >= 4 AS INT) AS sentiment FROM reviews WHERE overall IS NOT NULL"))
def sentiment_label(spark, folder):
    rows = tables.reviews(spark, folder).filter(F.col("overall").isNotNull())
    return rows.select("row_id", (F.col("overall") >= 4).cast("int").alias("sentiment"))


@query("source_label", "SELECT doc_id AS row_id, replace(concat(source, '.pdf'), '.pdf', '') AS label FROM documents")
def source_label(spark, folder):
    return tables.documents(spark, folder).select(
        "row_id", X.source_label(F.concat("source", F.lit(".pdf"))).alias("label"))


@query("review_len", S.with_tables("review_tokens", "SELECT row_id, array_to_string(tokens, ' ') AS clean_joined,"
                                   " CAST(len(tokens) AS INT) AS review_len FROM review_tokens"))
def review_len(spark, folder):
    rows = WD.review_tokens(tables.reviews(spark, folder))
    return rows.select("row_id", F.array_join("tokens", " ").alias("clean_joined"), F.size("tokens").alias("review_len"))


@query("tokenize_a", S.with_tables("book_tokens", "SELECT row_id, array_to_string(tokens, ' ') AS tokens FROM book_tokens"))
def tokenize_a(spark, folder):
    return WD.book_columns(tables.page_docs(spark, folder)).select("row_id", F.array_join("tokens", " ").alias("tokens"))


@query("tokenize_b", S.with_tables("review_clean", "SELECT row_id, array_to_string(list_filter(string_split(clean, ' '),"
                                   " lambda t: t <> ''), '|') AS tokens FROM review_clean"))
def tokenize_b(spark, folder):
    rows = tables.reviews(spark, folder).withColumn("clean", X.clean_review(F.col("reviewText")))
    return rows.select("row_id", F.array_join(X.review_tokens(F.col("clean")), "|").alias("tokens"))


@query("stopwords_a", S.with_tables("book_stopped", "SELECT row_id, array_to_string(stopped, ' ') AS tokens FROM book_stopped"))
def stopwords_a(spark, folder):
    return WD.book_columns(tables.page_docs(spark, folder)).select(
        "row_id", F.array_join("filtered_tokens", " ").alias("tokens"))


@query("stopwords_b", S.with_tables("review_tokens", "SELECT row_id, array_to_string(tokens, ' ') AS tokens FROM review_tokens"))
def stopwords_b(spark, folder):
    return WD.review_tokens(tables.reviews(spark, folder)).select("row_id", F.array_join("tokens", " ").alias("tokens"))


@query("length_filter", S.with_tables("book_sized", "SELECT row_id, array_to_string(sized, ' ') AS tokens FROM book_sized"))
def length_filter(spark, folder):
    return WD.book_columns(tables.page_docs(spark, folder)).select(
        "row_id", F.array_join("length_filtered_tokens", " ").alias("tokens"))


@query("rare_words", S.with_tables("repeated", "SELECT row_id, repeated AS tokens FROM repeated"))
def rare_words(spark, folder):
    return WD.book_columns(tables.page_docs(spark, folder)).select(
        "row_id", F.array_join("rare_filtered_tokens", " ").alias("tokens"))


@query("preprocess_record", S.with_tables(
    "cleaned", "book_sized", "repeated",
    "SELECT c.row_id, c.text AS original_text, c.clean AS cleaned_text, array_to_string(b.tokens, ' ') AS tokens,"
    " array_to_string(b.stopped, ' ') AS filtered_tokens, array_to_string(b.sized, ' ') AS length_filtered_tokens,"
    " r.repeated AS rare_filtered_tokens, r.repeated AS final_tokens"
    " FROM cleaned c JOIN book_sized b ON c.row_id = b.row_id JOIN repeated r ON c.row_id = r.row_id"))
def preprocess_record(spark, folder):
    record = WD.preprocess(tables.page_docs(spark, folder), use_stemming=False)
    lists = ["tokens", "filtered_tokens", "length_filtered_tokens", "rare_filtered_tokens", "final_tokens"]
    return record.select("row_id", "original_text", "cleaned_text", *[F.array_join(c, " ").alias(c) for c in lists])


@query("chunk_words", S.with_tables("small_chunks", "SELECT row_id, chunk_idx, chunk FROM small_chunks"))
def chunk_words(spark, folder):
    cleaned = tables.documents(spark, folder).select("row_id", X.clean_book(F.col("text")).alias("clean"))
    return X.with_chunks(cleaned, "clean", S.SMALL_SIZE, S.SMALL_OVERLAP).select("row_id", "chunk_idx", "chunk")


@query("chunk_table", S.with_tables(
    "chunks", "SELECT concat_ws('_', 'doc', row_id, chunk_idx) AS chunk_id, source, page, chunk_idx, chunk AS text,"
    " original_text, replace(source, '.pdf', '') AS label FROM chunks"))
def chunk_table(spark, folder):
    return WD.chunk_table(tables.page_docs(spark, folder)).select(
        "chunk_id", "source", "page", "chunk_idx", "text", "original_text", "label")


@query("ngrams", S.with_tables(
    "book_tokens", f"SELECT row_id, CAST(len(g) AS INT) AS n_grams, array_to_string(g, '|') AS grams FROM"
    f" (SELECT row_id, {S.ngrams('tokens', 1, 3)} AS g FROM book_tokens)"))
def ngrams(spark, folder):
    rows = X.with_ngrams(WD.book_columns(tables.page_docs(spark, folder)), "tokens", "g", 1, 3)
    return rows.select("row_id", F.size("g").alias("n_grams"), F.array_join("g", "|").alias("grams"))


@query("transactions", S.with_tables(
    "review_tokens", "SELECT DISTINCT row_id, unnest(tokens) AS item FROM review_tokens"))
def transactions(spark, folder):
    rows = WD.review_tokens(tables.reviews(spark, folder))
    return X.each(rows, ["row_id"], X.distinct_items(F.col("tokens")), "item")


@query("prompt_table", S.with_tables("questions", f"SELECT q_id, replace({S.lit(V.PROMPT)}, '{{query}}', query) AS prompt FROM questions"))
def prompt_table(spark, folder):
    return tables.questions(spark, folder).select("q_id", X.render_prompt(F.col("query")).alias("prompt"))


@query("head_rows", S.with_tables("reviews", "SELECT row_id, reviewText, overall FROM reviews WHERE overall IS NOT NULL"
                                  " ORDER BY row_id LIMIT 3"))
def head_rows(spark, folder):
    rows = tables.reviews(spark, folder).na.drop(subset=["reviewText", "overall"])
    return rows.orderBy("row_id").limit(3)


@query("stem_vocab")
def stem_vocab(spark, folder):
    rows = WD.book_columns(tables.page_docs(spark, folder))
    return WD.stem_table(X.each(rows, [], F.col("length_filtered_tokens"), "word"))


def sql_lemmas(name: str, words: str) -> None:
    """Add table ``name`` with the lemma of each word of the table ``words`` that has another one."""
    S.add_table(name, (words,), f"""
SELECT w.word, c.guess AS lemma FROM (SELECT word, unnest([
  CASE WHEN word LIKE '%ses' THEN word[1:len(word)-2] END, CASE WHEN word LIKE '%ves' THEN word[1:len(word)-3] || 'f' END,
  CASE WHEN word LIKE '%xes' THEN word[1:len(word)-2] END, CASE WHEN word LIKE '%zes' THEN word[1:len(word)-2] END,
  CASE WHEN word LIKE '%ches' THEN word[1:len(word)-2] END, CASE WHEN word LIKE '%shes' THEN word[1:len(word)-2] END,
  CASE WHEN word LIKE '%men' THEN word[1:len(word)-3] || 'man' END, CASE WHEN word LIKE '%ies' THEN word[1:len(word)-3] || 'y' END,
  CASE WHEN word LIKE '%s' THEN word[1:len(word)-1] END]) AS guess FROM {words}) c JOIN {words} w ON c.word = w.word
WHERE c.guess IN (SELECT word FROM {words}) AND w.word NOT LIKE '%ss'
QUALIFY row_number() OVER (PARTITION BY w.word ORDER BY len(c.guess), c.guess) = 1""")


S.add_table("lemma_words", ("review_tokens",), "SELECT DISTINCT unnest(tokens) AS word FROM review_tokens")
sql_lemmas("lemmas", "lemma_words")
S.add_table("book_words", ("repeated",), "SELECT DISTINCT unnest(string_split(repeated, ' ')) AS word FROM repeated")
sql_lemmas("book_lemmas", "book_words")


def _sql_lemma_lists(tokens: str, lemmas: str) -> str:
    return (f"SELECT r.row_id, string_agg(coalesce(l.lemma, r.token), ' ' ORDER BY r.pos) AS tokens FROM (SELECT row_id, unnest(t) AS token,"
            f" generate_subscripts(t, 1) AS pos FROM ({tokens})) r LEFT JOIN {lemmas} l ON r.token = l.word GROUP BY r.row_id")


@query("review_lemmas", S.with_tables("review_tokens", "lemmas", _sql_lemma_lists("SELECT row_id, tokens AS t FROM review_tokens", "lemmas")))
def review_lemmas(spark, folder):
    rows = WD.review_tokens(tables.reviews(spark, folder), lemmas=True)
    return rows.filter(F.size("tokens") > 0).select("row_id", F.array_join("tokens", " ").alias("tokens"))


@query("page_lemmas", S.with_tables("repeated", "book_lemmas", _sql_lemma_lists("SELECT row_id, string_split(repeated, ' ') AS t FROM repeated", "book_lemmas")))
def page_lemmas(spark, folder):
    record = WD.preprocess(tables.page_docs(spark, folder), use_stemming=False, use_lemmatization=True, keep=["row_id"])
    return record.select("row_id", F.array_join("final_tokens", " ").alias("tokens"))


@query("lemma_join", S.with_tables(
    "review_tokens", "lemmas", "SELECT t.row_id, CAST(t.pos - 1 AS INT) AS pos, coalesce(l.lemma, t.token) AS lemma FROM (SELECT row_id,"
    " unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM review_tokens) t LEFT JOIN lemmas l ON t.token = l.word"))
def lemma_join(spark, folder):
    reviews = stored(WD.review_tokens(tables.reviews(spark, folder)).select("row_id", "tokens"), "review-tokens")
    tokens = X.each(reviews, ["row_id"], F.col("tokens"), "word", place="pos")
    lemmas = WD.lemma_table(WD.distinct_words(reviews, "tokens"))
    return WD.look_up(tokens, lemmas, "word", "lemma").select("row_id", "pos", "lemma")
