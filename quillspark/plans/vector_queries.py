"""TF-IDF tables, the vector table, and question answering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import answers as A
from ..operators import embed as E
from ..operators import nearest as N
from ..operators import vector_table as VT
from ..operators import vectorize as VZ
from ..operators import words as WD
from ..session import scratch_path, stored
from ..sources import tables
from . import sqltext as S
from .registry import query


def sql_term_counts(name: str, source: str, key: str, text: str, spec: VZ.VectorizerSpec) -> None:
    runs = " UNION ALL ".join(f"SELECT {key}, {term} AS term FROM g WHERE {term} IS NOT NULL" for term in [
        "t0", "t0 || ' ' || t1", "t0 || ' ' || t1 || ' ' || t2"][spec.low - 1:spec.high])
    S.add_table(name, (source,), f"""
WITH t AS (SELECT {key}, regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM {source}),
u AS (SELECT {key}, unnest(t) AS t0, generate_subscripts(t, 1) AS pos FROM t),
g AS MATERIALIZED (SELECT {key}, t0, lead(t0, 1) OVER w AS t1, lead(t0, 2) OVER w AS t2 FROM u WINDOW w AS (PARTITION BY {key} ORDER BY pos))
SELECT {key}, term, count(*) AS tf FROM ({runs}) GROUP BY {key}, term""")


def sql_vectorizer(name: str, source: str, key: str, text: str, spec: VZ.VectorizerSpec) -> None:
    """Add tables ``<name>_tc``, ``<name>_vocab`` and ``<name>_w`` for a vectoriser over ``source``."""
    sql_term_counts(f"{name}_tc", source, key, text, spec)
    S.add_table(f"{name}_vocab", (source, f"{name}_tc"), f"""
SELECT term, tf, df, n, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM (
  SELECT term, sum(tf) AS tf, count(*) AS df, (SELECT count(*) FROM {source}) AS n FROM {name}_tc GROUP BY term)
WHERE df >= {spec.min_df} AND df <= {spec.max_df} * n ORDER BY tf DESC, term LIMIT {spec.max_features}""")
    tf = "(1 + ln(c.tf))" if spec.sublinear else "c.tf"
    raw = "c.tf" if spec.kind == "count" else f"{tf} * v.idf"
    norm = "1" if spec.kind == "count" else f"sqrt(sum(w * w) OVER (PARTITION BY {key}))"
    S.add_table(f"{name}_w", (f"{name}_tc", f"{name}_vocab"), f"""
SELECT {key}, term, w / {norm} AS weight FROM (SELECT c.{key}, c.term, CAST({raw} AS DOUBLE) AS w
FROM {name}_tc c JOIN {name}_vocab v ON c.term = v.term)""")


S.add_table("chunk_ids", ("chunks",), "SELECT concat_ws('_', 'doc', row_id, chunk_idx) AS chunk_id, source, page, lang, chunk FROM chunks")
S.add_table("review_texts", ("review_tokens",), "SELECT row_id, array_to_string(tokens, ' ') AS clean_joined FROM review_tokens")
sql_vectorizer("books", "chunk_ids", "chunk_id", "chunk", VZ.BOOK_TFIDF)
sql_vectorizer("bookcount", "chunk_ids", "chunk_id", "chunk", VZ.BOOK_COUNT)
sql_vectorizer("revs", "review_texts", "row_id", "clean_joined", VZ.REVIEW_TFIDF)
sql_vectorizer("revcount", "review_texts", "row_id", "clean_joined", VZ.REVIEW_COUNT)


def chunks_of(spark, folder):
    return WD.chunk_table(tables.page_docs(spark, folder))


def review_texts(spark, folder):
    return WD.review_tokens(tables.reviews(spark, folder)).select(
        "row_id", F.array_join("tokens", " ").alias("clean_joined"))


def _weights(df, text, key, spec):
    df = stored(df.select(key, text), "texts")
    vocab = VZ.fit(df, text, spec)
    rows = VZ.long_rows(VZ.sparse_rows(df, text, vocab, key), vocab, key)
    return rows.select(key, "term", X.rounded(F.col("weight")).alias("weight"))


def _sql_weights(name, key):
    return S.with_tables(f"{name}_w", f"SELECT {key}, term, {S.r6('weight')} AS weight FROM {name}_w")


@query("tfidf_books", _sql_weights("books", "chunk_id"))
def tfidf_books(spark, folder):
    return _weights(chunks_of(spark, folder), "text", "chunk_id", VZ.BOOK_TFIDF)


@query("tfidf_reviews", _sql_weights("revs", "row_id"))
def tfidf_reviews(spark, folder):
    return _weights(review_texts(spark, folder), "clean_joined", "row_id", VZ.REVIEW_TFIDF)


@query("count_vectors", _sql_weights("revcount", "row_id"))
def count_vectors(spark, folder):
    return _weights(review_texts(spark, folder), "clean_joined", "row_id", VZ.REVIEW_COUNT)


@query("count_vectors_books", _sql_weights("bookcount", "chunk_id"))
def count_vectors_books(spark, folder):
    return _weights(chunks_of(spark, folder), "text", "chunk_id", VZ.BOOK_COUNT)


@query("feature_names", S.with_tables("books_vocab", "SELECT CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS term_idx, term FROM books_vocab"))
def feature_names(spark, folder):
    return VZ.feature_names(VZ.fit(chunks_of(spark, folder), "text", VZ.BOOK_TFIDF), spark)


S.add_table("signs", ("books_vocab",), "SELECT term, d, CASE WHEN substring(md5(concat(term, ':', d)), 1, 1) < '8' THEN 1.0 ELSE -1.0 END"
                                       f" AS s FROM books_vocab, (SELECT unnest(range(0, {E.DIMENSIONS})) AS d)")
S.add_table("hashed", ("books_w", "signs"), "SELECT w.chunk_id, s.d, sum(w.weight * s.s) AS x FROM books_w w JOIN signs s"
                                            " ON w.term = s.term GROUP BY w.chunk_id, s.d")


@query("embed_hashed", S.with_tables("hashed", f"""
SELECT chunk_id, CAST(d AS INT) AS dim, {S.r6('x / sqrt(sum(x * x) OVER (PARTITION BY chunk_id))')} AS x FROM hashed"""))
def embed_hashed(spark, folder):
    chunks = stored(chunks_of(spark, folder).select("chunk_id", "text"), "chunks")
    vocab = VZ.fit(chunks, "text", VZ.BOOK_TFIDF)
    rows = E.hashed_projection(VZ.sparse_rows(chunks, "text", vocab, "chunk_id"), vocab, "chunk_id")
    return rows.filter(F.exists("embedding", lambda v: v != 0)).select(
        "chunk_id", F.posexplode("embedding").alias("dim", "x")).withColumn("x", X.rounded(F.col("x")))


def _distance(metric: str) -> str:
    if metric == "l2":
        return "list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return "1 - list_cosine_similarity(q.embedding, v.embedding)"


def _sql_nearest(metric: str, test: str) -> str:
    return S.with_tables("vectors", f"""
SELECT q_id, id, CAST(rank AS INT) AS rank, {S.r6('distance')} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM (
    SELECT q.id AS q_id, v.id, round({_distance(metric)}, 9) AS distance FROM vectors q, vectors v WHERE {test}))
WHERE rank <= 5""")


def _search(spark, folder, metric, where=None, cells=True):
    rows = tables.vectors(spark, folder)
    asked = rows.select("id", F.col("embedding").alias("vector"))
    found = VT.search(rows, asked, 5, metric, where, cells)
    return found.select("q_id", F.col("item_id").alias("id"), "rank", X.rounded(F.col("distance")).alias("distance"))


@query("vec_topk_l2", _sql_nearest("l2", "true"))
def vec_topk_l2(spark, folder):
    return _search(spark, folder, "l2", cells=None)


@query("vec_topk_cosine", _sql_nearest("cosine", "true"))
def vec_topk_cosine(spark, folder):
    return _search(spark, folder, "cosine")


@query("vec_topk_where", _sql_nearest("l2", "(v.label IN (1, 4, 7) OR v.source >= 'src5') AND v.label <> 9"))
def vec_topk_where(spark, folder):
    rule = {"$or": [{"label": {"$in": [1, 4, 7]}}, {"metadata.source": {"$gte": "src5"}}], "label": {"$ne": 9}}
    return _search(spark, folder, "l2", rule)


_SHOW = "id, document, list_sum(embedding) AS total, label"


def _show(rows):
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select("id", "document", X.rounded(total).alias("total"), "label")


@query("vec_add", S.with_tables("vectors", f"SELECT id, document, {S.r6('list_sum(embedding)')} AS total, label FROM vectors UNION ALL"
                                f" SELECT concat('vec_', doc_id) AS id, text AS document, 1.0 AS total, -1 AS label"
                                " FROM documents WHERE concat('vec_', doc_id) NOT IN (SELECT id FROM vectors)"))
def vec_add(spark, folder):
    rows = tables.vectors(spark, folder).select("id", "document", "embedding", "label")
    new = tables.documents(spark, folder).select(
        F.concat(F.lit("vec_"), F.col("row_id")).alias("id"), F.col("text").alias("document"),
        F.array(F.lit(1.0)).cast("array<float>").alias("embedding"), F.lit(-1).alias("label"))
    return _show(VT.add(rows, new))


@query("vec_count", "SELECT count(*) AS n FROM embeddings")
def vec_count(spark, folder):
    return tables.vectors(spark, folder).agg(F.count(F.lit(1)).alias("n"))


@query("vec_get", S.with_tables("vectors", f"SELECT id, document, {S.r6('list_sum(embedding)')} AS total, label FROM vectors"))
def vec_get(spark, folder):
    return _show(tables.vectors(spark, folder))


@query("vec_delete", S.with_tables("vectors", f"SELECT id, document, {S.r6('list_sum(embedding)')} AS total, label FROM vectors"
                                   " WHERE vec_id NOT IN (SELECT doc_id FROM labels)"))
def vec_delete(spark, folder):
    ids = tables.table(spark, folder, "labels").select(F.concat(F.lit("vec_"), F.col("doc_id")).alias("id"))
    return _show(VT.delete(tables.vectors(spark, folder), ids))


@query("vec_update", S.with_tables(
    "vectors", f"SELECT v.id, coalesce('quality ' || l.quality, v.document) AS document,"
    f" {S.r6('list_sum(v.embedding)')} AS total, v.label FROM vectors v LEFT JOIN labels l ON v.vec_id = l.doc_id"))
def vec_update(spark, folder):
    changes = tables.table(spark, folder, "labels").select(
        F.concat(F.lit("vec_"), F.col("doc_id")).alias("id"), F.concat(F.lit("quality "), F.col("quality")).alias("document"))
    return _show(VT.update(tables.vectors(spark, folder), changes))


@query("vec_stored", S.with_tables("vectors", f"""
SELECT a.id, coalesce('quality ' || l.quality, a.document) AS document, {S.r6('a.total')} AS total, a.page FROM (
  SELECT id, vec_id, document, list_sum(embedding) AS total, label AS page FROM vectors UNION ALL
  SELECT concat('vec_', doc_id), doc_id, text, 1.0, -1 FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM vectors)) a
LEFT JOIN labels l ON a.vec_id = l.doc_id WHERE coalesce(l.toxic, 0) = 0"""))
def vec_stored(spark, folder):
    """A stored table after two additions, an update and a deletion, opened again."""
    path = scratch_path(spark, "vectors")
    labels = tables.table(spark, folder, "labels").select(F.concat(F.lit("vec_"), F.col("doc_id")).alias("id"), "quality", "toxic")
    meta = lambda source, page: F.struct(source.alias("source"), page.cast("int").alias("page"), F.lit(None).cast("string").alias("original_text")).alias("metadata")
    rows = tables.vectors(spark, folder).select("id", "document", "embedding", meta(F.col("metadata.source"), F.col("label")))
    new = tables.documents(spark, folder).select(F.concat(F.lit("vec_"), F.col("row_id")).alias("id"), F.col("text").alias("document"),
                                                 F.array(F.lit(1.0)).cast("array<float>").alias("embedding"), meta(F.col("source"), F.lit(-1)))
    VT.VectorTable(spark, path).add(rows)
    VT.VectorTable(spark, path).add(new)
    VT.VectorTable(spark, path).update(labels.select("id", F.concat(F.lit("quality "), F.col("quality")).alias("document")))
    VT.VectorTable(spark, path).delete(labels.filter("toxic = 1").select("id"))
    return _show(VT.VectorTable(spark, path).rows().withColumn("label", F.col("metadata.page"))).withColumnRenamed("label", "page")


S.add_table("asked", ("questions",), f"SELECT q_id, query, array_to_string(" + S.keep(
    f"regexp_extract_all({S.clean_book('query')}, {S.lit(A.V.BOOK_TOKEN)})",
    f"length(t) BETWEEN 3 AND 20 AND NOT list_contains({S.BOOK_STOP}, t)") + ", ' ') AS terms FROM questions")
sql_term_counts("asked_tc", "asked", "q_id", "terms", VZ.BOOK_TFIDF)
S.add_table("asked_w", ("asked_tc", "books_vocab"), """
SELECT q_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY q_id)) AS weight FROM (SELECT c.q_id, c.term, (1 + ln(c.tf)) * v.idf AS w
FROM asked_tc c JOIN books_vocab v ON c.term = v.term)""")
S.add_table("scored", ("asked_w", "books_w"), "SELECT a.q_id, b.chunk_id, sum(a.weight * b.weight) AS score FROM asked_w a"
                                              " JOIN books_w b ON a.term = b.term GROUP BY a.q_id, b.chunk_id")
S.add_table("hits", ("asked", "chunk_ids", "scored"), """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, chunk_id) AS rank FROM (
  SELECT a.q_id, c.chunk_id, round(1 - coalesce(s.score, 0), 9) AS distance FROM asked a CROSS JOIN chunk_ids c
  LEFT JOIN scored s ON s.q_id = a.q_id AND s.chunk_id = c.chunk_id)) WHERE rank <= 5""")
S.add_table("answers", ("hits", "chunk_ids", "questions"), """
SELECT q.q_id, h.n_hits, h.best_score, concat('Based on the provided books, here''s information related to your query ''', q.query,
  ''':', chr(10), chr(10), h.body) AS answer
FROM questions q JOIN (SELECT h.q_id, count(*) AS n_hits, max(1 - h.distance) AS best_score,
  string_agg(concat('From ', c.source, ', page ', c.page, ':', chr(10), substring(c.chunk, 1, 300), '...', chr(10), chr(10)), ''
             ORDER BY h.rank) AS body FROM hits h JOIN chunk_ids c ON h.chunk_id = c.chunk_id GROUP BY h.q_id) h ON q.q_id = h.q_id""")


@query("answer_questions", S.with_tables("answers", f"SELECT q_id, CAST(n_hits AS INT) AS n_hits, {S.r6('best_score')} AS best_score,"
                                         " answer FROM answers"))
def answer_questions(spark, folder):
    found = A.answer(chunks_of(spark, folder), tables.questions(spark, folder))
    return found.withColumn("best_score", X.rounded(F.col("best_score")))


@query("answerable_gate", S.with_tables(
    "answers", f"SELECT q_id, CAST(round(best_score, 6) >= 0.35 AS INT) AS answerable, CASE WHEN round(best_score, 6) >= 0.35 THEN answer"
    f" ELSE {S.lit(A.V.REFUSAL)} END AS answer FROM answers"))
def answerable_gate(spark, folder):
    found = answer_questions(spark, folder)
    return A.gate(found, 0.35).select("q_id", "answerable", "answer")
