"""Splits, metrics, scaling, selection and projection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import classify as C
from ..operators import features as FT
from ..operators import metrics as M
from ..operators import split as SP
from ..operators import vectorize as VZ
from ..operators import words as WD
from ..session import stored
from ..sources import tables
from . import sqltext as S
from .registry import query
from .vector_queries import chunks_of

r6 = S.r6


def points(spark, folder):
    return tables.table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))


def hash_sql(key: str) -> str:
    return f"md5(concat('42:', {key}))"


S.add_table("points", (), "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings")
S.add_table("points_long", ("points",), "SELECT vec_id, label, unnest(v) AS x, CAST(generate_subscripts(v, 1) - 1 AS INT) AS feature FROM points")
S.add_table("ranked_docs", (), f"SELECT doc_id AS row_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {hash_sql('doc_id')}, doc_id)"
                               " AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents")
S.add_table("split_points", ("points",), f"SELECT *, CAST(substring({hash_sql('vec_id')}, 1, 8) < '{SP.hex_below(0.2)}' AS INT) AS is_test FROM points")
S.add_table("fold_points", ("points",), f"SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {hash_sql('vec_id')}, vec_id) - 1) % 5"
                                        " AS INT) AS fold FROM points")


def knn_sql(k: int, table: str, query_test: str, pair_test: str, columns: str = "") -> str:
    """Majority label of the ``k`` nearest rows, ties to the smaller label."""
    dist = "list_sum(list_transform(list_zip(q.v, t.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    return f"""SELECT vec_id, y, p{columns} FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, p) AS place FROM (
SELECT vec_id, y, p{columns}, count(*) AS votes FROM (SELECT q.vec_id, q.label AS y, t.label AS p{columns.replace(', ', ', q.')},
row_number() OVER (PARTITION BY q.vec_id ORDER BY round({dist}, 9), t.vec_id) AS r FROM {table} q, {table} t
WHERE {query_test} AND {pair_test}) WHERE r <= {k} GROUP BY vec_id, y, p{columns})) WHERE place = 1"""


for _k in (1, 3, 5):
    S.add_table(f"knn{_k}", ("split_points",), knn_sql(_k, "split_points", "q.is_test = 1", "t.is_test = 0"))
    S.add_table(f"knn{_k}_cv", ("fold_points",), knn_sql(_k, "fold_points", "true", "q.fold <> t.fold", ", fold"))
S.add_table("board_rows", ("knn1", "knn3", "knn5"), " UNION ALL ".join(
    f"SELECT 'knn{k}' AS model, y, p, 0 AS fold FROM knn{k}" for k in (1, 3, 5)))
S.add_table("board_cv_rows", ("knn1_cv", "knn3_cv", "knn5_cv"), " UNION ALL ".join(
    f"SELECT 'knn{k}' AS model, y, p, fold FROM knn{k}_cv" for k in (1, 3, 5)))


def score_sql(name: str, rows: str) -> None:
    S.add_table(name, (rows,), f"""
WITH l AS (SELECT model, fold, y AS label, 1 AS s, 0 AS c, CAST(y = p AS INT) AS h FROM {rows} UNION ALL
  SELECT model, fold, p, 0, 1, 0 FROM {rows}),
t AS (SELECT model, fold, label, sum(s) AS s, sum(c) AS c, sum(h) AS h FROM l GROUP BY 1, 2, 3)
SELECT model, fold, sum(h) / sum(s) AS accuracy, sum(2.0 * h / (s + c) * s) / sum(s) AS f1 FROM t GROUP BY 1, 2""")


score_sql("board_scores", "board_rows")
score_sql("board_cv", "board_cv_rows")
S.add_table("board", ("board_scores", "board_cv"), "SELECT b.model, b.accuracy, b.f1, c.cv_mean, c.cv_std FROM board_scores b JOIN"
            " (SELECT model, avg(f1) AS cv_mean, stddev_pop(f1) AS cv_std FROM board_cv GROUP BY model) c ON b.model = c.model")


def _sides(rows, test):
    flat = rows.select(F.col("vec_id").alias("id"), "label", "vector", test.alias("is_test"))
    return flat.filter(~F.col("is_test")), flat.filter("is_test")


def knn_split(spark, folder, ks=(3,), cells=None):
    train, test = _sides(SP.at_random(points(spark, folder), "vec_id"), F.col("is_test") == 1)
    return C.knn(train, test, ks, cells).withColumnRenamed("id", "vec_id")


def knn_folds(spark, folder, ks=(3,)):
    rows = stored(SP.stratified_folds(points(spark, folder), "label", "vec_id"), "folds")
    parts = [C.knn(*_sides(rows, F.col("fold") == f), ks).withColumn("fold", F.lit(f)) for f in range(5)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query("split_stratified", S.with_tables("ranked_docs", "SELECT row_id, lang, CAST(r <= round(0.2 * n) AS INT) AS is_test FROM ranked_docs"))
def split_stratified(spark, folder):
    rows = tables.table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    return SP.stratified(rows, "lang", "row_id")


@query("split_random", S.with_tables("split_points", "SELECT vec_id, is_test FROM split_points"))
def split_random(spark, folder):
    return SP.at_random(points(spark, folder), "vec_id").select("vec_id", "is_test")


@query("kfold_assign", S.with_tables(
    "ranked_docs", "SELECT row_id, lang, CAST((r - 1) % 5 AS INT) AS fold, "
    f"CAST(substring({hash_sql('row_id')}, 1, 8) >= '{SP.hex_below(1 / 3)}' AS INT) + "
    f"CAST(substring({hash_sql('row_id')}, 1, 8) >= '{SP.hex_below(2 / 3)}' AS INT) AS plain_fold FROM ranked_docs"))
def kfold_assign(spark, folder):
    rows = tables.table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    plain = SP.random_folds(rows, "row_id").withColumnRenamed("fold", "plain_fold")
    return SP.stratified_folds(plain, "lang", "row_id")


@query("class_weights", f"SELECT lang, count(*) AS n, {r6('sum(count(*)) OVER () / (count(*) OVER () * count(*))')} AS weight"
                        " FROM documents GROUP BY lang")
def class_weights(spark, folder):
    w = SP.class_weights(tables.table(spark, folder, "documents").select("lang"), "lang")
    return w.withColumn("weight", X.rounded(F.col("weight")))


@query("label_encode", "SELECT source, CAST(row_number() OVER (ORDER BY source) - 1 AS INT) AS label_idx FROM (SELECT DISTINCT source FROM documents)")
def label_encode(spark, folder):
    return SP.encode_labels(tables.table(spark, folder, "documents"), "source")


@query("knn_classify", S.with_tables("knn3", "SELECT vec_id, y, p FROM knn3"))
def knn_classify(spark, folder):
    return knn_split(spark, folder, cells=True).drop("k")


@query("cv_scores", S.with_tables("board_cv", f"SELECT {r6('avg(f1)')} AS cv_mean, {r6('stddev_pop(f1)')} AS cv_std FROM board_cv WHERE model = 'knn3'"))
def cv_scores(spark, folder):
    s = M.fold_summary(M.scores(knn_folds(spark, folder), "y", "p", "fold"))
    return s.select(*[X.rounded(F.col(c)).alias(c) for c in s.columns])


def _board(spark, folder):
    ks, model = (1, 3, 5), F.concat(F.lit("knn"), F.col("k")).alias("model")
    held_out = knn_split(spark, folder, ks).select("y", "p", model)
    folds = knn_folds(spark, folder, ks).select("y", "p", model, "fold")
    board = M.leaderboard(held_out, M.scores(folds, "y", "p", "model", "fold"))
    return board.select("model", *[X.rounded(F.col(c)).alias(c) for c in ("accuracy", "f1", "cv_mean", "cv_std")])


_BOARD = f"SELECT model, {r6('accuracy')} AS accuracy, {r6('f1')} AS f1, {r6('cv_mean')} AS cv_mean, {r6('cv_std')} AS cv_std FROM board"


@query("model_leaderboard", S.with_tables("board", _BOARD))
def model_leaderboard(spark, folder):
    return _board(spark, folder)


@query("best_model", S.with_tables("board", f"SELECT * FROM ({_BOARD}) ORDER BY f1 DESC, model LIMIT 1"))
def best_model(spark, folder):
    return M.best_model(_board(spark, folder), "model")


S.add_table("flags", ("labels_view",), "SELECT quality AS y, 1 - toxic AS p FROM labels_view")
S.add_table("labels_view", (), "SELECT * FROM labels")


@query("binary_metrics", S.with_tables("flags", f"""
SELECT {r6('avg(CAST(y = p AS INT))')} AS accuracy, {r6('sum(y * p) / sum(p)')} AS "precision", {r6('sum(y * p) / sum(y)')} AS recall,
{r6('2.0 * sum(y * p) / (sum(y) + sum(p))')} AS f1 FROM flags"""))
def binary_metrics(spark, folder):
    rows = tables.table(spark, folder, "labels").select(F.col("quality").alias("y"), (1 - F.col("toxic")).alias("p"))
    m = M.binary(rows, "y", "p")
    return m.select(*[X.rounded(F.col(c)).alias(c) for c in m.columns])


S.add_table("class_rows", ("knn3",), """
SELECT label, CASE WHEN c = 0 THEN 0 ELSE h / c END AS pr, CASE WHEN s = 0 THEN 0 ELSE h / s END AS re, 2.0 * h / (s + c) AS f1, s, h FROM (
SELECT label, sum(s) AS s, sum(c) AS c, sum(h) AS h FROM (SELECT y AS label, 1 AS s, 0 AS c, CAST(y = p AS INT) AS h FROM knn3
  UNION ALL SELECT p, 0, 1, 0 FROM knn3) GROUP BY label)""")


@query("classification_report", S.with_tables("class_rows", " UNION ALL ".join([
    f'SELECT CAST(label AS VARCHAR) AS label, {r6("pr")} AS "precision", {r6("re")} AS recall, {r6("f1")} AS f1, CAST(s AS BIGINT) AS support FROM class_rows',
    *[f"SELECT '{name}', {r6(a)}, {r6(b)}, {r6(c)}, CAST(sum(s) AS BIGINT) FROM class_rows" for name, a, b, c in [
        ("accuracy", "sum(h) / sum(s)", "sum(h) / sum(s)", "sum(h) / sum(s)"), ("macro avg", "avg(pr)", "avg(re)", "avg(f1)"),
        ("weighted avg", "sum(pr * s) / sum(s)", "sum(re * s) / sum(s)", "sum(f1 * s) / sum(s)")]]])))
def classification_report(spark, folder):
    t = M.report(knn_split(spark, folder), "y", "p")
    return t.select("label", *[X.rounded(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("confusion_matrix", S.with_tables("knn3", """
SELECT a.label AS y, b.label AS p, (SELECT count(*) FROM knn3 k WHERE k.y = a.label AND k.p = b.label) AS n
FROM (SELECT y AS label FROM knn3 UNION SELECT p FROM knn3) a, (SELECT y AS label FROM knn3 UNION SELECT p FROM knn3) b"""))
def confusion_matrix(spark, folder):
    return M.confusion(knn_split(spark, folder), "y", "p")


S.add_table("line", ("rated",), "SELECT regr_slope(overall, review_len) AS a, regr_intercept(overall, review_len) AS b FROM rated")
S.add_table("line_rows", ("rated", "line"), "SELECT row_id, overall AS y, a * review_len + b AS p FROM rated, line")


def line_fit(spark, folder):
    rows = WD.rated_reviews(tables.reviews(spark, folder), lemmas=False).select("row_id", "overall", "review_len")
    line = rows.agg(F.regr_slope("overall", "review_len").alias("a"), F.regr_intercept("overall", "review_len").alias("b")).head()
    return rows.select("row_id", F.col("overall").alias("y"), (line["a"] * F.col("review_len") + line["b"]).alias("p"))


@query("linreg_simple", S.with_tables("line_rows", f"SELECT row_id, y, {r6('p')} AS p FROM line_rows"))
def linreg_simple(spark, folder):
    return line_fit(spark, folder).withColumn("p", X.rounded(F.col("p")))


@query("regression_metrics", S.with_tables("line_rows", f"""
SELECT {r6('avg(abs(y - p))')} AS mae, {r6('avg((y - p) * (y - p))')} AS mse, {r6('sqrt(avg((y - p) * (y - p)))')} AS rmse,
{r6('1 - avg((y - p) * (y - p)) / var_pop(y)')} AS r2 FROM line_rows"""))
def regression_metrics(spark, folder):
    m = M.regression(line_fit(spark, folder), "y", "p")
    return m.select(*[X.rounded(F.col(c)).alias(c) for c in m.columns])


S.add_table("f_parts", ("points_long",), "SELECT feature, label, sum(x) AS s, sum(x * x) AS q, count(*) AS n FROM points_long GROUP BY 1, 2")


@query("select_k_best", S.with_tables("f_parts", f"""
SELECT feature, {r6('f')} AS f, CAST(row_number() OVER (ORDER BY f DESC, feature) <= 10 AS INT) AS selected FROM (
SELECT feature, ((sum(s * s / n) - sum(s) * sum(s) / sum(n)) / (count(*) - 1)) / ((sum(q) - sum(s * s / n)) / (sum(n) - count(*))) AS f
FROM f_parts GROUP BY feature)"""))
def select_k_best(spark, folder):
    rows = points(spark, folder)
    chosen = FT.select_k_best(rows, "label", 10)
    return FT.f_scores(rows, "label").select("feature", X.rounded(F.col("f")).alias("f"), F.col("feature").isin(chosen).cast("int").alias("selected"))


def _long(rows):
    return X.each(rows, ["vec_id"], F.col("vector"), "x", place="feature").withColumn("x", X.rounded(F.col("x")))


@query("standard_scale", S.with_tables("points_long", f"SELECT vec_id, feature, {r6('(x - avg(x) OVER w) / stddev_pop(x) OVER w')} AS x"
                                       " FROM points_long WINDOW w AS (PARTITION BY feature)"))
def standard_scale(spark, folder):
    return _long(FT.standard_scale(points(spark, folder)))


@query("minmax_scale", S.with_tables("points_long", f"SELECT vec_id, feature, {r6('(x - min(x) OVER w) / (max(x) OVER w - min(x) OVER w)')} AS x"
                                     " FROM points_long WINDOW w AS (PARTITION BY feature)"))
def minmax_scale(spark, folder):
    return _long(FT.minmax_scale(points(spark, folder)))


_POLY = [(f"x{i}", f"v[{i + 1}]") for i in range(5)] + [(f"x{i}_x{j}", f"v[{i + 1}] * v[{j + 1}]") for i in range(5) for j in range(i, 5)]


@query("poly_features", S.with_tables("points", "SELECT vec_id, " + ", ".join(f"{r6(e)} AS {n}" for n, e in _POLY) + " FROM points"))
def poly_features(spark, folder):
    return points(spark, folder).select("vec_id", *[X.rounded(c).alias(n) for n, c in FT.poly_terms(F.col("vector"), 5)])


def _projected(spark, folder, centre):
    chunks = stored(chunks_of(spark, folder).select("chunk_id", "text"), "chunks")
    vocab = VZ.fit(chunks, "text", VZ.BOOK_TFIDF)
    rows = VZ.sparse_rows(chunks, "text", vocab, "chunk_id").withColumnRenamed("weight", "vector").persist()
    p = FT.fit_projection(rows, vocab.size, 50, centre)
    return _long(FT.project(rows, p).withColumnRenamed("chunk_id", "vec_id")).withColumnRenamed("vec_id", "chunk_id")


@query("pca_project")
def pca_project(spark, folder):
    return _projected(spark, folder, True)


@query("svd_project")
def svd_project(spark, folder):
    return _projected(spark, folder, False)


@query("explained_variance")
def explained_variance(spark, folder):
    rows = FT.standard_scale(points(spark, folder))
    return FT.explained_variance(rows, FT.fit_projection(rows, 64, 50))
