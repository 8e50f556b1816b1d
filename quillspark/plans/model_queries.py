"""Learned models, clusters and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import classify as C
from ..operators import cluster as CL
from ..operators import features as FT
from ..operators import learners as L
from ..operators import rules as R
from ..operators import split as SP
from ..operators import vectorize as VZ
from ..operators import words as WD
from ..session import stored
from ..sources import tables
from . import sqltext as S
from .feature_queries import hash_sql, points
from .registry import query
from .vector_queries import chunks_of

r6 = S.r6


def labelled(spark, folder, binary=False):
    """Training and test sides of the vectors, as ``(id, label, features)``."""
    label = (F.col("label") >= 5).cast("double") if binary else F.col("label").cast("double")
    rows = SP.at_random(points(spark, folder), "vec_id").select(F.col("vec_id").alias("id"), label.alias("label"), "vector", "is_test")
    rows = L.to_vectors(rows).persist()
    return rows.filter("is_test = 0").drop("is_test"), rows.filter("is_test = 1").drop("is_test")


S.add_table("chunk_split", ("chunk_ids",), f"SELECT chunk_id, lang, CAST(substring({hash_sql('chunk_id')}, 1, 8) < '{SP.hex_below(0.2)}' AS INT)"
                                           " AS is_test FROM chunk_ids")
S.add_table("nb_n", ("chunk_split",), "SELECT lang, count(*) / sum(count(*)) OVER () AS prior FROM chunk_split WHERE is_test = 0 GROUP BY lang")
S.add_table("nb_s", ("books_w", "chunk_split"), "SELECT w.term, c.lang, sum(w.weight) AS s FROM books_w w JOIN chunk_split c"
                                               " ON w.chunk_id = c.chunk_id WHERE c.is_test = 0 GROUP BY 1, 2")
S.add_table("nb_p", ("books_vocab", "nb_n", "nb_s"), """
SELECT v.term, n.lang, ln((coalesce(s.s, 0) + 1) / (m.mass + (SELECT count(*) FROM books_vocab))) AS logp FROM books_vocab v CROSS JOIN nb_n n
JOIN (SELECT lang, sum(s) AS mass FROM nb_s GROUP BY lang) m ON m.lang = n.lang LEFT JOIN nb_s s ON s.term = v.term AND s.lang = n.lang""")
S.add_table("nb_score", ("chunk_split", "nb_n", "nb_p", "books_w"), """
SELECT c.chunk_id, c.lang AS label, n.lang AS p, ln(n.prior) + coalesce(x.s, 0) AS score FROM chunk_split c CROSS JOIN nb_n n LEFT JOIN (
  SELECT w.chunk_id, p.lang, sum(w.weight * p.logp) AS s FROM books_w w JOIN nb_p p ON w.term = p.term GROUP BY 1, 2) x
ON x.chunk_id = c.chunk_id AND x.lang = n.lang WHERE c.is_test = 1""")


def bayes_rows(spark, folder):
    chunks = chunks_of(spark, folder).select("chunk_id", F.col("lang").alias("label"), "text")
    chunks = stored(chunks, "labelled-chunks")
    vocab = VZ.fit(chunks, "text", VZ.BOOK_TFIDF)
    rows = VZ.sparse_rows(chunks, "text", vocab, "chunk_id", ("label",)).withColumnRenamed("weight", "vector")
    return SP.at_random(rows, "chunk_id").persist(), vocab


@query("naive_bayes", S.with_tables("nb_score", """
SELECT chunk_id, label, p, round(score, 4) + 0.0 AS score FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY score DESC, p) AS r
FROM nb_score) WHERE r = 1"""))
def naive_bayes(spark, folder):
    rows, vocab = bayes_rows(spark, folder)
    found = C.naive_bayes(rows.filter("is_test = 0"), rows.filter("is_test = 1"), "chunk_id", vocab.size)
    return found.withColumn("score", X.rounded(F.col("score"), 4))


@query("svm_linear")
def svm_linear(spark, folder):
    return L.support_vectors(*labelled(spark, folder), kernel="linear")


@query("svm_rbf")
def svm_rbf(spark, folder):
    return L.support_vectors(*labelled(spark, folder, binary=True), kernel="rbf")


@query("svm_probability")
def svm_probability(spark, folder):
    return L.margin_probability(*labelled(spark, folder, binary=True))


@query("svm_poly")
def svm_poly(spark, folder):
    return L.support_vectors(*labelled(spark, folder, binary=True), kernel="poly", gamma="auto")


@query("svm_class_probabilities")
def svm_class_probabilities(spark, folder):
    """Coupled probabilities of three classes, one row per test row and class."""
    train, test = (rows.withColumn("label", F.col("label") % 3) for rows in labelled(spark, folder))
    machine = L.KernelMachine(kernel="rbf", probability=True).fit(train)
    found = machine.predict(test)
    return found.select("id", "y", "p", F.posexplode("probabilities").alias("class", "probability"))


@query("random_forest")
def random_forest(spark, folder):
    train, test = labelled(spark, folder)
    return L.shown(L.random_forest(train), test)


@query("logistic")
def logistic(spark, folder):
    train, test = labelled(spark, folder)
    return L.shown(L.logistic(train), test)


@query("decision_tree")
def decision_tree(spark, folder):
    train, test = labelled(spark, folder)
    return L.shown(L.decision_tree(train), test)


@query("bagging")
def bagging(spark, folder):
    train, test = labelled(spark, folder)
    return L.shown(L.bagging(train), test)


@query("adaboost")
def adaboost(spark, folder):
    train, test = labelled(spark, folder, binary=True)
    return L.AdaBoost(50).fit(train).predict(test)


@query("gradient_boosting")
def gradient_boosting(spark, folder):
    train, test = labelled(spark, folder, binary=True)
    return L.shown(L.gradient_boosting(train), test)


@query("perceptron")
def perceptron(spark, folder):
    train, test = labelled(spark, folder)
    return L.shown(L.perceptron(train), test)


@query("linreg_multiple")
def linreg_multiple(spark, folder):
    train, test = labelled(spark, folder)
    return L.shown(L.linear_regression(train), test)


@query("linreg_poly")
def linreg_poly(spark, folder):
    rows = points(spark, folder).select(F.col("vec_id").alias("id"), F.col("label").cast("double").alias("label"), "vector")
    rows = L.to_vectors(FT.poly_features(rows, 5)).persist()
    return L.shown(L.linear_regression(rows), rows)


@query("feature_importance")
def feature_importance(spark, folder):
    train, _ = labelled(spark, folder)
    return L.importances(L.random_forest(train), train)


@query("grid_search")
def grid_search(spark, folder):
    """A space given by the caller: three sets, five folds each. Without one, ``tune`` searches all of ``SEARCH``."""
    train, _ = labelled(spark, folder)
    return L.tune("Logistic Regression", SP.stratified_folds(train, "label", "id").persist(), {"C": [0.1, 1, 10], "penalty": ["l2"]})


@query("kmeans")
def kmeans(spark, folder):
    rows = L.to_vectors(points(spark, folder).withColumnRenamed("vec_id", "id")).persist()
    return CL.assign(CL.kmeans(rows), rows)


S.add_table("centres", ("points",), "SELECT label AS cluster, v AS centre FROM points QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1")
S.add_table("moved", ("points", "centres"), """
SELECT vec_id, v, cluster FROM (SELECT p.vec_id, p.v, c.cluster, row_number() OVER (PARTITION BY p.vec_id ORDER BY
  round(list_sum(list_transform(list_zip(p.v, c.centre), lambda e: (e[1] - e[2]) * (e[1] - e[2]))), 9), c.cluster) AS r
  FROM points p, centres c) WHERE r = 1""")


@query("kmeans_step", S.with_tables("moved", f"""
SELECT cluster, feature, count(*) AS n, {r6('avg(x)')} AS x FROM (SELECT cluster, unnest(v) AS x, CAST(generate_subscripts(v, 1) - 1 AS INT) AS feature
FROM moved) GROUP BY cluster, feature"""))
def kmeans_step(spark, folder):
    rows = points(spark, folder)
    centres = rows.groupBy(F.col("label").alias("cluster")).agg(F.min_by("vector", "vec_id").alias("centre"))
    return CL.kmeans_step(rows, centres).withColumn("x", X.rounded(F.col("x")))


@query("ward_two_stage")
def ward_two_stage(spark, folder):
    rows = L.to_vectors(points(spark, folder).withColumnRenamed("vec_id", "id")).persist()
    return CL.ward(rows)


S.add_table("doc_lang", ("review_tokens",), "SELECT t.row_id, d.lang AS cluster FROM review_tokens t JOIN documents d ON t.row_id = d.doc_id")


@query("cluster_top_terms", S.with_tables("revs_w", "doc_lang", f"""
SELECT cluster, CAST(r AS INT) AS rank, term, {r6('weight')} AS weight FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS r
FROM (SELECT d.cluster, w.term, round(sum(w.weight) / any_value(n.n), 9) AS weight FROM revs_w w JOIN doc_lang d ON w.row_id = d.row_id
JOIN (SELECT cluster, count(*) AS n FROM doc_lang GROUP BY cluster) n ON n.cluster = d.cluster GROUP BY d.cluster, w.term)) WHERE r <= 10"""))
def cluster_top_terms(spark, folder):
    docs = tables.documents(spark, folder).select("row_id", F.col("lang").alias("cluster"), F.col("text").alias("reviewText"))
    texts = WD.review_tokens(docs).select("row_id", "cluster", F.array_join("tokens", " ").alias("clean_joined"))
    texts = stored(texts, "texts")
    vocab = VZ.fit(texts, "clean_joined", VZ.REVIEW_TFIDF)
    sparse = VZ.sparse_rows(texts, "clean_joined", vocab, "row_id", ("cluster",)).persist()
    pairs = F.arrays_zip(F.col("idx").alias("idx"), F.col("weight").alias("weight"))
    weights = X.each(sparse, ["row_id", "cluster"], pairs, "e").select(
        "row_id", "cluster", F.col("e.idx").alias("term_idx"), F.col("e.weight").alias("weight"))
    weights = weights.join(F.broadcast(vocab.table(spark).select("term_idx", "term")), "term_idx")
    top = CL.top_terms(weights, sparse)
    return top.select("cluster", "rank", "term", X.rounded(F.col("weight")).alias("weight"))


SUPPORT, LEVELS = 0.15, 8
S.add_table("baskets", ("review_tokens",), "SELECT row_id, unnest(list_distinct(tokens)) AS item FROM review_tokens")
S.add_table("basket_n", ("review_tokens",), f"SELECT count(*) AS n, {SUPPORT} * count(*) - 1e-9 AS least FROM review_tokens")
S.add_table("hold1", ("baskets", "basket_n"), "SELECT row_id, item AS last, [item] AS items FROM baskets WHERE item IN"
            " (SELECT item FROM baskets GROUP BY item HAVING count(*) >= (SELECT least FROM basket_n))")
for _l in range(2, LEVELS + 1):
    S.add_table(f"grow{_l}", (f"hold{_l - 1}", "hold1"), f"SELECT a.row_id, b.last, list_append(a.items, b.last) AS items FROM hold{_l - 1} a"
                " JOIN hold1 b ON a.row_id = b.row_id AND b.last > a.last")
    S.add_table(f"hold{_l}", (f"grow{_l}", "basket_n"), f"SELECT * FROM grow{_l} WHERE items IN (SELECT items FROM grow{_l} GROUP BY items"
                " HAVING count(*) >= (SELECT least FROM basket_n))")
S.add_table("itemsets", tuple(f"hold{i}" for i in range(1, LEVELS + 1)) + ("basket_n",), " UNION ALL ".join(
    f"SELECT items, count(*) AS freq, count(*) / (SELECT n FROM basket_n) AS support FROM hold{i} GROUP BY items" for i in range(1, LEVELS + 1)))
S.add_table("rule_sides", ("itemsets",), """
SELECT list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS a, list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 0) AS c, support
FROM (SELECT items, support, unnest(range(1, CAST(power(2, len(items)) AS BIGINT) - 1)) AS mask FROM itemsets WHERE len(items) > 1)""")
S.add_table("rules", ("rule_sides", "itemsets"), """
SELECT array_to_string(r.a, '|') AS antecedent, array_to_string(r.c, '|') AS consequent, r.support, r.support / i.support AS confidence,
r.support / i.support / j.support AS lift, r.support - i.support * j.support AS leverage,
CASE WHEN r.support < i.support THEN (1 - j.support) / (1 - r.support / i.support) END AS conviction
FROM rule_sides r JOIN itemsets i ON r.a = i.items JOIN itemsets j ON r.c = j.items WHERE r.support / i.support / j.support >= 1.2""")
_RULE_COLUMNS = ("support", "confidence", "lift", "leverage", "conviction")
_RULES = "SELECT antecedent, consequent, " + ", ".join(f"{r6(c)} AS {c}" for c in _RULE_COLUMNS) + " FROM rules"


def baskets(spark, folder):
    return WD.review_tokens(tables.review_texts(spark, folder)).select("row_id", X.distinct_items(F.col("tokens")).alias("items"))


@query("frequent_itemsets", S.with_tables("itemsets", f"SELECT array_to_string(items, '|') AS items, freq, {r6('support')} AS support FROM itemsets"))
def frequent_itemsets(spark, folder):
    sets = R.frequent_itemsets(baskets(spark, folder).persist(), SUPPORT)
    return sets.select(F.array_join("items", "|").alias("items"), "freq", X.rounded(F.col("support")).alias("support"))


PAIR_SUPPORT = 0.01
S.add_table("pairs", ("baskets",), f"""
SELECT x || '|' || y AS items, freq, freq / n AS support FROM (SELECT a.item AS x, b.item AS y, count(*) AS freq FROM baskets a JOIN baskets b
ON a.row_id = b.row_id AND a.item < b.item GROUP BY a.item, b.item), (SELECT count(*) AS n FROM review_tokens) WHERE freq >= {PAIR_SUPPORT} * n - 1e-9""")


S.add_table("single", ("baskets", "review_tokens"), "SELECT item, count(*) AS freq, count(*) / n AS support, n FROM baskets,"
            " (SELECT count(*) AS n FROM review_tokens) GROUP BY item, n")


@query("frequent_pairs", S.with_tables("pairs", "single", f"SELECT items, freq, {r6('support')} AS support FROM pairs UNION ALL"
                                       f" SELECT item, freq, {r6('support')} FROM single WHERE freq >= {PAIR_SUPPORT} * n - 1e-9"))
def frequent_pairs(spark, folder):
    sets = R.frequent_itemsets(stored(baskets(spark, folder), "baskets"), PAIR_SUPPORT, max_len=2)
    return sets.select(F.array_join("items", "|").alias("items"), "freq", X.rounded(F.col("support")).alias("support"))


@query("pair_rules", S.with_tables("pairs", "single", f"""
SELECT antecedent, consequent, {r6('support')} AS support, {r6('support / a')} AS confidence, {r6('support / a / c')} AS lift FROM (
  SELECT a.item AS antecedent, c.item AS consequent, p.support, a.support AS a, c.support AS c
  FROM (SELECT split_part(items, '|', side) AS x, split_part(items, '|', 3 - side) AS y, support FROM pairs, (SELECT unnest([1, 2]) AS side)) p
  JOIN single a ON a.item = p.x JOIN single c ON c.item = p.y)
WHERE support / a / c >= 1.2"""))
def pair_rules(spark, folder):
    sets = stored(R.frequent_itemsets(stored(baskets(spark, folder), "baskets"), PAIR_SUPPORT, max_len=2), "pairs")
    rules = R.association_rules(sets)
    return rules.select(F.array_join("antecedent", "|").alias("antecedent"), F.array_join("consequent", "|").alias("consequent"),
                        *[X.rounded(F.col(c)).alias(c) for c in ("support", "confidence", "lift")])


def _rules(spark, folder):
    rules = R.association_rules(R.frequent_itemsets(baskets(spark, folder).persist(), SUPPORT))
    finite = F.when(F.col("conviction") < float("inf"), F.col("conviction"))
    return rules.withColumn("conviction", finite)


def _shown_rules(rules):
    return rules.select(F.array_join("antecedent", "|").alias("antecedent"), F.array_join("consequent", "|").alias("consequent"),
                        *[X.rounded(F.col(c)).alias(c) for c in _RULE_COLUMNS])


@query("association_rules", S.with_tables("rules", _RULES))
def association_rules(spark, folder):
    return _shown_rules(_rules(spark, folder))


@query("top_rules", S.with_tables("rules", f"SELECT * FROM ({_RULES}) ORDER BY lift DESC, antecedent, consequent LIMIT 10"))
def top_rules(spark, folder):
    return R.top_rules(_shown_rules(_rules(spark, folder)))
