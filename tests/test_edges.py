"""Edge cases and small fixtures checked by brute force."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.functions import porter
from quillspark.functions import text as X
from quillspark.operators import answers, classify, cluster, features, learners, metrics, nearest, rules, split, vectorize
from quillspark.operators import words as WD
from quillspark.operators.vector_table import VectorTable
from quillspark.plans import books, model_queries
from quillspark.session import scratch_path
from quillspark.sources import artefacts, tables


def one(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).head()[0]


def test_page_of_three_words_is_empty(spark):
    assert one(spark, "Page 1 of 2 one two  three", X.clean_page) == ""
    assert one(spark, "one two\n 12 \nthree four", X.clean_page) == "one two three four"


def test_book_clean_keeps_the_gaps_of_dropped_numbers(spark):
    assert one(spark, "See 12 apples at http://a.b/c now, Mr X@y.z Énd 7", X.clean_book) == "see  apples at now, mr nd "
    assert one(spark, "@ab a@ x@y@z (k@l)", X.clean_book) == "ab a"


def test_review_clean_takes_any_character_after_www(spark):
    assert one(spark, "<b>Hi</b> wwwxfoo xhttpfoo it's 5", X.clean_review) == "hi x it s"


def test_chunk_edges(spark):
    rows = spark.createDataFrame([(1, " ".join(["w"] * 1000)), (2, ""), (3, "a b")], "id int, t string")
    got = {(r["id"], r["chunk_idx"]): len(r["chunk"].split()) for r in X.with_chunks(rows, "t").collect()}
    assert got == {(1, 0): 1000, (1, 1): 100, (3, 0): 2}
    with pytest.raises(ValueError):
        X.with_chunks(rows, "t", 10, 10)


def test_keep_repeated_matches_counting(spark):
    rng = np.random.default_rng(1)
    lists = [[str(x) for x in rng.integers(0, 9, size=n)] for n in (0, 1, 7, 40)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "row_id int, t array<string>")
    for m in (1, 2, 3):
        got = {r["row_id"]: r["o"] for r in X.keep_repeated(rows, "t", "o", m).collect()}
        assert got == {i: [w for w in v if v.count(w) >= m] for i, v in enumerate(lists)}


def test_porter_words():
    known = {"caresses": "caress", "ponies": "poni", "dies": "die", "cats": "cat", "agreed": "agre", "plastered": "plaster",
             "motoring": "motor", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file", "happy": "happi",
             "sky": "sky", "enjoy": "enjoy", "relational": "relat", "conditional": "condit", "vietnamization": "vietnam",
             "electrical": "electr", "hopefulness": "hope", "adjustment": "adjust", "adoption": "adopt", "probate": "probat",
             "cease": "ceas", "controll": "control", "roll": "roll", "generalizations": "gener", "by": "by", "flies": "fli"}
    assert {w: porter.stem(w) for w in known} == known


def test_stem_and_lemma_switches(spark):
    pages = spark.createDataFrame([(1, "running runs running runs cat cats cat cats")], "row_id long, text string")
    stem = WD.preprocess(pages, True, False).head()["final_tokens"]
    lemma = WD.preprocess(pages, False, True).head()["final_tokens"]
    both = WD.preprocess(pages, True, True).head()["final_tokens"]
    assert stem == ["run", "run", "run", "run", "cat", "cat", "cat", "cat"] == both
    assert lemma == ["running", "runs", "running", "runs", "cat", "cat", "cat", "cat"]


def test_stems_and_lemmas_stay_in_their_rows(spark):
    rows = [(1, ["ponies", "pony", None, "cats"]), (2, []), (3, None), (1, ["cat", "women", "woman", "buses"])]
    df = spark.createDataFrame(rows, "row_id long, tokens array<string>")
    stems = df.select("row_id", WD.stem_tokens("tokens").alias("s"))
    assert "Exchange" not in stems._jdf.queryExecution().toString()
    assert sorted(map(str, (tuple(r) for r in stems.collect()))) == sorted(map(str, [
        (1, [None if t is None else porter.stem(t) for t in rows[0][1]]), (2, []), (3, None), (1, [porter.stem(t) for t in rows[3][1]])]))
    want = [(1, ["pony", "pony", None, "cat"]), (2, []), (3, None), (1, ["cat", "woman", "woman", "buses"])]
    assert sorted(map(str, (tuple(r) for r in WD.lemmatise(df, "tokens", "s").select("row_id", "s").collect()))) == sorted(map(str, want))
    apart = df.filter("row_id > 1 OR tokens[0] = 'ponies'").na.drop()
    joined = {r["row_id"]: r["s"] for r in WD.lemmatise(apart, "tokens", "s", rows=0).collect()}
    assert joined == {1: ["pony", "pony", None, "cats"], 2: []}


@pytest.mark.parametrize("name", ["page_lemmas", "lemma_join"])
def test_texts_are_cleaned_once_for_lemmas(spark, tmp_path, name):
    """The plan that makes the result reads a stored table, not the documents."""
    from quillspark.plans.catalog import QUERIES
    docs = [(1, "Cats and dogs like cats and dogs. A cat is no dog.", "en", "book.pdf", 50), (2, "", "en", "book.pdf", 0), (3, None, "en", "book.pdf", 0),
            (4, "The cat met the cat, the dog met the dog.", "en", "book.pdf", 40)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    made = QUERIES[name](spark, str(tmp_path))
    assert not any("documents.parquet" in f for f in made.inputFiles())
    rows = {tuple(r) for r in made.collect()}
    if name == "lemma_join":
        assert {r[2] for r in rows if r[0] == 1} == {"cat", "dog", "like"}
    else:
        assert {r for r in rows if r[0] == 1} == {(1, "cat dog cat dog")}


def test_look_up_beyond_the_broadcast_bound(spark):
    tokens = spark.createDataFrame([(i, 0, "cats" if i % 2 else f"w{i}") for i in range(50)], "row_id int, pos int, word string")
    table = spark.createDataFrame([("cats", "cat"), ("w2", "v2")], "word string, lemma string")
    small = WD.look_up(tokens, table, "word", "lemma").orderBy("row_id").collect()
    large = WD.look_up(tokens, table, "word", "lemma", rows=1).orderBy("row_id").collect()
    assert [r["lemma"] for r in small] == [r["lemma"] for r in large] and small[1]["lemma"] == "cat"


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("bound", [1 << 20, 1])
def test_nearest_against_brute_force(spark, monkeypatch, metric, bound):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 7)
    monkeypatch.setattr(nearest, "ITEM_BLOCK", 20)
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 4))
    x[20:40] = x[0]  # a third of the items are copies
    q = rng.standard_normal((15, 4))
    items = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, vector array<double>")
    got = {(r["q_id"], r["rank"]): r["item_id"] for r in nearest.top_k(asked, items, 5, metric, broadcast_bytes=bound).collect()}
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - unit(q) @ unit(x).T if metric == "cosine" else ((q[:, None] - x[None]) ** 2).sum(axis=2)
    want = {(i, r + 1): int(j) for i in range(15) for r, j in enumerate(np.lexsort((np.arange(60), np.round(d[i], 9)))[:5])}
    assert got == want


def test_vector_table(spark):
    t = VectorTable(spark, scratch_path(spark, "vectors"), "id string, document string, embedding array<float>")
    rows = spark.createDataFrame([("a", "x", [1.0]), ("b", "y", [2.0])], t.schema)
    assert t.count() == 0
    t.add(rows)
    t.add(spark.createDataFrame([("a", "new", [9.0]), ("c", "z", [3.0])], t.schema))
    t.update(spark.createDataFrame([("b", "yy"), ("zz", "none")], "id string, document string"))
    t.delete(spark.createDataFrame([("c",), ("unknown",)], "id string"))
    assert {(r["id"], r["document"], r["embedding"][0]) for r in t.rows().collect()} == {("a", "x", 1.0), ("b", "yy", 2.0)}
    asked = spark.createDataFrame([("q", [1.9])], "id string, vector array<double>")
    assert [r["item_id"] for r in t.search(asked, 1).collect()] == ["b"]
    assert [r["item_id"] for r in t.search(asked, 1, where={"id": {"$ne": "b"}}).collect()] == ["a"]


def test_filter_operators(spark):
    rows = spark.range(6)
    def ids(rule):
        return [r["id"] for r in rows.filter(nearest.where_clause(rule)).orderBy("id").collect()]
    assert ids({"id": {"$gt": 1, "$lte": 4}}) == [2, 3, 4]
    assert ids({"$or": [{"id": 0}, {"$and": [{"id": {"$gte": 4}}, {"id": {"$nin": [5]}}]}]}) == [0, 4]
    with pytest.raises(ValueError):
        nearest.where_clause({"id": {"$like": 1}})


def test_question_of_single_words(spark):
    q = spark.createDataFrame([(1, "gradient descent optimizer")], "q_id long, query string")
    assert answers.question_terms(q).head()["terms"] == "gradient descent optimizer"
    assert answers.question_terms(q, legacy_query=True).head()["terms"] == ""


def test_vocabulary_pruning_is_exact(spark):
    texts = [(i, " ".join(f"w{(i * j) % 7}" for j in range(1, 12))) for i in range(20)]
    rows = spark.createDataFrame(texts, "row_id int, text string")
    spec = vectorize.VectorizerSpec(1, 3, 1, 1.0, 12)
    counts: dict = {}
    for _, t in texts:
        w = t.split()
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                g = " ".join(w[i:i + n])
                counts[g] = counts.get(g, 0) + 1
    want = sorted(sorted(counts, key=lambda g: (-counts[g], g))[:12])
    assert vectorize.fit(rows, "text", spec).terms == want
    with pytest.raises(ValueError):
        vectorize.VectorizerSpec(kind="other")


@pytest.mark.parametrize("centre", [True, False])
@pytest.mark.parametrize("size", [8, 1200])
def test_projection_matches_numpy(spark, centre, size):
    rng = np.random.default_rng(5)
    scale = np.arange(1, 9)[::-1] if size == 8 else 1.0 / np.arange(1, size + 1)
    x = rng.standard_normal((40 if size == 8 else 90, size)) * scale + 3 / size
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, vector array<double>")
    p = features.fit_projection(rows, size, 3, centre)
    base = x - x.mean(axis=0) if centre else x
    _, _, vt = np.linalg.svd(base, full_matrices=False)
    assert np.allclose(np.abs(p.axes), np.abs(vt[:3].T), atol=1e-6)
    got = np.array([r["vector"] for r in features.project(rows, p).orderBy("id").collect()])
    assert np.allclose(got, base @ p.axes)
    assert np.allclose(p.variance_ratio, got.var(axis=0) / x.var(axis=0).sum())


def test_nearly_constant_feature(spark):
    rows = spark.createDataFrame([(i, [0.1 + 0.2 if i % 2 else 0.3, float(i)]) for i in range(6)], "id int, vector array<double>")
    assert all(abs(r["vector"][0]) < 1e-9 for r in features.minmax_scale(rows).collect() + features.standard_scale(rows).collect())


def test_margin_machine_against_brute_force(spark):
    """The weights minimise C * sum of hinge losses + |w|^2 / 2 on features as they are."""
    from quillspark.operators import learners

    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 2)) * [5.0, 0.5]
    y = (x @ [0.2, 2.0] + 0.3 * rng.standard_normal(60) > 0).astype(int)
    rows = learners.weighted(learners.to_vectors(spark.createDataFrame(
        [(i, int(c), v.tolist()) for i, (v, c) in enumerate(zip(x, y))], "id int, label int, vector array<double>")), None)
    model = learners.margin_machine(60, 1.0, 400).fit(rows)
    loss = lambda w, b: np.maximum(0, 1 - (2 * y - 1) * (x @ w + b)).sum() + w @ w / 2
    w, b, best = np.zeros(2), 0.0, np.inf
    for step in range(1, 40001):
        live = (2 * y - 1) * (x @ w + b) < 1
        g = w - ((2 * y - 1)[live, None] * x[live]).sum(axis=0)
        w, b = w - g / (60 + step), b + (2 * y - 1)[live].sum() / (60 + step)
        best = min(best, loss(w, b))
    assert loss(model.coefficients.toArray(), model.intercept) <= 1.02 * best


def test_polynomial_sketch_approaches_its_kernel(spark):
    from quillspark.operators import learners
    from pyspark.ml.functions import vector_to_array

    x = np.random.default_rng(4).standard_normal((30, 6))
    rows = learners.to_vectors(spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "id int, label int, vector array<double>"))
    made = np.array([r[0] for r in learners.kernel_map(rows, "poly", 0.5, components=8192).orderBy("id").select(vector_to_array("features")).collect()])
    want = (0.5 * x @ x.T) ** 3
    assert np.abs(made @ made.T - want).mean() < 0.1 * np.abs(want).mean() + 0.05 * np.abs(want).max()


def test_metadata_keys(spark):
    from quillspark.operators import vector_table

    rows = spark.createDataFrame([("a", "x", [1.0], ("s", 1, "o")), ("b", "y", [1.0], ("s", 2, "o")), ("c", "z", [1.0], ("t", None, "o"))], vector_table.SCHEMA)
    asked = spark.createDataFrame([("q", [1.0])], "id string, vector array<float>")
    found = lambda where: {r["item_id"] for r in vector_table.search(rows, asked, 5, where=where).collect()}
    assert found({"page": {"$gte": 2}}) == {"b"} == found({"metadata.page": 2}) and found({"$or": [{"id": "a"}, {"source": "t"}]}) == {"a", "c"}
    assert found({"page": {"$ne": 1}}) == {"b"}


def test_constant_feature(spark):
    rows = spark.createDataFrame([(i % 2, [1.0, float(i)]) for i in range(6)], "label int, vector array<double>")
    assert {r["feature"]: r["f"] is None for r in features.f_scores(rows, "label").collect()} == {0: True, 1: False}
    assert all(r["vector"][0] == 0 for r in features.standard_scale(rows).collect())


def test_report_without_predictions_of_a_class(spark):
    rows = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    got = {r["label"]: r for r in metrics.report(rows, "y", "p").collect()}
    assert got["b"]["precision"] == 0 and got["b"]["f1"] == 0 and got["accuracy"]["f1"] == 0.5


def test_split_and_folds(spark):
    rows = spark.range(1000).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    by = {r["label"]: (r["n"], r["t"]) for r in split.stratified(rows, "label", "id").groupBy("label").agg(
        F.count("*").alias("n"), F.sum("is_test").alias("t")).collect()}
    assert by == {0: (666, 133), 1: (334, 67)}
    sizes = [r["count"] for r in split.stratified_folds(rows, "label", "id").groupBy("label", "fold").count().collect()]
    assert max(sizes) - min(s for s in sizes if s > 100) <= 1 and len(sizes) == 10


def test_itemsets_and_rules_against_brute_force(spark):
    rng = np.random.default_rng(2)
    data = [sorted({f"i{x}" for x in rng.integers(0, 8, size=5)}) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(data)), "row_id int, items array<string>")
    sets = rules.frequent_itemsets(rows, 0.1)
    got = {tuple(r["items"]): r["freq"] for r in sets.collect()}
    names = sorted({i for d in data for i in d})
    want = {c: n for k in range(1, 9) for c in combinations(names, k) if (n := sum(set(c) <= set(d) for d in data)) >= 6}
    assert got == want
    found = rules.association_rules(sets, min_threshold=1.2).collect()
    assert found and all(abs(r["lift"] - r["support"] / r["antecedent_support"] / r["consequent_support"]) < 1e-12 for r in found)


def test_ward_merges_near_centres():
    c = np.array([[0.0], [0.1], [5.0], [5.1], [20.0]])
    g = cluster.ward_merge(c, np.ones(5), 3)
    assert g[0] == g[1] and g[2] == g[3] and len(set(g)) == 3


def line(spark, n=60):
    rows = spark.createDataFrame([(i, float(i >= n // 2), [float(i), float(i % 3)]) for i in range(n)], "id long, label double, vector array<double>")
    return learners.to_vectors(rows).persist()


def test_adaboost_separates(spark):
    rows = line(spark)
    boosted = learners.AdaBoost(5).fit(rows)
    assert abs(boosted.weights.agg(F.sum("w")).head()[0] - 1) < 1e-9
    assert metrics.binary(boosted.predict(rows), "y", "p").head()["accuracy"] == 1


def test_linear_residuals_sum_to_zero(spark):
    rows = line(spark)
    r = learners.shown(learners.linear_regression(rows), rows).agg(F.sum(F.col("y") - F.col("p"))).head()[0]
    assert abs(r) < 1e-6


def test_saved_artefacts_reload(spark):
    rows = line(spark)
    model = learners.decision_tree(rows)
    path = scratch_path(spark, "model")
    artefacts.save_model(model, path)
    again = artefacts.load_model(path)
    assert learners.shown(model, rows).collect() == learners.shown(again, rows).collect()
    texts = spark.createDataFrame([(1, "red green"), (2, "green blue")], "row_id int, text string")
    vocab = vectorize.fit(texts, "text", vectorize.REVIEW_TFIDF)
    artefacts.save_vocabulary(spark, vocab, path + "-v")
    assert artefacts.load_vocabulary(spark, path + "-v") == vocab


def test_bad_names(spark):
    rows = spark.createDataFrame([("a", "x", "t", 0)], "id string, label string, text string, is_test int")
    for wrong in ({"kind": "other"}, {"reducer": "other"}, {"fit_on": "other"}):
        with pytest.raises(ValueError):
            books.feature_rows(rows, **wrong)
    with pytest.raises(ValueError):
        classify.NaiveBayes(3, alpha=0)


def test_page_docs_keeps_null_and_repeated_ids(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "b", "x"), (None, "c", "x"), (2, "d", "x"), (0, "e", None), (None, "f", None)]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["row_id"], r["text"], r["source"]): r["page"] for r in tables.page_docs(spark, str(tmp_path)).collect()}
    assert set(got) == set(rows)
    assert {got[1, "a", "x"], got[1, "b", "x"]} == {1, 2} and got[2, "d", "x"] == 3 and got[None, "c", "x"] == 4
    assert got[0, "e", None] == 1 and got[None, "f", None] == 2


def test_basket_rows_are_those_of_reviews_without_moving_texts(spark, tmp_path, capsys, monkeypatch):
    docs = [(1, "a b"), (2, "c"), (2, "d"), (None, "e"), (3, None), (5, "f g")]
    labels = [(1, 1, 0), (1, 0, 0), (1, None, 1), (2, 1, 1), (2, 1, 1), (None, 1, 0), (None, 0, 0), (4, 1, 0), (5, 0, 0)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for labels beyond it
    try:
        model_queries.baskets(spark, str(tmp_path)).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in capsys.readouterr().out
    want = tables.reviews(spark, str(tmp_path)).select("row_id", "reviewText").collect()
    for rows in (200_000, 0):
        monkeypatch.setattr("quillspark.session.fits", lambda df, _: rows > 0)
        got = tables.review_texts(spark, str(tmp_path))
        assert got.columns == ["row_id", "reviewText"] and sorted(map(str, got.collect())) == sorted(map(str, want)) and len(want) == 10


def test_itemsets_in_rounds_match_counting(spark, monkeypatch):
    rng = np.random.default_rng(11)
    baskets = [sorted({str(x) for x in rng.integers(0, 14, size=rng.integers(0, 9))}) for _ in range(400)] + [None, [None, "1"], ["1", "2", "3"]]
    rows = spark.createDataFrame([(b,) for b in baskets], "items array<string>").repartition(5)
    want = {}
    for size in range(1, 6):
        for b in baskets:
            for c in combinations([x for x in sorted(b or [], key=lambda x: x or "") if x], size):
                want[c] = want.get(c, 0) + 1
    want = {c: n for c, n in want.items() if n >= 0.012 * len(baskets)}
    got = {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(rows, 0.012).collect()}
    assert got == want and max(map(len, got)) >= 3
    monkeypatch.setattr(rules, "COUNTERS", 40)
    monkeypatch.setattr(rules, "CANDIDATES", 7)
    assert {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(rows, 0.012, max_len=2).collect()} == {c: n for c, n in want.items() if len(c) < 3}
    assert rules.frequent_itemsets(rows.limit(0), 0.012).count() == 0


def test_coupling_recovers_consistent_probabilities():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(5), size=40)
    pairwise = p[:, :, None] / (p[:, :, None] + p[:, None, :])
    assert np.allclose(learners.coupled(pairwise), p)


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_kernel_machine(spark, kernel):
    rng = np.random.default_rng(4)
    middle = np.array([[2.0, 0, 0], [0, 2, 0], [0, 0, 2]])
    rows = [(i, float(i % 3), (middle[i % 3] + rng.normal(size=3) * 0.3).tolist()) for i in range(90)]
    rows = learners.to_vectors(spark.createDataFrame(rows, "id long, label double, vector array<double>").repartition(2)).persist()
    machine = learners.KernelMachine(kernel=kernel, probability=kernel == "rbf", max_iter=20).fit(rows)
    found = machine.predict(rows).collect()
    assert np.mean([r["y"] == r["p"] for r in found]) > 0.9
    path = scratch_path(spark, "machine")
    artefacts.save_model(machine, path)
    assert learners.KernelMachine.load(path).predict(rows).collect() == found
    if kernel == "rbf":
        probabilities = np.array([r["probabilities"] for r in found])
        assert np.allclose(probabilities.sum(axis=1), 1) and np.mean(probabilities.argmax(axis=1) == [r["y"] for r in found]) > 0.9


def test_machines_of_all_folds_are_fitted_at_the_same_time(spark, monkeypatch):
    import threading

    from quillspark.operators import learners as L
    rows = [(i, float(i % 2), [float(i % 2) + (i % 7) / 9, (i % 5) / 9]) for i in range(90)]
    data = L.to_vectors(spark.createDataFrame(rows, "id long, label double, vector array<double>"))
    made, together, whole = L.margin_machine, threading.Barrier(4), []

    def watched(*args):
        together.wait(60)  # broken if the four fits come one after the other
        whole.append(args)
        return made(*args)

    monkeypatch.setattr(L, "margin_machine", watched)
    machine = L.KernelMachine(kernel="linear", probability=True).fit(data)
    assert len(whole) == 4
    shown = machine.predict(data).collect()
    assert sum(r["y"] == r["p"] for r in shown) >= 80 and all(abs(sum(r["probabilities"]) - 1) < 1e-9 for r in shown)


def test_own_models_reload(spark):
    rows = line(spark)
    boosted = learners.AdaBoost(4).fit(rows)
    path = scratch_path(spark, "boosted")
    artefacts.save_model(boosted, path)
    assert learners.AdaBoost.load(path).predict(rows).collect() == boosted.predict(rows).collect()
    sparse = spark.createDataFrame([(i, float(i % 2), [i % 2, 2], [1.0, 0.5]) for i in range(12)], "id long, label double, idx array<int>, vector array<double>")
    bayes = classify.NaiveBayes(4).fit(sparse)
    artefacts.save_model(bayes, path + "-b")
    assert sorted(classify.NaiveBayes.load(path + "-b").predict(sparse, "id").collect()) == sorted(bayes.predict(sparse, "id").collect())
