"""Operators on vectors, the SQL of this package, and the pipeline."""

import math
from collections import Counter

import numpy as np
import pytest
from compare import differences, duck

import corpus_pipeline
from quillspark.llm import components, cross_polytope, mixing, near_vectors, packing, queries, shingle_join, surrogates

FOLDER = "/root/testdata/sf0.001"
VECTOR = "vec_id long, embedding array<double>, label int, unit string"


@pytest.mark.parametrize("name", [n for n in queries.SQL if n != "op9_jaccard_join"])
def test_same_rows(spark, name):
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), duck(FOLDER).execute(queries.SQL[name]).df()
    assert differences(got, want.astype(got.dtypes.to_dict())) is None


def test_same_jaccard_rows(spark):
    got, want = queries.QUERIES["op9_jaccard_join"](spark, FOLDER).toPandas(), duck(FOLDER).execute(queries.SQL["op9_jaccard_join"]).df()
    assert differences(got, want) is None


def vectors(spark):
    rng = np.random.default_rng(8)
    rows = []
    for c in range(60):
        middle = rng.normal(size=12)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (middle + rng.normal(size=12) * rng.choice([0.01, 0.06, 0.1])).tolist(), c % 3))
    rows += [(len(rows) + i, rows[5][1], rows[5][2]) for i in range(40)]
    odd = [None, [], [0.0] * 12, [1.0, None] + [0.0] * 10, [math.nan] * 12, [math.inf] + [0.0] * 11, rows[0][1][:5], [1e200] * 12, [2e200] * 12]
    rows += [(len(rows) + i, v, 0) for i, v in enumerate(odd)]
    rows += [(len(rows), rows[0][1], None), (None, rows[0][1], rows[0][2]), rows[3]]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], VECTOR)


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "PER_CENTRE", 20)
    rows, df = vectors(spark)
    unit = [np.array(v) / max(map(abs, v)) if good(v) and lab is not None and i is not None else None for i, v, lab in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    n, root = [0] * len(rows), list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                n[a] += 1
                n[b] += 1
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    least = {}
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    want = [(rows[i][0], n[i], least.get(root[i]), rows[i][0] is None or rows[i][0] == least[root[i]]) for i in range(len(rows))]
    for block in (2048, 7):
        monkeypatch.setattr(near_vectors.block_links, "__defaults__", (block,))
        assert Counter(map(tuple, near_vectors.near_duplicates(df).collect())) == Counter(want)
    assert near_vectors.near_duplicates(df.limit(0)).count() == 0


def test_nearest_vectors(spark):
    from pyspark.sql import functions as F

    rows, df = vectors(spark)
    once = {i: v for i, v, _ in rows if i is not None and good(v)}
    got = cross_polytope.search(df, F.col("vec_id") % 5 == 0, k=7).toPandas()
    asked = [i for i in once if i % 5 == 0]
    assert set(got.query_id) <= set(asked)
    hits = total = 0
    for q in asked:
        others = [(sum(x * y for x, y in zip(once[q], v)), i) for i, v in once.items() if i != q and len(v) == len(once[q])]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, min(7, len(others)) + 1))
        exact = {i: s for s, i in others}
        assert all(math.isclose(exact[r.vec_id], r.score, rel_tol=1e-12) for r in mine.itertuples())
        keys = list(zip(-mine.score, mine.vec_id))
        assert keys == sorted(keys)
        best = sorted((-s, i) for s, i in others)[:7]
        hits += len({i for _, i in best} & set(mine.vec_id))
        total += len(best)
    assert hits >= 0.9 * total
    assert cross_polytope.search(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    few = cross_polytope.search(df.limit(4), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r["rank"] for r in few) == [1, 2, 3]


def test_search_recall(spark):
    from pyspark.sql import functions as F

    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = cross_polytope.search(df, F.col("vec_id") % 20 == 0).toPandas()
    table = df.toPandas().sort_values("vec_id")
    x, ids = np.stack(table.embedding).astype(float), table.vec_id.to_numpy()
    hits = []
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        score[q] = -9
        hits.append(len(set(ids[np.argsort(-score)[:20]]) & set(got[got.query_id == ids[q]].vec_id)) / 20)
    assert np.mean(hits) >= 0.9


def test_components(spark):
    import random

    rng = random.Random(1)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(140)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)] + [(5, 5)]
    root = {}
    top = lambda x: x if root.setdefault(x, x) == x else top(root[x])
    for a, b in pairs:
        if a != b:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    got = components.smallest_reachable(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: top(x) for x in root} and len(got) == len(root)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {"": docs}
    last = docs
    for name, stage in corpus_pipeline.STAGES:
        last = kept[name] = corpus_pipeline.stored(stage(spark, last, FOLDER), name)
        assert name == "sequences" or last.columns == docs.columns
    ids = {n: [r.doc_id for r in df.select("doc_id").collect()] for n, df in kept.items()}
    assert sorted(ids["language"]) == sorted(ids[""])  # all documents are in a learned language
    found = shingle_join.jaccard_components(kept["language"]).collect()
    assert sorted(ids["near_copies"]) == sorted(r.doc_id for r in found if r.doc_id == r.component_id)
    private = {r.doc_id: r.text for r in kept["personal_data"].collect()}
    before = {r.doc_id: r.text for r in kept["near_copies"].collect()}
    assert private.keys() == before.keys()
    for i, text in before.items():
        hits = surrogates.detected(text or "")
        assert (private[i] == text) == (not hits) and all(text[a:b] not in private[i] for a, b, kind, _ in hits if kind != "surname")
    mixed = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(kept["personal_data"]).collect()}
    copies = Counter(ids["mixture"])
    assert all(math.floor(t / s) <= copies[i] <= math.ceil(t / s) for i, (t, s) in mixed.items() if s)
    packed = kept["sequences"].toPandas()
    want = packing.pack(kept["mixture"], queries.tokenizer_path()).toPandas()
    assert packed.groupby("doc_id").length.sum().equals(want.groupby("doc_id").length.sum())
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    run = corpus_pipeline.run(spark, FOLDER).toPandas()
    assert sorted(run.ids_crc32) == sorted(packed.ids_crc32)
