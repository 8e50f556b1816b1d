"""Pruned nearest neighbours against all pairs, and how many pairs they compare."""

import numpy as np
import pytest

from quillspark.operators import nearest


def rows(spark, ids, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], "id long, vector array<double>")


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_same_as_all_pairs(spark, metric):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 6)) * 8
    items = centres[rng.integers(0, 30, size=3000)] + rng.normal(size=(3000, 6)) * 0.3
    items[::500] = 0
    items[7::300] = items[7]
    queries = np.concatenate([items[:150], rng.normal(size=(20, 6)) * 9, np.zeros((2, 6))])
    q, x = rows(spark, range(len(queries)), queries), rows(spark, range(len(items)), items)
    counter = spark.sparkContext.accumulator(0)
    found = [{tuple(r) for r in df.collect()} for df in (
        nearest.top_k(q, x, 4, metric, cells=True, counter=counter), nearest.top_k(q, x, 4, metric))]
    assert found[0] == found[1] and len(found[0]) == 4 * len(queries)
    assert 0 < counter.value < 0.25 * len(queries) * len(items)


def test_few_items(spark):
    x, q = rows(spark, [1, 2], [[0, 1], [1, 0]]), rows(spark, [5, 6], [[0, 2], [0, 0]])
    got = sorted((r["q_id"], r["item_id"], r["rank"]) for r in nearest.top_k(q, x, 5, "l2", cells=True).collect())
    assert got == [(5, 1, 1), (5, 2, 2), (6, 1, 1), (6, 2, 2)]
    assert nearest.top_k(q, x.limit(0), 5, "cosine", cells=True).count() == 0
    assert nearest.top_k(q.limit(0), x, 5, "l2", dim=2, cells=True).count() == 0
