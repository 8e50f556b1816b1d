"""N-grams counted length by length: the same vocabulary as by counting all, with far fewer of them counted."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.operators import vectorize


def texts(rng, n=400):
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    share = 1 / np.arange(1, len(words) + 1)
    return [(i, " ".join(rng.choice(words, size=rng.integers(0, 60), p=share / share.sum()))) for i in range(n)] + [(n, None), (n + 1, ""), (n + 2, "wak wal wak wal")]


@pytest.mark.parametrize("spec", [(1, 3, 3, 0.7, 150), (1, 2, 1, 1.0, 60), (1, 3, 1, 1.0, 20_000), (1, 3, 2, 0.02, 100)])
def test_same_terms(spark, monkeypatch, spec):
    spec = vectorize.VectorizerSpec(*spec)
    df = spark.createDataFrame(texts(np.random.default_rng(2)), "row_id int, text string").repartition(3)
    monkeypatch.setattr(vectorize, "MERGED", 500)
    monkeypatch.setattr(vectorize, "STEP_TOKENS", 700)
    got = vectorize.fit(df, "text", spec)
    n = got.n_docs
    top = vectorize._within(vectorize._totals(df, "text", spec), spec, n).orderBy(F.desc("tf"), "term").limit(spec.max_features).collect()
    assert n == 403 and {(r[0], *r[2:]) for r in got.rows} == {tuple(r) for r in top} and got.terms == sorted(got.terms)


def test_long_ones_are_counted_only_if_their_parts_are_frequent(spark, monkeypatch):
    df = spark.createDataFrame(texts(np.random.default_rng(2)), "row_id int, text string")
    counted = []
    keep = vectorize._gram_totals
    monkeypatch.setattr(vectorize, "_gram_totals", lambda *a: (counted.append(keep(*a).count()), keep(*a))[1])
    vectorize.fit(df, "text", vectorize.VectorizerSpec(1, 3, 3, 0.7, 150))
    every = vectorize._totals(df, "text", vectorize.VectorizerSpec(1, 3)).filter("size(split(term, ' ')) = 3").count()
    assert len(counted) == 2 and counted[1] < every / 5
