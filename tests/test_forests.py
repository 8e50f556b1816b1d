"""Forests of more nodes than the driver should hold are grown, kept and applied part by part."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillspark.operators import learners


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((120, 5))
    made = [(i, float((v[1] > 0) + 2 * (v[3] > 0.5)), v.tolist()) for i, v in enumerate(x)]
    made += [made[7], made[7], (None, 1.0, x[8].tolist())]
    return learners.to_vectors(spark.createDataFrame(made, "id int, label double, vector array<double>")).persist()


@pytest.mark.parametrize("fit, trees", [(learners.random_forest, 7), (learners.bagging, 5)])
def test_no_model_holds_all_trees(rows, monkeypatch, tmp_path, fit, trees):
    fits, real = [], RandomForestClassifier.fit
    monkeypatch.setattr(learners, "GROWN", 3 * 123, raising=False)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, data, *a: (fits.append((self.getNumTrees(), self.getSeed())), real(self, data, *a))[1])
    forest = fit(rows, trees)
    found = forest.transform(rows)
    assert max(n for n, _ in fits) * 123 <= 3 * 123 and sum(n for n, _ in fits) == trees and len({s for _, s in fits}) == len(fits)
    seen = [tuple(r) for r in found.select("id", "prediction", vector_to_array("rawPrediction"), vector_to_array("probability")).collect()]
    votes = {}
    for model in forest.models():
        for r in model.transform(rows).select("id", "rawPrediction").distinct().collect():
            votes[r[0]] = votes.get(r[0], 0) + r[1].toArray()
    assert sorted(str(r[0]) for r in seen) == sorted(str(r[0]) for r in rows.select("id").collect())
    for key, p, raw, probability in seen:
        assert p == votes[key].argmax()
        np.testing.assert_allclose(raw, votes[key])
        np.testing.assert_allclose(probability, votes[key] / trees)
    assert learners.shown(forest, rows).filter(F.col("y") == F.col("p")).count() > 110

    best = [r["component"] for r in learners.importances(forest, rows, 2).collect()]
    assert sorted(best) == [1, 3] and forest.featureImportances.toArray().sum() == pytest.approx(1)
    learners.save(forest, str(tmp_path / "forest"))
    again = learners.Forest.load(str(tmp_path / "forest"))
    assert learners.shown(again, rows).exceptAll(learners.shown(forest, rows)).count() == 0
    np.testing.assert_allclose(again.featureImportances.toArray(), forest.featureImportances.toArray())


def test_a_small_forest_is_one_model(rows):
    one = RandomForestClassifier(weightCol="w", numTrees=4, maxDepth=30, featureSubsetStrategy="sqrt", cacheNodeIds=True, seed=learners.V.SEED)
    want = learners.shown(one.fit(learners.weighted(rows, None)), rows)
    assert learners.shown(learners.random_forest(rows, 4), rows).exceptAll(want).count() == 0
