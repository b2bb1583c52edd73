"""Regression forests over sparse rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from agorascope.operators import forests, models

SLOTS, ROWS = 300, 600


@pytest.fixture(scope="module")
def sparse(spark):
    """Few filled slots a row; the label follows slots 7 (a jump) and 11 (a count), slot 20 has negative values."""
    draw, data = np.random.default_rng(5), []
    for i in range(ROWS):
        at = {int(s): float(draw.integers(1, 4)) for s in draw.choice(np.arange(30, SLOTS), 6, replace=False)}
        at |= {7: 1.0} if i % 3 == 0 else {}
        at |= {11: float(i % 5)} if i % 5 else {}
        at |= {20: -1.0 if i % 4 == 0 else 2.0} if i % 2 == 0 else {}
        y = 4.0 * (7 in at) + at.get(11, 0.0) + 0.5 * at.get(20, 0.0)
        data.append((i, Vectors.sparse(SLOTS, at) if i else Vectors.dense([at.get(s, 0.0) for s in range(SLOTS)]), y))
    rows = spark.createDataFrame(data, ["id", "features", "y"])
    return rows.withMetadata("features", {"ml_attr": {"num_attrs": SLOTS}}).cache()


def _forest(**more):
    return RandomForestRegressor(labelCol="y", numTrees=20, maxDepth=6, minInstancesPerNode=5, subsamplingRate=0.8, seed=42, **more)


def _error(model, rows):
    return model.transform(rows).select(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]


def test_sparse_rows_are_fitted_by_their_filled_slots(spark, sparse, monkeypatch, tmp_path):
    own = _forest().fit(sparse)
    monkeypatch.setattr(RandomForestRegressor, "_fit", lambda *_: pytest.fail("fitted on all slots"))
    model = models.fit_forest(_forest(), sparse, "id", ROWS)
    assert model.getNumTrees == 20 and model.numFeatures == SLOTS and model.getMaxDepth() == 6
    assert set(np.argsort(model.featureImportances.toArray())[-3:]) == {7, 11, 20}
    assert abs(_error(model, sparse) - _error(own, sparse)) < 0.25 * _error(own, sparse)
    again = models.fit_forest(_forest(), sparse, "id", ROWS)
    assert again.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]
    model.write().save(str(tmp_path / "model"))
    loaded = RandomForestRegressionModel.load(str(tmp_path / "model"))
    assert loaded.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]


def _nodes(spark, model, tmp_path):
    model.write().save(str(tmp_path / "nodes"))
    found = spark.read.parquet(str(tmp_path / "nodes/data")).select("treeID", "nodeData.*").collect()
    return {(r.treeID, r.id): r for r in found}


@pytest.mark.parametrize("cells", [100_000, 1_500])
def test_nodes_hold_what_their_rows_say(spark, sparse, tmp_path, cells):
    """With one block, and with several whose sums are added: every split is the best of some slots, and counts follow it."""
    filled = sparse.agg(F.sum(F.size(forests.filled("features")[0]))).first()[0]
    model = forests.fit_sparse(_forest(), sparse, "id", ROWS, filled, cells)
    nodes = _nodes(spark, model, tmp_path)
    assert len({t for t, _ in nodes}) == 20 and len(nodes) > 200
    if cells > filled:  # the weights of one block can be drawn again
        x = np.array([r.features.toArray() for r in sparse.orderBy("id").collect()])
        y = np.array([r.y for r in sparse.orderBy("id").collect()])
    for (tree, number), r in nodes.items():
        w, wy, wyy = r.impurityStats
        assert r.rawCount == w >= 5 and abs(r.prediction - wy / w) < 1e-9 and abs(r.impurity - (wyy / w - (wy / w) ** 2)) < 1e-9
        if r.leftChild < 0:
            continue
        left, right = nodes[tree, r.leftChild], nodes[tree, r.rightChild]
        assert np.allclose(np.add(left.impurityStats, right.impurityStats), r.impurityStats)
        assert abs(r.gain - (r.impurity - (left.rawCount * left.impurity + right.rawCount * right.impurity) / r.rawCount)) < 1e-9
        if number or cells <= filled:
            continue
        bag = np.random.default_rng([42, tree, 1 << 32, 0]).poisson(0.8, ROWS).astype(float)
        chosen = np.random.default_rng([42, tree, 0]).choice(SLOTS, 100, replace=False, shuffle=False)
        best = 0.0
        for slot in chosen:
            for cut in np.unique(x[:, slot])[:-1]:
                low = x[:, slot] <= cut
                parts = [(bag[p].sum(), np.average(y[p], weights=bag[p])) for p in (low, ~low) if bag[p].sum() >= 5]
                if len(parts) == 2:
                    best = max(best, sum(n * (m - wy / w) ** 2 for n, m in parts) / w)
        assert abs(best - r.gain) < 1e-9
    assert set(np.argsort(model.featureImportances.toArray())[-3:]) == {7, 11, 20}


def test_thresholds_are_those_of_the_other_forest():
    assert forests.slot_thresholds(np.array([1.0, 3.0]), np.array([5, 5]), 20, 31).tolist() == [0.5, 2.0]
    assert forests.slot_thresholds(np.array([-1.0, 0.0, 2.0]), np.array([5, 2, 3]), 20, 31).tolist() == [-0.5, 1.0]
    assert forests.slot_thresholds(np.array([4.0]), np.array([20]), 20, 31).tolist() == []
    assert forests.slot_thresholds(np.arange(1.0, 9.0), np.ones(8, int), 8, 3).tolist() == [2.5, 4.5, 6.5]


def test_other_settings_and_dense_rows_stay_with_spark(spark):
    assert forests.suits(_forest()) and not forests.suits(_forest(featureSubsetStrategy="sqrt")) and not forests.suits(_forest(minInfoGain=0.1))
