"""Regression forests whose rows are several blocks: what is below a few nodes grows in one task, and little is held."""

import tracemalloc

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from agorascope.operators import forests, models

SLOTS, ROWS = 300, 600


def _data(spark):
    draw, data = np.random.default_rng(5), []
    for i in range(ROWS):
        at = {int(s): float(draw.integers(1, 4)) for s in draw.choice(np.arange(30, SLOTS), 6, replace=False)}
        at |= {7: 1.0} if i % 3 == 0 else {}
        at |= {11: float(i % 5)} if i % 5 else {}
        data.append((i, Vectors.sparse(SLOTS, at), 4.0 * (7 in at) + at.get(11, 0.0)))
    return spark.createDataFrame(data, ["id", "features", "y"]).withMetadata("features", {"ml_attr": {"num_attrs": SLOTS}})


def _forest(trees=12):
    return RandomForestRegressor(labelCol="y", numTrees=trees, maxDepth=6, minInstancesPerNode=5, subsamplingRate=0.8, seed=42)


@pytest.mark.parametrize("group", [100_000, 1_200, 1])
def test_parts_of_trees_hold_what_their_rows_say(spark, tmp_path, group):
    """Below the root, below some nodes, and, with parts too small for any node, level by level to the end."""
    rows = _data(spark)
    filled = rows.agg(F.sum(F.size(forests.filled("features")[0]))).first()[0]
    model = forests.fit_sparse(_forest(), rows, "id", ROWS, filled, 1_500, group)
    model.write().save(str(tmp_path / "nodes"))
    nodes = {(r.treeID, r.id): r for r in spark.read.parquet(str(tmp_path / "nodes/data")).select("treeID", "nodeData.*").collect()}
    assert len({t for t, _ in nodes}) == 12 and len(nodes) > 120
    for (tree, _), r in nodes.items():
        w, wy, wyy = r.impurityStats
        assert r.rawCount == w >= 5 and abs(r.prediction - wy / w) < 1e-9 and abs(r.impurity - (wyy / w - (wy / w) ** 2)) < 1e-9
        if r.leftChild >= 0:
            left, right = nodes[tree, r.leftChild], nodes[tree, r.rightChild]
            assert np.allclose(np.add(left.impurityStats, right.impurityStats), r.impurityStats)
            assert abs(r.gain - (r.impurity - (left.rawCount * left.impurity + right.rawCount * right.impurity) / r.rawCount)) < 1e-9
    # What a node's sums say is what its rows say: the bag is drawn by block, so a tree's root has some 0.8 times the rows.
    assert all(0.6 * ROWS < nodes[t, 0].rawCount < ROWS for t in range(12))
    assert set(np.argsort(model.featureImportances.toArray())[-2:]) == {7, 11}
    again = forests.fit_sparse(_forest(), rows, "id", ROWS, filled, 1_500, group)
    assert again.toDebugString.split("\n")[1:] == model.toDebugString.split("\n")[1:]
    error = F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))
    own = _forest().fit(rows).transform(rows).select(error).first()[0]
    assert abs(model.transform(rows).select(error).first()[0] - own) < 0.3 * own


def test_cells_are_sorted_and_packed_without_being_held_often():
    draw, n = np.random.default_rng(2), 400_000
    bins = forests.Bins([np.array([0.5, 1.5, 2.5])] * 50)
    code, row = draw.integers(0, 200, n), draw.integers(0, 30_000, n)
    code[: n // 2] = 41  # a slot that half of the cells fill
    parts = [(code[i : i + 50_000] << 32) | row[i : i + 50_000] for i in range(0, n, 50_000)]
    tracemalloc.start()
    codes, rows = forests._sorted_cells(parts)
    block = forests.Block(0, np.zeros(30_000), bins)
    for first, last, part in forests.Block.cuts(codes, bins, 60_000):
        packed = forests.shrink(codes[part], rows[part])
        block.add(first, last, *forests.stretch(*packed))
        assert len(packed[2]) < 4 * (part.stop - part.start)
    assert tracemalloc.get_traced_memory()[1] < 36 * n
    tracemalloc.stop()
    order = np.lexsort((row, code))
    assert (codes == code[order]).all() and (rows == row[order]).all()
    assert sum(len(p[3]) for p in block.pieces) == n and block.cells().tolist() == np.bincount(row, minlength=30_000).tolist()
    for slot in range(50):
        assert (block.column(slot)[1] == np.sort(code[code // 4 == slot])).all()


def test_rows_of_a_fit_are_let_go_before_trees_grow(spark, monkeypatch):
    seen, grown = [], forests.as_model
    wide = [F.when((F.col("id") * 7 + i) % 97 == 0, F.lit(1.0 + i % 3)).otherwise(0.0).alias(f"c{i}") for i in range(SLOTS)]
    rows = _data(spark).select("id", "y", *wide)
    spark.catalog.clearCache()
    monkeypatch.setattr(forests, "as_model", lambda *args: seen.append(len(spark.sparkContext._jsc.getPersistentRDDs())) or grown(*args))
    names = [f"c{i}" for i in range(SLOTS)]
    model = models.fit([VectorAssembler(inputCols=names, outputCol="features"), _forest(4)], rows, "id", ["features", "y"])
    assert seen == [0] and model.stages[-1].getNumTrees == 4


def test_shuffles_of_many_rows_are_released_after_counting_and_after_the_fit(spark, monkeypatch):
    released = []
    monkeypatch.setattr(models, "release", lambda _: released.append(len(spark.sparkContext._jsc.getPersistentRDDs())))
    spark.catalog.clearCache()
    rows = spark.range(100).select("id", F.lit(1.0).alias("a"))
    models.fit([VectorAssembler(inputCols=["a"], outputCol="features")], rows, "id", rows_per_task=200)
    assert released == []
    models.fit([VectorAssembler(inputCols=["a"], outputCol="features")], rows, "id", rows_per_task=10)
    assert released == [0, 0]
