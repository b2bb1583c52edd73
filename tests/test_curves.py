"""Areas under curves against plain counts over all rows."""

import random

import pytest
from agorascope.operators import curves, evaluation as ev, models
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors


def brute(rows: list[tuple]) -> tuple:
    """The share of pairs in the right order, ties half, and the trapezoids of precision over recall."""
    rows = [(y, s) for y, s in rows if y is not None and s is not None]
    up, down = [s for y, s in rows if y == 1], [s for y, s in rows if y != 1]
    if not up or not down:
        return None, None
    roc = sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))
    points = []
    for cut in sorted({s for _, s in rows}, reverse=True):
        tp, fp = sum(s >= cut for s in up), sum(s >= cut for s in down)
        points.append((tp / len(up), tp / (tp + fp)))
    points.insert(0, (0.0, points[0][1]))
    return roc, sum((r1 - r0) * (p0 + p1) / 2 for (r0, p0), (r1, p1) in zip(points, points[1:]))


@pytest.mark.parametrize("case", ["many", "ties", "one score", "perfect", "wrong", "no positives", "no negatives", "none", "nulls"])
def test_areas_by_brute_force(spark, case):
    r = random.Random(1)
    rows = {
        "many": [(int(r.random() < 0.3), r.gauss(0, 1)) for _ in range(1500)],
        "ties": [(r.randint(0, 1), float(r.randint(0, 5))) for _ in range(400)],
        "one score": [(1, 0.5), (0, 0.5), (0, 0.5)],
        "perfect": [(1, 2.0), (1, 3.0), (0, 1.0)],
        "wrong": [(0, 2.0), (0, 3.0), (1, 1.0)],
        "no positives": [(0, 1.0), (0, 2.0)],
        "no negatives": [(1, 1.0), (1, 2.0)],
        "none": [],
        "nulls": [(None, 1.0), (1, None), (1, 0.9), (0, 0.1), (1, 0.05)],
    }[case]
    got = curves.curve_areas(spark.createDataFrame(rows, "label int, score double"), "label", "score").first()
    roc, pr = brute(rows)
    assert got.auc_roc == (None if roc is None else pytest.approx(roc)) and got.auc_pr == (None if pr is None else pytest.approx(pr))


def test_points_are_counts_by_score(spark):
    rows = [(1, 3.0), (0, 3.0), (1, 2.0), (0, 1.0), (0, 1.0)]
    points = curves.curve_points(spark.createDataFrame(rows, "label int, score double"), "label", "score").collect()
    found = {p.score: (p.positives, p.negatives, p.positives_before, p.negatives_before, p.positives_total, p.negatives_total) for p in points}
    assert found == {3.0: (1, 1, 0, 0, 2, 3), 2.0: (1, 0, 1, 1, 2, 3), 1.0: (0, 2, 2, 1, 2, 3)}


def test_areas_agree_with_unbinned_evaluator(spark):
    r = random.Random(2)
    rows = [(float(r.random() < 0.4), Vectors.dense([-s, s]), s, float(s > 0)) for s in (r.gauss(0, 1) for _ in range(300))]
    df = spark.createDataFrame(rows, ["label", "rawPrediction", "score", "prediction"])
    report = models.binary_report(df, "label").first()
    for metric, value in (("areaUnderROC", report.auc_roc), ("areaUnderPR", report.auc_pr)):
        assert value == pytest.approx(BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(df))
    plain = ev.classification_metrics(df, "label", "prediction").first().asDict()
    assert {k: report[k] for k in plain} == plain and "auc_roc" not in plain
