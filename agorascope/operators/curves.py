"""Areas under the curves of a binary classifier, exactly, from counts per distinct score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import running_sums


def curve_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: ``positives`` and ``negatives`` with that score, those with higher ones
    (``positives_before``, ``negatives_before``) and all (``positives_total``, ``negatives_total``).

    Rows are counted per score before anything is ordered, and the running sums are taken in
    parallel ranges of scores. Rows without label or score don't count; label 1 is positive, all
    others are negative.
    """
    kept = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    counted = kept.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )
    return running_sums(counted, "score", ["positives", "negatives"], descending=True)


def curve_areas(df: DataFrame, label: str, score: str) -> DataFrame:
    """``auc_roc`` and ``auc_pr``, one row, by trapezoids between the points of distinct scores.

    Equal scores are one point, so the order of their rows doesn't matter. The curve of precision
    starts at recall 0 with the first point's precision. Null where one class has no rows.
    """
    points = curve_points(df, label, score)
    p, n, p0, n0 = (F.col(c).cast("double") for c in ("positives", "negatives", "positives_before", "negatives_before"))
    precision = (p0 + p) / (p0 + p + n0 + n)
    before = F.coalesce(F.try_divide(p0, p0 + n0), precision)
    sums = points.agg(
        F.sum(n * (p0 + p / 2)).alias("roc"), F.sum(p * (precision + before) / 2).alias("pr"),
        F.max("positives_total").cast("double").alias("p"), F.max("negatives_total").cast("double").alias("n"),
    )
    both = F.col("n") > 0
    return sums.select(
        F.try_divide("roc", F.col("p") * F.col("n")).alias("auc_roc"), F.when(both, F.try_divide("pr", "p")).alias("auc_pr")
    )
