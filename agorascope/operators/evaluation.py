"""Labels and model metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import percent
from .curves import curve_areas
from .skew import ranked_histogram


def viral_label(df: DataFrame, score: str = "log_score", share: float = 0.10, out: str = "is_viral") -> DataFrame:
    """1 for rows whose percent rank by descending score is at most ``share``, else 0.

    The percent rank falls with the score, so the label is a comparison with one threshold: the
    lowest score that still ranks high enough. It is found on counts per distinct score; the
    rows themselves are neither sorted nor joined. Ties share the rank of the first.
    """
    nulls = df.agg(F.count_if(F.col(score).isNull())).scalar()
    ranked = ranked_histogram(df, score, descending=True)
    rank = F.coalesce(F.try_divide(F.col("before").cast("double"), F.col("total") + nulls - 1), F.lit(0.0))
    threshold = ranked.where(rank <= share).agg(F.min(score)).scalar()
    return df.withColumn(out, F.when(F.col(score) >= threshold, 1).otherwise(0))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("pct", percent(F.col("n_rows"), counted.agg(F.sum("n_rows")).scalar()))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """R squared, RMSE and MAE in one pass."""
    error = F.col(prediction) - F.col(label)
    sums = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("variance"),
    )
    return sums.select(
        "n",
        (1 - F.try_divide(F.col("mse"), F.col("variance"))).alias("r2"),
        F.sqrt("mse").alias("rmse"),
        "mae",
    )


def rmse_by(df: DataFrame, key: str, label: str, prediction: str) -> DataFrame:
    error = F.col(prediction) - F.col(label)
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.avg(error * error).alias("mse"),
        F.avg(label).alias("avg_true"),
        F.avg(prediction).alias("avg_pred"),
    ).withColumn("rmse", F.sqrt("mse"))


def compare_models(df: DataFrame, label: str, first: str, second: str) -> DataFrame:
    """Metrics of two predictions on the same rows, in one pass, and the second minus the first."""
    complete = df.where(F.col(label).isNotNull() & F.col(first).isNotNull() & F.col(second).isNotNull())
    measures = [F.var_pop(label).alias("variance")]
    for i, prediction in enumerate((first, second), start=1):
        error = F.col(prediction) - F.col(label)
        measures += [F.avg(error * error).alias(f"mse_{i}"), F.avg(F.abs(error)).alias(f"mae_{i}")]
    scored = complete.agg(*measures)
    for i in (1, 2):
        scored = scored.withColumns({
            f"r2_{i}": 1 - F.try_divide(F.col(f"mse_{i}"), F.col("variance")), f"rmse_{i}": F.sqrt(f"mse_{i}"),
        })
    rows = ", ".join(f"'{m}', {m}_1, {m}_2" for m in ("r2", "rmse", "mae"))
    both = scored.select(F.expr(f"stack(3, {rows}) as (metric, model_1, model_2)"))
    return both.withColumn("delta", F.col("model_2") - F.col("model_1"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence[int]) -> DataFrame:
    """Rows by label, one zero-filled column per predicted class."""
    return df.groupBy(label).agg(*[F.count_if(F.col(prediction) == c).alias(f"predicted_{c}") for c in classes])


def _class_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class: true positives, predicted rows and labelled rows, from the pair counts."""
    pairs = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select("n", "l", "p", F.explode(F.array("l", "p")).alias("class"), ).distinct()
    return sides.groupBy("class").agg(
        F.sum(F.when((F.col("l") == F.col("class")) & (F.col("p") == F.col("class")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("p") == F.col("class"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("l") == F.col("class"), F.col("n")).otherwise(0)).alias("support"),
    )


def per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class; an empty denominator gives 0."""
    zero = F.lit(0.0)
    counts = _class_counts(df, label, prediction)
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), zero)
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), zero)
    scored = counts.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    return scored.withColumn("f1", f1).withColumn("class", F.col("class").cast("string"))


def averages(classes: DataFrame) -> DataFrame:
    """Accuracy with macro and support-weighted means of the class scores, one row."""
    weight = F.sum("support")
    weighted = [F.try_divide(F.sum(F.col(m) * F.col("support")), weight).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")]
    macro = [F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")]
    return classes.agg(
        F.try_divide(F.sum("tp"), weight).alias("accuracy"),
        F.try_divide(F.max("support"), weight).alias("majority_rate"),
        *macro, *weighted, weight.alias("support"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str, score: str | None = None) -> DataFrame:
    """Accuracy, weighted precision, recall and F1, with the majority rate to compare against.

    With the ``score`` of a binary classifier (higher for label 1), the exact areas under the ROC
    and the precision-recall curve too.
    """
    metrics = averages(per_class(df, label, prediction)).select(
        "accuracy", "majority_rate", "weighted_precision", "weighted_recall", "weighted_f1", "support"
    )
    if score is None:
        return metrics
    areas = curve_areas(df, label, score)
    return metrics.withColumns({area: areas.select(area).scalar() for area in ("auc_roc", "auc_pr")})


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per class, then accuracy, macro and weighted averages."""
    classes = per_class(df, label, prediction)
    means = averages(classes)
    body = classes.select("class", "precision", "recall", "f1", "support")

    def line(name: str, p: str, r: str, f: str) -> DataFrame:
        return means.select(F.lit(name).alias("class"), F.col(p).alias("precision"), F.col(r).alias("recall"), F.col(f).alias("f1"), "support")

    return (
        body.unionByName(line("accuracy", "accuracy", "accuracy", "accuracy"))
        .unionByName(line("macro avg", "macro_precision", "macro_recall", "macro_f1"))
        .unionByName(line("weighted avg", "weighted_precision", "weighted_recall", "weighted_f1"))
    )


def class_distribution(df: DataFrame, label: str, train: str) -> DataFrame:
    """Rows and percentage of each class in all rows and in the two parts named by the boolean
    column ``train``."""
    counted = df.groupBy(label, train).agg(F.count(F.lit(1)).alias("n"))
    part = F.explode(F.array(F.lit("all"), F.when(F.col(train), "train").otherwise("test"))).alias("part")
    summed = counted.select(label, "n", part).groupBy("part", label).agg(F.sum("n").alias("n_rows"))
    return summed.withColumn("pct", percent(F.col("n_rows"), F.sum("n_rows").over(Window.partitionBy("part"))))
