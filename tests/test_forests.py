"""Forests that are fitted in parts."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from agorascope.operators import evaluation, models
from agorascope.plans import modelling


def _rows(spark, n=400):
    return spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 7 > 3).cast("int").alias("y"))


def _stages(forest):
    return [VectorAssembler(inputCols=["a", "b"], outputCol="features"), forest]


def _watch(monkeypatch, kind):
    seen, fit = [], kind._fit

    def watched(self, dataset):
        seen.append((dataset.rdd.getNumPartitions(), self.getNumTrees(), self.getSeed(), dataset.count()))
        return fit(self, dataset)

    monkeypatch.setattr(kind, "_fit", watched)
    return seen


def test_few_rows_have_one_task_and_the_trees_share_the_cores(spark, monkeypatch, tmp_path):
    seen = _watch(monkeypatch, RandomForestRegressor)
    rows = _rows(spark)
    model = models.fit(_stages(RandomForestRegressor(labelCol="y", numTrees=21, maxDepth=3, seed=42)), rows, "id", ["features", "y"])
    cores = spark.sparkContext.defaultParallelism
    assert [s[0] for s in seen] == [1] * min(10, cores + cores // 2) and {s[3] for s in seen} == {400}
    assert sum(s[1] for s in seen) == 21 and min(s[1] for s in seen) >= 2 and len({s[2] for s in seen}) == len(seen)
    forest = model.stages[-1]
    assert forest.getNumTrees == 21 and forest.getMaxDepth() == 3 and forest.numFeatures == 2
    assert abs(sum(forest.featureImportances.toArray()) - 1) < 1e-9
    scored = model.transform(rows).orderBy("id")
    first = scored.first()
    assert abs(first.prediction - sum(t.predict(first.features) for t in forest.trees) / 21) < 1e-9
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(rows).orderBy("id")
    assert [r.prediction for r in again.collect()] == [r.prediction for r in scored.collect()]


def test_parts_of_a_classifier_vote_as_one_forest(spark):
    rows = _rows(spark)
    model = models.fit(_stages(RandomForestClassifier(labelCol="y", numTrees=20, maxDepth=4, seed=42)), rows, "id", ["features", "y"])
    found = model.transform(rows).select("y", "prediction", vector_to_array("rawPrediction").alias("votes")).collect()
    assert all(r.y == r.prediction and abs(sum(r.votes) - 20) < 1e-9 for r in found)


def test_many_cells_are_one_forest_over_more_tasks(spark, monkeypatch):
    seen = _watch(monkeypatch, RandomForestRegressor)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(_rows(spark))
    forest = RandomForestRegressor(labelCol="y", numTrees=4, maxDepth=2, seed=42)
    assert models.fit_forest(forest, rows, "id", 400, cells_per_task=50).getNumTrees == 4
    assert [s[:3] for s in seen] == [(16, 4, 42)]


def test_scored_rows_are_kept_in_as_many_tasks_as_cores(spark, monkeypatch):
    seen, metrics = [], evaluation.classification_metrics
    monkeypatch.setattr(evaluation, "classification_metrics", lambda kept, *args: seen.append(kept.rdd.getNumPartitions()) or metrics(kept, *args))
    rows = _rows(spark)
    scored = models.fit(_stages(RandomForestClassifier(labelCol="y", numTrees=4, maxDepth=4, seed=42)), rows, "id", ["features", "y"]).transform(rows.repartition(50))
    report = models.binary_report(scored, "y").first()
    assert seen == [spark.sparkContext.defaultParallelism] and report.support == 400 and report.auc_roc == 1


def test_viral_label_is_found_without_the_comments(spark, rows, monkeypatch):
    folder, seen = "/root/testdata/sf0.001", []
    label = modelling.ev.viral_label
    monkeypatch.setattr(modelling.ev, "viral_label", lambda df: seen.append(df.columns) or label(df))
    monkeypatch.setattr(models, "viral_classifier", lambda df, **_: (None, df))
    monkeypatch.setattr(models, "binary_report", lambda df, _: df)
    found = modelling.viral_classifier_early(spark, folder)
    assert not any(c.startswith("early_") for c in seen[0])
    late = label(modelling._featured_early(spark, folder))
    columns = ["id", "is_viral", *models.EARLY_NUMBERS]
    assert rows(found, *columns) == rows(late, *columns)
