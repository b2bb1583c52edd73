"""What the estimators of a fit get to see."""

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from agorascope.operators import models


class Seen(Model):
    def _transform(self, dataset):
        return dataset


class Look(Estimator):
    """Notes how its input is dealt."""

    def __init__(self):
        super().__init__()
        self.seen = []

    def _fit(self, dataset):
        self.seen.append((dataset.rdd.getNumPartitions(), dataset.columns, dataset.count()))
        return Seen()


def test_fit_deals_rows_to_cores_not_to_shuffle_partitions(spark):
    rows = spark.range(1000).select("id", F.lit("a b").alias("text"), F.lit("x" * 100).alias("body"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        look = Look()
        model = models.fit([Tokenizer(inputCol="text", outputCol="tokens"), look], rows, "id", ["tokens"])
        assert look.seen == [(spark.sparkContext.defaultParallelism, ["id", "tokens"], 1000)]
        assert len(model.stages) == 2 and "tokens" in model.transform(rows).columns
        many = Look()
        models.fit([many], rows, "id", rows_per_task=10)
        assert many.seen == [(100, ["id", "text", "body"], 1000)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
