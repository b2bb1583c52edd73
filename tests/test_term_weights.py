"""Weights of terms: what is shuffled, and rows that share a key."""

import math

from pyspark.sql import functions as F

from agorascope.operators import models


def test_terms_are_counted_where_texts_lie(spark):
    texts = spark.range(200).select("id", F.concat_ws(" ", F.lit("same word"), F.col("id").cast("string")).alias("text"))
    plan = models.term_weights(texts)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" in plan
    # No counts by key and term are shuffled, and none are sorted for the join.
    assert not any("hashpartitioning(id" in line and "term" in line for line in plan.splitlines())
    assert "SortMergeJoin" not in plan and "Sort [" not in plan


def test_rows_of_one_key_are_one_text(spark, rows):
    texts = spark.createDataFrame([(1, "a b"), (1, "A c"), (2, "a"), (None, "b"), (None, "b"), (3, None)], "id int, text string")
    found = {(r.id, r.term): (r.n, round(r.weight, 6)) for r in models.term_weights(texts).collect()}
    of = lambda n, documents: (n, round(n * math.log(7 / (documents + 1)), 6) if documents > 1 else 0.0)
    assert found == {(1, "a"): of(2, 2), (1, "b"): of(1, 2), (1, "c"): of(1, 1), (2, "a"): of(1, 2), (None, "b"): of(2, 2)}
