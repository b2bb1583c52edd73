"""Totals that have to agree between result tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def q(spark):
    return lambda name: entry.queries()[name](spark, FOLDER)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_hours_and_months_cover_the_same_rows(q):
    totals = {total(q(n), "post_count") for n in ("hourly_by_community", "hourly_overall", "ymdow_by_community", "ymdow_overall")}
    assert totals == {10000}


def test_community_and_month_tables_sum_to_the_summary(q):
    summary = total(q("dataset_summary"), "total_rows")
    assert summary == total(q("community_statistics"), "total_rows") == total(q("temporal_distribution"), "total_rows")


def test_depth_tables_partition_the_posts(q):
    names = ("depth_by_hour", "depth_by_dow", "depth_by_score_bin", "depth_by_title_bin", "depth_by_content_type")
    assert {total(q(n), "num_posts") for n in names} == {1000}


def test_rmse_by_community_adds_up(q):
    row = q("rmse_by_community").agg(F.sqrt(F.sum(F.col("mse") * F.col("n_samples")) / F.sum("n_samples"))).first()
    assert row[0] == pytest.approx(q("regression_metrics").first()["rmse"], abs=1e-5)


def test_emotion_table_agrees_with_mentions_and_pain(q):
    mentions = {r["feature"]: r["mentions"] for r in q("feature_mentions").collect()}
    pain = {r["feature"]: r["estimated_negative_mentions"] for r in q("feature_pain_emotions").collect()}
    for r in q("feature_emotions").collect():
        assert r["total_comments"] == mentions[r["feature"]]
        assert sum(r[e] for e in ("anger", "disgust", "fear", "sadness", "negative")) == pain.get(r["feature"], 0)


def test_correlation_matrix_is_symmetric(q):
    cells = {(r[0], r[1]): r[2] for r in q("feature_correlation").collect()}
    assert all(cells[(b, a)] == value for (a, b), value in cells.items())
    assert all(value == 1 for (a, b), value in cells.items() if a == b)


def test_brand_sentiments_sum_to_brand_rows(q):
    posts = {r["brand"]: r["total_posts"] for r in q("brand_volume_engagement").collect()}
    for r in q("sentiment_by_brand").collect():
        assert r["negative"] + r["neutral"] + r["positive"] == posts[r["brand"]]
