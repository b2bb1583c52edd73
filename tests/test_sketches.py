"""Stored sketches against exact counts."""

import datetime as dt
import random

import pytest
from agorascope.operators import sketches as S
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def activity(spark):
    months = F.array(*[F.lit(dt.datetime(2023, m, 5)) for m in (6, 7, 8)])
    rows = spark.range(60_000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(9000))).alias("author"),
        F.concat(F.lit("c"), F.least(F.col("id") % 7, F.lit(3))).alias("community"), F.get(months, (F.col("id") % 3).cast("int")).alias("created"))
    odd = spark.createDataFrame([(None, "c0", dt.datetime(2023, 6, 1)), ("u1", None, dt.datetime(2023, 6, 1)), ("u1", "c0", None)], "author string, community string, created timestamp")
    return rows.union(odd)


def test_months_unite_within_the_stated_error(spark, activity, tmp_path):
    path = f"{tmp_path}/months"
    S.write_months(S.monthly_sketches(activity), path)
    for first, last in (("2023-06", "2023-06"), ("2023-06", "2023-07"), (None, None)):
        kept = activity.where("created is not null")
        if first:
            kept = kept.where(F.date_format("created", "yyyy-MM").between(first, last))
        found = S.read_months(spark, path, first, last) if first else S.read_months(spark, path).where("month is not null")
        exact = {r[0]: (r[1], r[2]) for r in kept.groupBy("community").agg(F.count("*"), F.count_distinct("author")).collect()}
        for r in S.unique_authors(found).collect():
            assert r.n_rows == exact[r.community][0]
            assert abs(r.unique_authors - exact[r.community][1]) <= 4 * S.count_error() * exact[r.community][1] + 1
        total = S.unique_authors(found, []).first().unique_authors
        assert abs(total - kept.select("author").distinct().count()) <= 4 * S.count_error() * total


def test_a_new_month_leaves_the_others_and_no_row_is_read_again(spark, activity, tmp_path):
    path = f"{tmp_path}/months"
    S.write_months(S.monthly_sketches(activity.where("month(created) < 8")), path)
    before = {r.month: bytes(r.authors) for r in S.read_months(spark, path).where("community = 'c1'").collect()}
    S.write_months(S.monthly_sketches(activity.where("month(created) >= 8")), path)
    after = {r.month: bytes(r.authors) for r in S.read_months(spark, path).where("community = 'c1'").collect()}
    assert set(after) == {"2023-06", "2023-07", "2023-08"} and all(after[m] == before[m] for m in before)
    plan = S.unique_authors(S.read_months(spark, path, "2023-07", "2023-08"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(month" in plan and "Range" not in plan


def test_overlaps_within_the_stated_error(spark, activity):
    months = S.monthly_sketches(activity)
    members = {}
    for r in activity.where("author is not null and community is not null").select("author", "community").distinct().collect():
        members.setdefault(r.community, set()).add(r.author)
    got = {(r.first, r.second): r.shared for r in S.overlapping_communities(months, 100, bands=3).collect()}
    pairs = {(a, b) for a in members for b in members if a < b}
    assert set(got) == {(a, b) for a, b in pairs if len(members[a] & members[b]) >= 100}
    for (a, b), shared in got.items():
        assert abs(shared - len(members[a] & members[b])) <= 4 * S.overlap_error() * len(members[a] | members[b])
    assert S.overlapping_communities(months, 10**6).count() == 0
    size = {r.community: len(r.audience) for r in S.audiences(months).collect()}
    more = activity.union(activity.withColumn("author", F.concat("author", F.lit("x"), F.rand(1).cast("string"))))
    assert all(len(r.audience) <= 8 * 2 ** (S.OVERLAP_SIZE + 1) + 64 for r in S.audiences(S.monthly_sketches(more)).collect()) and size
