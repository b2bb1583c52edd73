"""Volume, engagement and overlap of communities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import activity as act, engagement as eng, overlap, sketches
from ..session import scratch_dir
from . import bindings as b
from .registry import query

BUCKETED = """bucketed AS (
  SELECT *, CAST(hour(created) AS INTEGER) AS hour, CAST(dayofweek(created) + 1 AS INTEGER) AS dow,
         CAST(month(created) AS INTEGER) AS mon, CAST(year(created) AS INTEGER) AS yr FROM activity)"""
EXCLUDED = ["error"]
ALL = ["view", "signup", "click", "error", "purchase"]
BASE = b.with_ctes(b.ACTIVITY, BUCKETED)
EVERYWHERE = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "lot-3", "lot-4", "lot-5"]


def _bucketed(spark, folder):
    return act.with_buckets(b.activity(spark, folder), "created")


def _remaining(spark, folder):
    from ..operators.hygiene import in_communities_ci

    return in_communities_ci(_bucketed(spark, folder), ALL, EXCLUDED)


def _volume_sql(keys: str, where: str = "") -> str:
    return BASE + f"SELECT {keys}, count(*) AS post_count, round(avg(score), 6) AS avg_score FROM bucketed {where} GROUP BY {keys}"


@query("hourly_by_community", _volume_sql("community, hour"))
def hourly_by_community(spark, folder):
    return b.rounded(act.volume(_bucketed(spark, folder), ["community", "hour"]).orderBy("community", "hour"))


@query("ymdow_by_community", _volume_sql("community, yr, mon, dow"))
def ymdow_by_community(spark, folder):
    keys = ["community", "yr", "mon", "dow"]
    return b.rounded(act.volume(_bucketed(spark, folder), keys).orderBy(*keys))


@query("hourly_by_community_excl", _volume_sql("community, hour", "WHERE community <> 'error'"))
def hourly_by_community_excl(spark, folder):
    return b.rounded(act.volume(_remaining(spark, folder), ["community", "hour"]).orderBy("community", "hour"))


@query("ymdow_by_community_excl", _volume_sql("community, yr, mon, dow", "WHERE community <> 'error'"))
def ymdow_by_community_excl(spark, folder):
    keys = ["community", "yr", "mon", "dow"]
    return b.rounded(act.volume(_remaining(spark, folder), keys).orderBy(*keys))


@query("hourly_overall", _volume_sql("hour"))
def hourly_overall(spark, folder):
    return b.rounded(act.volume(_bucketed(spark, folder), ["hour"]).orderBy("hour"))


@query("ymdow_overall", _volume_sql("yr, mon, dow"))
def ymdow_overall(spark, folder):
    return b.rounded(act.volume(_bucketed(spark, folder), ["yr", "mon", "dow"]).orderBy("yr", "mon", "dow"))


def _share_sql(key: str) -> str:
    return BASE + f"""
SELECT community, {key}, CAST(n AS BIGINT) AS post_count, round(100.0 * n / sum(n) OVER (PARTITION BY community), 6) AS pct
FROM (SELECT community, {key}, count(*) AS n FROM bucketed GROUP BY 1, 2)"""


@query("share_within_community_hour", _share_sql("hour"))
def share_within_community_hour(spark, folder):
    return b.rounded(act.share_within(act.volume(_bucketed(spark, folder), ["community", "hour"]), "community", "hour"))


@query("share_within_community_dow", _share_sql("dow"))
def share_within_community_dow(spark, folder):
    counts = act.volume(_bucketed(spark, folder), ["community", "yr", "mon", "dow"])
    return b.rounded(act.share_within(counts, "community", "dow"))


@query("community_total_share", b.with_ctes(b.ACTIVITY) + """
SELECT community, count(*) AS post_count, round(100.0 * count(*) / (SELECT count(*) FROM activity), 6) AS pct
FROM activity GROUP BY 1""")
def community_total_share(spark, folder):
    return b.rounded(act.total_share(b.activity(spark, folder), "community"))


@query("mean_volume_by_weekday", BASE + """
SELECT community, dow, round(avg(n), 6) AS mean_count
FROM (SELECT community, yr, mon, dow, count(*) AS n FROM bucketed WHERE community <> 'error' GROUP BY 1, 2, 3, 4) GROUP BY 1, 2""")
def mean_volume_by_weekday(spark, folder):
    counts = act.volume(_remaining(spark, folder), ["community", "yr", "mon", "dow"])
    return b.rounded(act.mean_volume(counts, ["community", "dow"]))


@query("unique_counts", b.with_ctes(b.ACTIVITY) + """
SELECT count(DISTINCT id) AS unique_comments, count(DISTINCT author) AS unique_authors FROM activity""")
def unique_counts(spark, folder):
    return act.unique_counts(b.activity(spark, folder), {"unique_comments": "id", "unique_authors": "author"})


@query("sketched_unique_authors", b.with_ctes(b.ACTIVITY) + """
SELECT community, count(*) AS n_rows, count(DISTINCT author) AS unique_authors, TRUE AS within_error FROM activity GROUP BY 1""")
def sketched_unique_authors(spark, folder):
    """Distinct authors over all months, exactly, and whether stored sketches of the months agree within four standard errors."""
    rows, path = b.activity(spark, folder), scratch_dir(spark, "months")
    sketches.write_months(sketches.monthly_sketches(rows), path)
    found = sketches.unique_authors(sketches.read_months(spark, path)).withColumnRenamed("unique_authors", "estimate")
    exact = rows.groupBy("community").agg(F.count_distinct("author").alias("unique_authors"))
    near = F.abs(F.col("estimate") - F.col("unique_authors")) <= 4 * sketches.count_error() * F.col("unique_authors") + 1
    return found.join(exact, "community").select("community", "n_rows", "unique_authors", near.alias("within_error"))


@query("top_communities", """
SELECT source AS community, count(*) AS count FROM documents GROUP BY 1 ORDER BY count DESC, community LIMIT 10""")
def top_communities(spark, folder):
    return act.top_groups(b.texts(spark, folder), "community")


@query("peak_hours", BASE + "SELECT hour, count(*) AS post_count FROM bucketed GROUP BY 1")
def peak_hours(spark, folder):
    return act.peak_hours(b.activity(spark, folder), "created")


@query("daily_metrics", """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, count(*) AS n_rows, round(avg(l_extendedprice), 6) AS avg_l_extendedprice,
       max(l_discount) AS max_l_discount, quantile_disc(l_quantity, 0.95) AS p95_l_quantity, min(l_tax) AS min_l_tax,
       CAST(ceil(avg(l_linenumber)) AS BIGINT) AS ceil_avg_l_linenumber
FROM lineitem WHERE year(l_shipdate) IN (1996, 1997) GROUP BY 1""")
def daily_metrics(spark, folder):
    return b.rounded(act.daily_metrics(
        b.table(spark, folder, "lineitem"), "l_shipdate", [1996, 1997],
        mean="l_extendedprice", largest="l_discount", tail="l_quantity", smallest="l_tax", ceiling="l_linenumber",
    ))


@query("monthly_trend", b.with_ctes(b.POSTS) + """
SELECT CAST(year(date) * 100 + month(date) AS INTEGER) AS yyyymm, count(*) AS n_rows FROM posts GROUP BY 1""")
def monthly_trend(spark, folder):
    return act.monthly_trend(b.posts(spark, folder), "date")


@query("dataset_summary", b.with_ctes(b.POSTS, b.COMMENTS) + """
SELECT 'comments' AS data_type, count(*) AS total_rows, strftime(min(date), '%Y-%m-%d') AS date_range_start,
       strftime(max(date), '%Y-%m-%d') AS date_range_end FROM comments
UNION ALL SELECT 'submissions', count(*), strftime(min(date), '%Y-%m-%d'), strftime(max(date), '%Y-%m-%d') FROM posts""")
def dataset_summary(spark, folder):
    sides = {"comments": b.comments(spark, folder), "submissions": b.posts(spark, folder)}
    return b.rounded(act.dataset_summary(sides))


@query("community_statistics", b.with_ctes(b.POSTS, b.COMMENTS) + """,
c AS (SELECT community, count(*) AS n, avg(score) AS a, sum(score) AS s, min(date) AS lo, max(date) AS hi FROM comments GROUP BY 1),
p AS (SELECT community, count(*) AS n, avg(score) AS a, sum(score) AS s, min(date) AS lo, max(date) AS hi FROM posts GROUP BY 1)
SELECT community, coalesce(c.n, 0) AS num_comments, coalesce(p.n, 0) AS num_submissions,
       coalesce(c.n, 0) + coalesce(p.n, 0) AS total_rows, round((coalesce(c.a, 0) + coalesce(p.a, 0)) / 2, 6) AS avg_score,
       round((coalesce(c.s, 0) + coalesce(p.s, 0)) / (coalesce(c.n, 0) + coalesce(p.n, 0)), 6) AS weighted_avg_score,
       strftime(least(c.lo, p.lo), '%Y-%m-%d') || ' to ' || strftime(greatest(c.hi, p.hi), '%Y-%m-%d') AS date_range
FROM c FULL OUTER JOIN p USING (community)""")
def community_statistics(spark, folder):
    return b.rounded(act.community_statistics(b.comments(spark, folder), b.posts(spark, folder)).orderBy(F.desc("total_rows")))


@query("temporal_distribution", b.with_ctes(b.POSTS, b.COMMENTS) + """,
c AS (SELECT strftime(date, '%Y-%m') AS year_month, count(*) AS n FROM comments GROUP BY 1),
p AS (SELECT strftime(date, '%Y-%m') AS year_month, count(*) AS n FROM posts GROUP BY 1)
SELECT year_month, coalesce(c.n, 0) AS num_comments, coalesce(p.n, 0) AS num_submissions,
       coalesce(c.n, 0) + coalesce(p.n, 0) AS total_rows
FROM c FULL OUTER JOIN p USING (year_month)""")
def temporal_distribution(spark, folder):
    return act.temporal_distribution(b.comments(spark, folder), b.posts(spark, folder)).orderBy("year_month")


# --- engagement --------------------------------------------------------------------------------

BRANDED = ["1-URGENT", "2-HIGH"]
ENGAGED = b.with_ctes(b.POSTS, b.COMMENTS, b.COUNTED_POSTS) + """,
metrics AS (
  SELECT community, avg(score) AS score_mean, CAST(median(score) AS DOUBLE) AS score_median, stddev(score) AS score_std,
         CAST(sum(score) AS BIGINT) AS score_sum, avg(num_comments) AS num_comments_mean,
         CAST(median(num_comments) AS DOUBLE) AS num_comments_median, stddev(num_comments) AS num_comments_std,
         CAST(sum(num_comments) AS BIGINT) AS num_comments_sum, count(id) AS total_posts,
         count(DISTINCT author) AS unique_authors, min(date) AS min_date, max(date) AS max_date,
         CAST(max(date) - min(date) + 1 AS INTEGER) AS days, count(id) / (max(date) - min(date) + 1) AS posts_per_day,
         CASE WHEN community IN ('1-URGENT', '2-HIGH') THEN 'Brand' ELSE 'General' END AS type,
         CAST(count(id) + sum(num_comments) AS BIGINT) AS total_activity
  FROM counted GROUP BY community)"""
USERS = """, users AS (
  SELECT author, count(DISTINCT community) AS num_communities FROM
    (SELECT author, community FROM posts UNION ALL SELECT author, community FROM comments)
  WHERE CAST(author AS VARCHAR) <> '[deleted]' GROUP BY 1)"""


def _metrics(spark, folder):
    return eng.engagement_metrics(b.counted_posts(spark, folder), BRANDED)


def _everyone(spark, folder):
    sides = [df.select("author", "community") for df in (b.posts(spark, folder), b.comments(spark, folder))]
    return sides[0].unionByName(sides[1])


@query("engagement_metrics", ENGAGED + """
SELECT community, round(score_mean, 6) AS score_mean, score_median, round(score_std, 6) AS score_std, score_sum,
       round(num_comments_mean, 6) AS num_comments_mean, num_comments_median, round(num_comments_std, 6) AS num_comments_std,
       num_comments_sum, total_posts, unique_authors, strftime(min_date, '%Y-%m-%d') AS min_date,
       strftime(max_date, '%Y-%m-%d') AS max_date, days, round(posts_per_day, 6) AS posts_per_day, type, total_activity
FROM metrics""")
def engagement_metrics(spark, folder):
    return b.rounded(_metrics(spark, folder))


@query("engagement_by_type", ENGAGED + """
SELECT type, round(avg(score_mean), 6) AS score_mean, round(avg(num_comments_mean), 6) AS num_comments_mean,
       round(avg(posts_per_day), 6) AS posts_per_day, count(*) AS communities,
       round(100.0 * count(*) / (SELECT count(*) FROM metrics), 6) AS community_pct
FROM metrics GROUP BY type""")
def engagement_by_type(spark, folder):
    return b.rounded(eng.by_type(_metrics(spark, folder)))


@query("engagement_rankings", ENGAGED + """,
long AS (SELECT community, unnest(['score_mean', 'score_median', 'num_comments_mean', 'posts_per_day', 'total_activity']) AS metric,
                unnest([score_mean, score_median, num_comments_mean, posts_per_day, CAST(total_activity AS DOUBLE)]) AS value
         FROM metrics),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY metric ORDER BY value DESC, community) AS INTEGER) AS rank FROM long)
SELECT community, metric, round(value, 6) AS value, rank FROM ranked WHERE rank <= 3""")
def engagement_rankings(spark, folder):
    return b.rounded(eng.rankings(_metrics(spark, folder), 3))


@query("multi_community_users", b.with_ctes(b.POSTS, b.COMMENTS) + USERS + """
SELECT count(*) AS unique_users, count(*) FILTER (num_communities > 1) AS multi_community_users FROM users""")
def multi_community_users(spark, folder):
    return eng.user_counts(eng.multi_community_users(_everyone(spark, folder)))


@query("score_distribution", b.with_ctes(b.POSTS, b.COMMENTS, b.COUNTED_POSTS) + """
SELECT round(avg(score), 6) AS mean_score, CAST(median(score) AS DOUBLE) AS median_score, round(stddev(score), 6) AS std_score,
       min(score) AS min_score, max(score) AS max_score, round(avg(num_comments), 6) AS mean_comments,
       CAST(median(num_comments) AS DOUBLE) AS median_comments, round(stddev(num_comments), 6) AS std_comments,
       min(num_comments) AS min_comments, max(num_comments) AS max_comments
FROM counted""")
def score_distribution(spark, folder):
    return b.rounded(eng.score_distribution(b.counted_posts(spark, folder)))


@query("engagement_summary", ENGAGED + USERS + """
SELECT 'Total Communities' AS metric, CAST(count(*) AS VARCHAR) AS value FROM metrics
UNION ALL SELECT 'Total Posts', CAST(CAST(sum(total_posts) AS BIGINT) AS VARCHAR) FROM metrics
UNION ALL SELECT 'num_comments_sum', CAST(CAST(sum(num_comments_sum) AS BIGINT) AS VARCHAR) FROM metrics
UNION ALL SELECT 'Unique Users', CAST(count(*) AS VARCHAR) FROM users
UNION ALL SELECT 'Multi-Community Users', CAST(count(*) FILTER (num_communities > 1) AS VARCHAR) FROM users
UNION ALL SELECT 'Overall Mean Score', printf('%.2f', avg(score)) FROM counted
UNION ALL SELECT 'Overall Median Score', printf('%.2f', CAST(median(score) AS DOUBLE)) FROM counted
UNION ALL SELECT 'Overall Mean Comments', printf('%.2f', avg(num_comments)) FROM counted
UNION ALL SELECT 'Overall Median Comments', printf('%.2f', CAST(median(num_comments) AS DOUBLE)) FROM counted
UNION ALL SELECT 'Top Community (Mean Score)', v FROM (
  SELECT community || printf(' (%.2f)', score_mean) AS v FROM metrics ORDER BY round(score_mean, 6) DESC, community LIMIT 1)
UNION ALL SELECT 'Top Community (Median Comments)', v FROM (
  SELECT community || printf(' (%.1f)', num_comments_median) AS v FROM metrics ORDER BY num_comments_median DESC, community LIMIT 1)""")
def engagement_summary(spark, folder):
    users = eng.user_counts(eng.multi_community_users(_everyone(spark, folder)))
    return eng.summary(_metrics(spark, folder), eng.score_distribution(b.counted_posts(spark, folder)), users)


PAIRED = b.with_ctes(b.POSTS, b.COMMENTS) + """,
m AS (SELECT DISTINCT author, community FROM
        (SELECT author, community FROM posts UNION ALL SELECT author, community FROM comments)
      WHERE CAST(author AS VARCHAR) <> '[deleted]')"""


@query("user_overlap_pairs", PAIRED + """
SELECT a.community AS sub1, b.community AS sub2, count(*) AS shared_users
FROM m a JOIN m b ON a.author = b.author AND a.community < b.community GROUP BY 1, 2""")
def user_overlap_pairs(spark, folder):
    return overlap.shared_users(overlap.memberships(_everyone(spark, folder), EVERYWHERE)).orderBy(F.desc("shared_users"))


@query("user_overlap_matrix", PAIRED + """
SELECT a.community AS sub1, b.community AS sub2, count(*) AS shared_users
FROM m a JOIN m b ON a.author = b.author GROUP BY 1, 2""")
def user_overlap_matrix(spark, folder):
    return overlap.overlap_matrix(overlap.memberships(_everyone(spark, folder), EVERYWHERE))
