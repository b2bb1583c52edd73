"""Posts joined to their comments, and discussion depth."""

from __future__ import annotations


from ..operators import depth, early
from . import bindings as b
from .registry import query

BASE = b.with_ctes(b.TEXTS, b.DEPTH)
WINDOW = 30 * 86400


@query("post_comment_counts", b.with_ctes(b.POSTS, b.COMMENTS, b.COUNTED_POSTS) + """
SELECT id, link_id, score, num_comments AS actual_comment_count FROM counted""")
def post_comment_counts(spark, folder):
    joined = depth.post_comment_counts(b.posts(spark, folder), b.comments(spark, folder))
    return joined.select("id", "link_id", "score", "actual_comment_count")


EARLY = f"""early AS (
  SELECT p.id, count(c.link_id) AS early_comment_count, coalesce(avg(c.score), 0) AS early_comment_avg_score,
         coalesce(max(c.score), 0) AS early_comment_max_score, coalesce(avg(c.length), 0) AS early_comment_avg_length,
         coalesce(stddev(c.score), 0) AS early_comment_score_std
  FROM posts p LEFT JOIN comments c ON c.link_id = p.link_id
       AND c.created_utc BETWEEN p.created_utc AND p.created_utc + {WINDOW}
  GROUP BY p.id)"""


@query("early_comment_features", b.with_ctes(b.POSTS, b.COMMENTS, EARLY) + """
SELECT id, early_comment_count, round(early_comment_avg_score, 6) AS early_comment_avg_score, early_comment_max_score,
       round(early_comment_avg_length, 6) AS early_comment_avg_length, round(early_comment_score_std, 6) AS early_comment_score_std
FROM early""")
def early_comment_features(spark, folder):
    featured = early.early_comment_features(b.posts(spark, folder), b.comments(spark, folder), WINDOW)
    return b.rounded(featured.select("id", *early.EARLY_DEFAULTS))


@query("post_features", BASE + """
SELECT id, title_length, hour_posted, day_of_week, month, year, has_selftext, is_nsfw, link_id FROM depth""")
def post_features(spark, folder):
    return depth.post_features(b.texts(spark, folder)).select(
        "id", "title_length", "hour_posted", "day_of_week", "month", "year", "has_selftext", "is_nsfw", "link_id"
    )


STATS = """count(*) AS num_posts, round(avg(actual_comment_count), 6) AS avg_comments, round(avg(score), 6) AS avg_score,
  quantile_disc(actual_comment_count, 0.5) AS median_comments"""
DAY = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][day_of_week]"


@query("depth_by_hour", BASE + f"SELECT hour_posted, {STATS} FROM depth GROUP BY 1")
def depth_by_hour(spark, folder):
    return b.rounded(depth.by_hour(b.depth_posts(spark, folder)))


@query("depth_by_dow", BASE + f"SELECT day_of_week, {STATS}, {DAY} AS day_name FROM depth GROUP BY day_of_week")
def depth_by_dow(spark, folder):
    return b.rounded(depth.by_weekday(b.depth_posts(spark, folder)))


@query("depth_by_score_bin", BASE + f""",
binned AS (SELECT *, CASE WHEN score IS NULL THEN 0 WHEN score <= 1 THEN 1 WHEN score <= 5 THEN 2 WHEN score <= 10 THEN 3
  WHEN score <= 25 THEN 4 WHEN score <= 50 THEN 5 WHEN score <= 100 THEN 6 ELSE 7 END AS bin FROM depth)
SELECT CASE WHEN bin = 0 THEN 'missing' ELSE ['<=1', '2-5', '6-10', '11-25', '26-50', '51-100', '100+'][bin] END AS score_bin, {STATS},
       max(actual_comment_count) AS max_comments, bin AS bin_order FROM binned GROUP BY bin""")
def depth_by_score_bin(spark, folder):
    return b.rounded(depth.by_score_bin(b.depth_posts(spark, folder)))


@query("depth_by_title_bin", BASE + f""",
binned AS (SELECT *, CASE WHEN title_length IS NULL THEN 0 WHEN title_length <= 30 THEN 1 WHEN title_length <= 60 THEN 2
  WHEN title_length <= 90 THEN 3 WHEN title_length <= 120 THEN 4 ELSE 5 END AS bin FROM depth)
SELECT CASE WHEN bin = 0 THEN 'missing' ELSE ['0-30', '31-60', '61-90', '91-120', '120+'][bin] END AS title_length_bin, {STATS},
       max(actual_comment_count) AS max_comments, bin AS bin_order FROM binned GROUP BY bin""")
def depth_by_title_bin(spark, folder):
    return b.rounded(depth.by_title_bin(b.depth_posts(spark, folder)))


@query("depth_by_content_type", BASE + f"""
SELECT has_selftext, {STATS}, CASE has_selftext WHEN 1 THEN 'Has Text Content' ELSE 'Link/Media Only' END AS content_type
FROM depth GROUP BY has_selftext""")
def depth_by_content_type(spark, folder):
    return b.rounded(depth.by_content_type(b.depth_posts(spark, folder)))


def _correlation_sql() -> str:
    cells = []
    for x in depth.CORRELATED:
        for y in depth.CORRELATED:
            value = "1.0::DOUBLE" if x == y else f"round(corr({x}, {y}), 6)"
            cells.append(
                f"SELECT '{x}' AS feature_a, '{y}' AS feature_b, "
                f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN {value} END AS correlation FROM depth"
            )
    return BASE + " UNION ALL ".join(cells)


@query("feature_correlation", _correlation_sql())
def feature_correlation(spark, folder):
    return b.rounded(depth.correlations(b.depth_posts(spark, folder)))


@query("depth_summary", BASE + f"""
SELECT round(avg(actual_comment_count), 6) AS avg_comments, quantile_disc(actual_comment_count, 0.5) AS median_comments,
       max(actual_comment_count) AS max_comments, round(stddev(actual_comment_count), 6) AS std_comments,
       round(corr(score, actual_comment_count), 6) AS corr_score_comments,
       round(corr(title_length, actual_comment_count), 6) AS corr_title_comments,
       (SELECT hour_posted FROM depth GROUP BY 1 ORDER BY avg(actual_comment_count) DESC, 1 LIMIT 1) AS peak_hour,
       (SELECT {DAY} FROM depth GROUP BY day_of_week ORDER BY avg(actual_comment_count) DESC, day_of_week LIMIT 1) AS best_day
FROM depth""")
def depth_summary(spark, folder):
    return b.rounded(depth.depth_summary(b.depth_posts(spark, folder)))
