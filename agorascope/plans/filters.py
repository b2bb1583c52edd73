"""Projections, filters, text assembly and time derivation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx, time as tm
from ..operators import activity as act, hygiene, resampling
from . import bindings as b
from .registry import query
from .sqltext import has_any, key_fraction, normalized, utc

FOCUS, MIXED = ["src0", "src1", "src2"], ["src3", "src4", "src5", "src6", "src7"]
TERMS = ["license", "copyright", "great"]


@query("filter_communities", b.with_ctes(b.ACTIVITY) + """
SELECT id, author, community, round(score, 6) AS score FROM activity WHERE community IN ('view', 'click')""")
def filter_communities(spark, folder):
    kept = hygiene.in_communities(b.activity(spark, folder), ["view", "click", "Signup"])
    return b.rounded(kept.select("id", "author", "community", "score"))


@query("filter_communities_ci", b.with_ctes(b.POSTS) + """
SELECT id, lower(community) AS community, score FROM posts WHERE lower(community) IN ('1-urgent', '5-low')""")
def filter_communities_ci(spark, folder):
    kept = hygiene.in_communities_ci(b.posts(spark, folder), ["1-Urgent", "5-LOW", "3-medium"], ["3-MEDIUM"])
    return kept.select("id", "community", "score")


@query("clean_comments", b.with_ctes(b.TEXTS) + """
SELECT id, author, lower(body) AS body_lower FROM texts
WHERE body IS NOT NULL AND body NOT IN ('[deleted]', '[removed]') AND author <> 'AutoModerator' AND length(body) > 60""")
def clean_comments(spark, folder):
    return hygiene.clean_comments(b.texts(spark, folder), min_length=60).select("id", "author", "body_lower")


@query("clean_submissions", b.with_ctes(b.TEXTS) + """
SELECT id, title, score FROM texts WHERE title IS NOT NULL AND length(title) > 5 AND score IS NOT NULL AND score >= 0""")
def clean_submissions(spark, folder):
    return hygiene.clean_submissions(b.texts(spark, folder), score="score").select("id", "title", "score")


@query("two_tier_filter", b.with_ctes(b.TEXTS) + f"""
SELECT id, community, title FROM texts
WHERE community IN ('src0', 'src1', 'src2')
   OR (community IN ('src3', 'src4', 'src5', 'src6', 'src7')
       AND ({has_any('lower(title)', TERMS)} OR coalesce({has_any('lower(selftext)', TERMS)}, false)))""")
def two_tier_filter(spark, folder):
    kept = hygiene.two_tier(b.texts(spark, folder), FOCUS, MIXED, TERMS, ["title", "selftext"])
    return kept.select("id", "community", "title")


@query("keyword_match", b.with_ctes(b.TEXTS) + r"""
SELECT id, contains(lower(body), 'c++') OR contains(lower(body), 'license') OR regexp_matches(lower(body), 'th(e|at) an+')
           AS matched,
       regexp_matches(lower(body), '\b(?:the|la)\b') AS matched_word
FROM texts""")
def keyword_match(spark, folder):
    lowered = F.lower("body")
    return b.texts(spark, folder).select(
        "id", tx.mentions(lowered, ["c++", "license", {"re": "th(e|at) an+"}]).alias("matched"),
        tx.mentions(lowered, ["the", "la"], word=True).alias("matched_word"),
    )


@query("assemble_text", b.with_ctes(b.TEXTS) + r"""
SELECT id, concat_ws(' ', title, selftext) AS t_skip, title || ' ' || selftext AS t_propagate,
       CASE WHEN title IS NOT NULL AND selftext IS NOT NULL THEN concat_ws(' ', title, selftext)
            WHEN title IS NOT NULL THEN title WHEN selftext IS NOT NULL THEN selftext ELSE '' END AS t_empty,
       CASE WHEN selftext IS NOT NULL AND selftext <> '' THEN concat_ws(' ', title, selftext) ELSE title END AS t_title,
       lower(regexp_replace(concat_ws(' ', title, selftext), '\s+', ' ', 'g')) AS t_collapse
FROM texts""")
def assemble_text(spark, folder):
    modes = ("skip", "propagate", "empty", "title", "collapse")
    title, body = F.col("title"), F.col("selftext")
    return b.texts(spark, folder).select("id", *[tx.assemble(title, body, m).alias(f"t_{m}") for m in modes])


@query("fill_numeric", """
SELECT o_orderkey, coalesce(TRY_CAST(o_orderpriority AS INTEGER), 0) AS priority,
       coalesce(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 0) AS level,
       coalesce(TRY_CAST(nullif(o_custkey, 1) AS INTEGER), 0) AS customer
FROM orders""")
def fill_numeric(spark, folder):
    raw = b.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("priority"), F.substring("o_orderpriority", 1, 1).alias("level"),
        F.nullif("o_custkey", F.lit(1)).alias("customer"),
    )
    return hygiene.fill_numeric(raw, ["priority", "level", "customer"])


@query("normalize_text", b.with_ctes(b.TEXTS) + f"""
SELECT id, processed_text FROM (SELECT id, {normalized('body')} AS processed_text FROM texts)
WHERE length(processed_text) >= 20""")
def normalize_text(spark, folder):
    return hygiene.normalized_texts(b.texts(spark, folder), "body").select("id", "processed_text")


@query("period_label", b.with_ctes(b.TEXTS) + f"""
SELECT id, strftime(d, '%Y-%m-%d') AS day, CASE WHEN d < DATE '2024-01-01' THEN 'Pre-Launch' ELSE 'Post-Launch' END AS period
FROM (SELECT id, CAST({utc('created_utc')} AS DATE) AS d FROM texts)
WHERE d BETWEEN DATE '2023-08-01' AND DATE '2024-06-30'""")
def period_label(spark, folder):
    dated = b.texts(spark, folder).select("id", F.to_date(tm.epoch_timestamp(F.col("created_utc"))).alias("day"))
    return b.rounded(hygiene.period_rows(dated, "day", "2023-08-01", "2024-06-30", b.LAUNCH_DAY))


@query("sample_rows", b.with_ctes(b.ACTIVITY) + f"""
SELECT id, community FROM activity WHERE {key_fraction('id', 42)} < 0.25""")
def sample_rows(spark, folder):
    return hygiene.sample_rows(b.activity(spark, folder), "id", 0.25).select("id", "community")


@query("exact_sample_rows", b.with_ctes(b.ACTIVITY) + f"""
SELECT id, community FROM activity QUALIFY row_number() OVER (PARTITION BY community ORDER BY {key_fraction('id', 42)}, id) <= 150""")
def exact_sample_rows(spark, folder):
    """Exactly 150 events of each kind."""
    return resampling.exact_sample(b.activity(spark, folder).select("id", "community"), "id", 150, ["community"])


@query("split_train_test", b.with_ctes(b.POSTS) + f"""
SELECT id, CASE WHEN {key_fraction('id', 42)} < 0.8 THEN 'train' ELSE 'test' END AS part FROM posts""")
def split_train_test(spark, folder):
    train, test = hygiene.split_rows(b.posts(spark, folder).select("id"), "id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("unified_texts", b.with_ctes(b.TEXTS, b.THREADS) + """
SELECT id, body AS text, 'comment' AS source FROM texts
UNION ALL SELECT id, body, 'comment' FROM thread_comments
UNION ALL SELECT id, concat_ws(' ', title, selftext), 'submission' FROM thread_posts""")
def unified_texts(spark, folder):
    return hygiene.unify(b.all_comments(spark, folder), b.thread_posts(spark, folder), keep=["id"])


@query("filter_funnel", b.with_ctes(b.TEXTS) + """,
counted AS (SELECT count(*) AS s0, count(*) FILTER (a) AS s1, count(*) FILTER (a AND b) AS s2,
                   count(*) FILTER (a AND b AND c) AS s3, count(*) FILTER (a AND b AND c AND d) AS s4
  FROM (SELECT body IS NOT NULL AS a, body NOT IN ('[deleted]', '[removed]') AS b, author <> 'AutoModerator' AS c,
               length(body) > 200 AS d FROM texts))
SELECT stage, name, n_rows, round(100.0 * n_rows / s0, 6) AS retained_pct FROM (
  SELECT 0 AS stage, 'all' AS name, s0 AS n_rows, s0 FROM counted
  UNION ALL SELECT 1, 'has_body', s1, s0 FROM counted UNION ALL SELECT 2, 'not_gone', s2, s0 FROM counted
  UNION ALL SELECT 3, 'not_moderator', s3, s0 FROM counted UNION ALL SELECT 4, 'long_enough', s4, s0 FROM counted)""")
def filter_funnel(spark, folder):
    return b.rounded(hygiene.funnel(b.texts(spark, folder), hygiene.comment_rules(min_length=200)))


@query("epoch_to_ts", b.with_ctes(b.TEXTS) + f"""
SELECT id, strftime({utc('created_utc')}, '%Y-%m-%d %H:%M:%S') AS created_ts FROM texts WHERE NOT (score < 0)""")
def epoch_to_ts(spark, folder):
    """Seconds, milliseconds and missing values in one column."""
    epoch = F.when(F.col("score") < 0, None).when(F.col("over_18"), F.col("created_utc") * 1000).otherwise(F.col("created_utc"))
    stamped = b.texts(spark, folder).select("id", tm.epoch_timestamp(epoch).alias("created_ts"))
    return b.rounded(stamped.dropna(subset=["created_ts"]))


@query("time_buckets", b.with_ctes(b.ACTIVITY) + """
SELECT id, CAST(hour(created) AS INTEGER) AS hour, CAST(dayofweek(created) + 1 AS INTEGER) AS dow,
       CAST(month(created) AS INTEGER) AS mon, CAST(year(created) AS INTEGER) AS yr FROM activity""")
def time_buckets(spark, folder):
    return act.with_buckets(b.activity(spark, folder), "created").select("id", "hour", "dow", "mon", "yr")


@query("month_keys", b.with_ctes(b.POSTS) + """
SELECT id, CAST(year(date) * 100 + month(date) AS INTEGER) AS yyyymm, strftime(date, '%Y-%m') AS year_month FROM posts""")
def month_keys(spark, folder):
    day = F.col("date")
    return b.posts(spark, folder).select("id", tm.month_number(day).alias("yyyymm"), tm.month_text(day).alias("year_month"))
