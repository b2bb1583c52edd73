"""Behaviour of accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

PROFILE_FEATURES = [
    "total_comments", "subreddit_diversity", "active_days", "posting_hour_std", "avg_posting_hour",
    "avg_comment_score", "score_std", "upvoted_comments", "avg_comment_length", "text_length_std",
    "activity_span_days", "comments_per_day", "upvote_rate", "short_comment_rate",
]


def without_authors(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    """Rows of other authors and rows without author."""
    if not excluded:
        return df
    return df.where(F.col("author").isNull() | ~F.col("author").cast("string").isin(list(excluded)))


def user_profiles(
    activity: DataFrame, ts: str = "created", community: str = "community", score: str = "score",
    length: Column | None = None, short: int = 20, upvoted: float = 1, min_rows: int = 1, excluded: Sequence[str] = (),
) -> DataFrame:
    """One row per author, but those ``excluded`` (such as a name that stands for deleted accounts), with 13 aggregates and 4 derived measures.

    The two distinct counts make Spark aggregate by (author, community or day) before it
    aggregates by author, and everything else is combined on the map side, so an account with a
    large share of the rows is not gathered in one task. Deviations of single-row accounts are
    0. ``min_rows`` leaves out accounts with fewer rows.
    """
    length = F.length("body") if length is None else length
    activity = without_authors(activity, excluded)
    rows = activity.select(
        "author", community, F.col(score).alias("__score"), F.to_date(ts).alias("__day"),
        F.hour(ts).alias("__hour"), length.alias("__length"), F.col(ts).alias("__ts"),
    )
    base = rows.groupBy("author").agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.count_distinct(community).alias("subreddit_diversity"),
        F.count_distinct("__day").alias("active_days"),
        F.coalesce(F.stddev("__hour"), F.lit(0.0)).alias("posting_hour_std"),
        F.avg("__hour").alias("avg_posting_hour"),
        F.avg("__score").alias("avg_comment_score"),
        F.coalesce(F.stddev("__score"), F.lit(0.0)).alias("score_std"),
        F.count_if(F.col("__score") > upvoted).alias("upvoted_comments"),
        F.avg("__length").alias("avg_comment_length"),
        F.coalesce(F.stddev("__length"), F.lit(0.0)).alias("text_length_std"),
        F.count_if(F.col("__length") < short).alias("very_short_comments"),
        F.min("__ts").alias("first_comment"),
        F.max("__ts").alias("last_comment"),
    )
    total, span = F.col("total_comments"), F.col("activity_span_days")
    return (
        base.where(total >= min_rows)
        .withColumn("activity_span_days", F.datediff("last_comment", "first_comment"))
        .withColumn("comments_per_day", F.when(span > 0, total / span).otherwise(total.cast("double")))
        .withColumn("upvote_rate", F.col("upvoted_comments") / total)
        .withColumn("short_comment_rate", F.col("very_short_comments") / total)
    )


def label_suspicious(
    profiles: DataFrame, many: float = 100, few_communities: float = 3, short_rate: float = 0.7,
    low_score: float = 2, per_day: float = 20, hour_std: float = 1,
) -> DataFrame:
    """1 for accounts that meet any of four rules, else 0.

    Models trained on these labels and the same profiles relearn the rules; their scores say
    nothing about real abuse. The thresholds are fixed values.
    """
    rule = (
        ((F.col("total_comments") > many) & (F.col("subreddit_diversity") < few_communities))
        | ((F.col("short_comment_rate") > short_rate) & (F.col("avg_comment_score") < low_score))
        | (F.col("comments_per_day") > per_day)
        | (F.col("posting_hour_std") < hour_std)
    )
    return profiles.withColumn("is_suspicious", F.when(rule, 1).otherwise(0))
