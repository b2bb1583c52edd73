"""Discussion depth: how post timing and form go with the number of comments."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import bins, label_position, pearson
from ..functions.time import epoch_timestamp
from ..presets import DAY_NAMES, SCORE_BINS, SCORE_EDGES, TITLE_BINS, TITLE_EDGES

LINK_PREFIX = "t3_"


def link_key(post_id: Column) -> Column:
    return F.concat(F.lit(LINK_PREFIX), post_id.cast("string"))


def post_comment_counts(posts: DataFrame, comments: DataFrame, link: str = "link_id") -> DataFrame:
    """Posts with ``actual_comment_count``, 0 where there is none.

    Comments are counted per link before the join, so a post holding most of them meets the
    join as one row. Expects posts to have the link column.
    """
    counts = comments.groupBy(link).agg(F.count(F.lit(1)).alias("actual_comment_count"))
    return posts.join(counts, link, "left").fillna(0, subset=["actual_comment_count"])


def post_features(posts: DataFrame, epoch: str = "created_utc") -> DataFrame:
    """Title length, time parts, body and nsfw flags and the link key."""
    ts = epoch_timestamp(F.col(epoch))
    return posts.withColumns({
        "title_length": F.length("title"),
        "hour_posted": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "has_selftext": F.when(F.length("selftext") > 0, 1).otherwise(0),
        "is_nsfw": F.when(F.col("over_18"), 1).otherwise(0),
        "link_id": link_key(F.col("id")),
    })


def _depth(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_posts"),
        F.avg("actual_comment_count").alias("avg_comments"),
        F.avg("score").alias("avg_score"),
        F.percentile_approx("actual_comment_count", 0.5).alias("median_comments"),
        F.max("actual_comment_count").alias("max_comments"),
    )


def by_hour(df: DataFrame) -> DataFrame:
    return _depth(df, "hour_posted").drop("max_comments").orderBy("hour_posted")


def by_weekday(df: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    named = _depth(df, "day_of_week").drop("max_comments").withColumn("day_name", F.get(names, F.col("day_of_week") - 1))
    return named.orderBy("day_of_week")


def _by_bin(df: DataFrame, name: str, value: Column, edges: list, labels: list[str]) -> DataFrame:
    binned = _depth(df.withColumn(name, bins(value, edges, labels, "missing")), name)
    return binned.withColumn("bin_order", label_position(F.col(name), labels)).orderBy("bin_order")


def by_score_bin(df: DataFrame, edges=SCORE_EDGES, labels=SCORE_BINS) -> DataFrame:
    return _by_bin(df, "score_bin", F.col("score"), edges, labels)


def by_title_bin(df: DataFrame, edges=TITLE_EDGES, labels=TITLE_BINS) -> DataFrame:
    return _by_bin(df, "title_length_bin", F.col("title_length"), edges, labels)


def by_content_type(df: DataFrame) -> DataFrame:
    kind = F.when(F.col("has_selftext") == 1, "Has Text Content").otherwise("Link/Media Only")
    return _depth(df, "has_selftext").drop("max_comments").withColumn("content_type", kind)


CORRELATED = (
    "score", "title_length", "hour_posted", "day_of_week", "has_selftext", "is_nsfw", "actual_comment_count",
)


def correlations(df: DataFrame, columns=CORRELATED) -> DataFrame:
    """Pearson matrix in long form from one aggregate; null where a column is constant.

    The diagonal is 1 for a column that varies and null for a constant one.
    """
    cells = {}
    for a, b in combinations(columns, 2):
        cells[(a, b)] = pearson(F.col(a), F.col(b))
    for a in columns:
        cells[(a, a)] = F.when(F.stddev_pop(a) > 0, 1.0)
    names = {cell: f"c{i}" for i, cell in enumerate(cells)}
    row = df.agg(*[expr.alias(names[cell]) for cell, expr in cells.items()])
    full = [(a, b, names[(a, b)] if (a, b) in names else names[(b, a)]) for a in columns for b in columns]
    pairs = ", ".join(f"'{a}', '{b}', {c}" for a, b, c in full)
    return row.select(F.expr(f"stack({len(full)}, {pairs}) as (feature_a, feature_b, correlation)"))


def depth_summary(df: DataFrame) -> DataFrame:
    """Spread of the comment counts, the hour and weekday with the highest mean, and two
    correlations, as one row. Ties go to the earliest hour or day."""
    def peak(key: str):
        means = df.groupBy(F.col(key).alias("k")).agg(F.avg("actual_comment_count").alias("m"))
        ranked = means.groupBy("m").agg(F.min("k").alias("k"))
        return ranked.agg(F.max_by("k", "m")).scalar()

    names = F.array(*[F.lit(d) for d in DAY_NAMES])
    comments = F.col("actual_comment_count")
    return df.agg(
        F.avg(comments).alias("avg_comments"),
        F.percentile_approx(comments, 0.5).alias("median_comments"),
        F.max(comments).alias("max_comments"),
        F.stddev(comments).alias("std_comments"),
        pearson(F.col("score"), comments).alias("corr_score_comments"),
        pearson(F.col("title_length"), comments).alias("corr_title_comments"),
    ).withColumns({
        "peak_hour": peak("hour_posted"),
        "best_day": F.get(names, peak("day_of_week") - 1),
    })
