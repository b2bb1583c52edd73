"""Engagement per community."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.binding import as_rows, named
from ..functions.numeric import percent
from .skew import grouped_median


def engagement_metrics(
    posts: DataFrame, brand_communities: Sequence[str], community: str = "community", day: str = "date",
    types: tuple[str, str] = ("Brand", "General"), excluded: Sequence[str] = (),
) -> DataFrame:
    """Score and comment statistics, volume, distinct authors but the ``excluded`` ones, and pace per community.

    Expects ``score``, ``num_comments``, ``author``, ``id`` and a date column. The exact medians
    come from a second, column-pruned pass that counts values before ordering them.
    """
    def stats(c: str) -> list:
        return [F.avg(c).alias(f"{c}_mean"), F.stddev(c).alias(f"{c}_std"), F.sum(c).alias(f"{c}_sum")]

    main = posts.groupBy(community).agg(
        *stats("score"),
        *stats("num_comments"),
        F.count("id").alias("total_posts"),
        F.count_distinct(F.when(~F.col("author").cast("string").isin(list(excluded)), F.col("author")) if excluded else F.col("author")).alias("unique_authors"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
    )
    medians = grouped_median(posts, [community], ["score", "num_comments"])
    is_brand = F.col(community).isin(list(brand_communities))
    return (
        main.join(medians, community, "left")
        .withColumn("days", F.datediff("max_date", "min_date") + 1)
        .withColumn("posts_per_day", F.col("total_posts") / F.col("days"))
        .withColumn("type", F.when(is_brand, types[0]).otherwise(types[1]))
        .withColumn("total_activity", F.col("total_posts") + F.col("num_comments_sum"))
    )


def by_type(metrics: DataFrame) -> DataFrame:
    """Mean of the community means per type, with the number and share of communities."""
    grouped = metrics.groupBy("type").agg(
        F.avg("score_mean").alias("score_mean"),
        F.avg("num_comments_mean").alias("num_comments_mean"),
        F.avg("posts_per_day").alias("posts_per_day"),
        F.count(F.lit(1)).alias("communities"),
    )
    return grouped.withColumn(
        "community_pct", percent(F.col("communities"), F.sum("communities").over(Window.partitionBy()))
    )


RANKED = ("score_mean", "score_median", "num_comments_mean", "posts_per_day", "total_activity")


def rankings(metrics: DataFrame, k: int = 10, ranked: Sequence[str] = RANKED, community: str = "community") -> DataFrame:
    """The k leading communities per metric, ties by name."""
    long = metrics.select(community, as_rows(("metric", "value"), [(F.lit(m), named(m).cast("double")) for m in ranked]))
    order = Window.partitionBy("metric").orderBy(F.desc("value"), community)
    return long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def score_distribution(posts: DataFrame) -> DataFrame:
    """Mean, median, deviation and extremes of score and comments over all posts, one row."""
    def stats(c: str, name: str) -> list:
        return [
            F.avg(c).alias(f"mean_{name}"), F.stddev(c).alias(f"std_{name}"),
            F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"),
        ]

    medians = grouped_median(posts, [], ["score", "num_comments"])
    both = medians.select(F.struct("*")).scalar()
    main = posts.agg(*stats("score", "score"), *stats("num_comments", "comments"))
    return main.withColumns({
        "median_score": both.getField("score_median"), "median_comments": both.getField("num_comments_median"),
    })


def multi_community_users(activity: DataFrame, excluded: Sequence[str] = ("[deleted]",), community: str = "community") -> DataFrame:
    """Communities per author. Rows collapse to (author, community) before authors are grouped."""
    kept = activity.where(~F.col("author").cast("string").isin(list(excluded)))
    return kept.groupBy("author").agg(F.count_distinct(community).alias("num_communities"))


def user_counts(participation: DataFrame) -> DataFrame:
    return participation.agg(
        F.count(F.lit(1)).alias("unique_users"),
        F.count_if(F.col("num_communities") > 1).alias("multi_community_users"),
    )


def summary(metrics: DataFrame, distribution: DataFrame, users: DataFrame, community: str = "community") -> DataFrame:
    """The headline figures as metric and value, both text. Each of the three tables is computed
    once: the community table in one aggregate, the one-row tables as whole-row subqueries."""
    def leader(by: str):
        """The community leading ``by``, ties to the first name."""
        return F.min(F.struct((-F.round(by, 6)).alias("below"), F.col(community).alias("name"))).alias(f"top_{by}")

    spread = distribution.select(F.struct("*")).scalar()
    people = users.select(F.struct("*")).scalar()
    figures = metrics.agg(
        F.count(F.lit(1)).alias("communities"),
        F.sum("total_posts").alias("posts"),
        F.sum("num_comments_sum").alias("comments"),
        leader("score_mean"),
        leader("num_comments_median"),
    ).withColumn("spread", spread).withColumn("people", people)

    def led(by: str, digits: int) -> str:
        return f"format_string('%s (%.{digits}f)', top_{by}.name, -top_{by}.below)"

    values = {
        "Total Communities": "string(communities)",
        "Total Posts": "string(posts)",
        "num_comments_sum": "string(comments)",
        "Unique Users": "string(people.unique_users)",
        "Multi-Community Users": "string(people.multi_community_users)",
        "Overall Mean Score": "format_string('%.2f', spread.mean_score)",
        "Overall Median Score": "format_string('%.2f', spread.median_score)",
        "Overall Mean Comments": "format_string('%.2f', spread.mean_comments)",
        "Overall Median Comments": "format_string('%.2f', spread.median_comments)",
        "Top Community (Mean Score)": led("score_mean", 2),
        "Top Community (Median Comments)": led("num_comments_median", 1),
    }
    pairs = ", ".join(f"'{label}', {value}" for label, value in values.items())
    return figures.select(F.expr(f"stack({len(values)}, {pairs}) as (metric, value)"))
