"""Volume and score by time and community."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import time as tm
from ..functions.numeric import percent


def with_buckets(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns(tm.bucket_columns(F.col(ts)))


def volume(df: DataFrame, keys: Sequence[str | Column], score: str = "score") -> DataFrame:
    """Rows and mean score per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("post_count"), F.avg(score).alias("avg_score"))


def share_within(counts: DataFrame, group: str, key: str, n: str = "post_count") -> DataFrame:
    """Percentage of each group's rows per key, from a table of counts."""
    collapsed = counts.groupBy(group, key).agg(F.sum(n).alias(n))
    return collapsed.withColumn("pct", percent(F.col(n), F.sum(n).over(Window.partitionBy(group))))


def total_share(df: DataFrame, group: str, n: str = "post_count") -> DataFrame:
    """Rows per group and their percentage of all rows."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias(n))
    return counts.withColumn("pct", percent(F.col(n), counts.agg(F.sum(n)).scalar()))


def mean_volume(counts: DataFrame, keys: Sequence[str], n: str = "post_count") -> DataFrame:
    """Mean of finer-grained counts per key combination."""
    return counts.groupBy(*keys).agg(F.avg(n).alias("mean_count"))


def unique_counts(df: DataFrame, columns: dict[str, str], approximate: bool = False) -> DataFrame:
    """Distinct values of several columns; the approximate form needs no second shuffle."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(name) for name, c in columns.items()])


def dataset_summary(tables: dict[str, DataFrame], day: str = "date") -> DataFrame:
    """Rows and first and last day per table."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.min(day).alias("date_range_start"),
            F.max(day).alias("date_range_end"),
        ).select(F.lit(name).alias("data_type"), "*")
        for name, df in tables.items()
    ]
    whole, *rest = parts
    for part in rest:
        whole = whole.unionByName(part)
    return whole


def community_statistics(comments: DataFrame, posts: DataFrame, community: str = "community", day: str = "date") -> DataFrame:
    """Comments and posts per community with two kinds of mean score and the dates covered.

    ``avg_score`` is the plain mean of the two sides' means, a missing side counting as 0;
    ``weighted_avg_score`` is the mean over all scored rows.
    """
    def side(df: DataFrame, p: str) -> DataFrame:
        return df.groupBy(community).agg(
            F.count(F.lit(1)).alias(f"{p}_n"),
            F.avg("score").alias(f"{p}_avg"),
            F.sum("score").alias(f"{p}_sum"),
            F.count("score").alias(f"{p}_scored"),
            F.min(day).alias(f"{p}_min"),
            F.max(day).alias(f"{p}_max"),
        )

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    return side(comments, "c").join(side(posts, "p"), community, "full_outer").select(
        community,
        zero("c_n").alias("num_comments"),
        zero("p_n").alias("num_submissions"),
        (zero("c_n") + zero("p_n")).alias("total_rows"),
        ((zero("c_avg") + zero("p_avg")) / 2).alias("avg_score"),
        F.try_divide(zero("c_sum") + zero("p_sum"), zero("c_scored") + zero("p_scored")).alias("weighted_avg_score"),
        F.concat(
            F.date_format(F.least("c_min", "p_min"), "yyyy-MM-dd"),
            F.lit(" to "),
            F.date_format(F.greatest("c_max", "p_max"), "yyyy-MM-dd"),
        ).alias("date_range"),
    )


def temporal_distribution(comments: DataFrame, posts: DataFrame, day: str = "date") -> DataFrame:
    """Comments and posts per month."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(tm.month_text(F.col(day)).alias("year_month")).agg(F.count(F.lit(1)).alias(name))

    both = side(comments, "num_comments").join(side(posts, "num_submissions"), "year_month", "full_outer")
    filled = both.fillna(0, subset=["num_comments", "num_submissions"])
    return filled.withColumn("total_rows", F.col("num_comments") + F.col("num_submissions"))


def top_groups(df: DataFrame, group: str, k: int = 10) -> DataFrame:
    """The k largest groups; ties by name."""
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), group).limit(k)


def peak_hours(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.hour(ts).alias("hour")).agg(F.count(F.lit(1)).alias("post_count")).orderBy(F.desc("post_count"), "hour")


def daily_metrics(
    df: DataFrame, ts: str, years: Sequence[int],
    mean: str, largest: str, tail: str, smallest: str, ceiling: str, p: float = 0.95,
) -> DataFrame:
    """Per day of the given years: rows, a mean, a maximum, a percentile, a minimum and a
    rounded-up mean. The years become a range on ``ts`` so that the scan can skip row groups."""
    day = F.to_date(ts)
    spans = [
        (F.col(ts) >= F.lit(f"{y}-01-01").cast("timestamp_ntz")) & (F.col(ts) < F.lit(f"{y + 1}-01-01").cast("timestamp_ntz"))
        for y in years
    ]
    wanted = spans[0]
    for span in spans[1:]:
        wanted = wanted | span
    return (
        df.where(wanted).groupBy(day.alias("date")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(mean).alias(f"avg_{mean}"),
            F.max(largest).alias(f"max_{largest}"),
            F.percentile_approx(tail, p).alias(f"p{int(round(p * 100))}_{tail}"),
            F.min(smallest).alias(f"min_{smallest}"),
            F.ceil(F.avg(ceiling)).alias(f"ceil_avg_{ceiling}"),
        ).orderBy(F.desc("date"))
    )


def monthly_trend(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(tm.month_number(F.col(ts)).alias("yyyymm")).agg(F.count(F.lit(1)).alias("n_rows")).orderBy("yyyymm")
