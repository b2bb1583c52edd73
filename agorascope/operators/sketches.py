"""Distinct counts and audience overlap over any period, from stored sketches.

A row of the stored table has the sketches of one month and community. Sketches unite, so a new month
costs that month's rows alone, and counts over any months and communities read no row of the activity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.binding import named
from ..functions.time import month_text

#: Base-2 logarithms of the sizes: of distinct-count sketches (4096 registers), and of overlap sketches (8192 hashes).
COUNT_SIZE, OVERLAP_SIZE = 12, 13


def count_error(size: int = COUNT_SIZE) -> float:
    """Relative standard error of a distinct count; a merged one is a little wider than that of one sketch."""
    return 1.04 / 2 ** (size / 2)


def overlap_error(size: int = OVERLAP_SIZE) -> float:
    """Standard error of an overlap, as a share of the two communities' united audience."""
    return 1 / 2 ** (size / 2)


def monthly_sketches(
    activity: DataFrame, created: str = "created", community: str = "community", author: str = "author",
    size: int = COUNT_SIZE, overlap_size: int = OVERLAP_SIZE,
) -> DataFrame:
    """``month, community, n_rows, authors, audience``: counts and sketches, combined before the shuffle.

    Null authors don't count; null communities are one of their own, and rows without a time have month null.
    """
    who = named(author).cast("string")
    return activity.groupBy(month_text(named(created)).alias("month"), named(community).alias("community")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(who, size).alias("authors"), F.theta_sketch_agg(who, overlap_size).alias("audience")
    )


def write_months(sketches: DataFrame, path: str) -> None:
    """Write or replace the months that ``sketches`` has, and leave all others as they are."""
    sketches.write.mode("overwrite").partitionBy("month").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_months(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The stored sketches from month ``first`` to ``last``; other months' files aren't read."""
    found = spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    if first is not None:
        found = found.where(F.col("month") >= first)
    return found if last is None else found.where(F.col("month") <= last)


def unique_authors(sketches: DataFrame, by: Sequence[str] = ("community",)) -> DataFrame:
    """``by``, ``n_rows`` and the estimated ``unique_authors`` over all months given."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("authors")).alias("unique_authors"))


def audiences(sketches: DataFrame, size: int = OVERLAP_SIZE) -> DataFrame:
    """``community, audience, authors``: one sketch and its estimate over all months given."""
    united = sketches.where(F.col("community").isNotNull()).groupBy("community").agg(F.theta_union_agg("audience", size).alias("audience"))
    return united.withColumn("authors", F.theta_sketch_estimate("audience"))


def overlapping_communities(sketches: DataFrame, least: int, size: int = OVERLAP_SIZE, bands: int = 32) -> DataFrame:
    """``first, second, shared``: pairs of communities with an estimated ``least`` shared authors or more.

    Only communities with so many authors can be in such a pair, so all others are dropped before pairs are made;
    the rest meet in ``bands`` x ``bands`` blocks, and what is compared are sketches of a fixed size, whatever the number of authors.
    """
    large = audiences(sketches, size).where(F.col("authors") >= least).select("community", "audience")
    band = F.pmod(F.xxhash64("community"), F.lit(bands)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))
    left = large.select(F.col("community").alias("first"), F.col("audience").alias("one"), band.alias("row"), every.alias("column"))
    right = large.select(F.col("community").alias("second"), F.col("audience").alias("other"), band.alias("column"), every.alias("row"))
    pairs = left.join(right, ["row", "column"]).where(F.col("first") < F.col("second"))
    shared: Column = F.theta_sketch_estimate(F.theta_intersection("one", "other"))
    return pairs.select("first", "second", shared.alias("shared")).where(F.col("shared") >= least)
