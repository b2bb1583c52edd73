"""Audience overlap between communities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def memberships(
    activity: DataFrame, communities: Sequence[str], excluded: Sequence[str] = ("[deleted]",), community: str = "community"
) -> DataFrame:
    """Distinct sets of the listed communities with the number of authors having exactly that set.

    The list bounds a set, whatever an author is active in; it reaches the scan as a pushed filter.

    Rows collapse to (author, community) on the map side, so an author holding a third of all
    rows contributes one row per community. An author's set is bounded by the number of
    communities studied, and all later work runs on the distinct sets, not on the authors.
    """
    pairs = (
        activity.where(F.col(community).isin(list(communities)) & ~F.col("author").cast("string").isin(list(excluded)))
        .select("author", community).distinct()
    )
    sets = pairs.groupBy("author").agg(F.sort_array(F.collect_set(community)).alias("members"))
    return sets.groupBy("members").agg(F.count(F.lit(1)).alias("authors"))


def shared_users(sets: DataFrame) -> DataFrame:
    """Authors active in both of two communities, for every pair that shares one.

    A set of c communities adds its authors to c(c-1)/2 result rows; nothing is paired by author.
    """
    later = F.posexplode("members").alias("at", "sub1")
    first = sets.select("members", "authors", later)
    # slice() starts at 1, posexplode at 0.
    partner = F.explode(F.slice("members", F.col("at") + 2, F.size("members"))).alias("sub2")
    return (
        first.select("sub1", "authors", partner)
        .groupBy("sub1", "sub2").agg(F.sum("authors").alias("shared_users"))
    )


def overlap_matrix(sets: DataFrame) -> DataFrame:
    """The symmetric matrix in long form; the diagonal counts each community's authors."""
    pairs = shared_users(sets)
    mirrored = pairs.select(F.col("sub2").alias("sub1"), F.col("sub1").alias("sub2"), "shared_users")
    diagonal = (
        sets.select(F.explode("members").alias("sub1"), "authors")
        .groupBy("sub1").agg(F.sum("authors").alias("shared_users"))
        .select("sub1", F.col("sub1").alias("sub2"), "shared_users")
    )
    return pairs.unionByName(mirrored).unionByName(diagonal)
