"""Texts by the brand they are about."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.binding import add_kept, let
from ..functions.numeric import percent
from .skew import grouped_median

SENTIMENTS = ("negative", "neutral", "positive")


def _all_hits(text: Column, terms: Sequence[tx.Term], word: bool = False) -> Column:
    return reduce(add, [tx.occurrences(text, t, word) for t in terms])


def dominant_brand(lowered: Column, brands: dict[str, Sequence[tx.Term]], word: bool = True) -> Column:
    """The brand with most term occurrences in a text; null without a hit or on a tie."""
    def count(text: Column) -> Column:
        return F.array(*[
            F.struct(_all_hits(text, terms, word).alias("n"), F.lit(name).alias("brand")) for name, terms in brands.items()
        ])

    def pick(all_counts: Column) -> Column:
        most = F.array_max(all_counts)["n"]
        leaders = F.filter(all_counts, lambda c: c["n"] == most)
        return F.when((most > 0) & (F.size(leaders) == 1), leaders[0]["brand"])

    return let(lowered, lambda text: let(count(text), pick))


def list_sentiment(lowered: Column, positive: Sequence[str], negative: Sequence[str], word: bool = False) -> Column:
    """positive, negative or neutral by which list has more words present."""
    def label(c: Column) -> Column:
        return F.when(c["p"] > c["n"], "positive").when(c["n"] > c["p"], "negative").otherwise("neutral")

    def count(text: Column) -> Column:
        return F.struct(
            tx.distinct_term_hits(text, positive, word).alias("p"),
            tx.distinct_term_hits(text, negative, word).alias("n"),
        )

    return let(lowered, lambda text: let(count(text), label))


def branded_texts(
    df: DataFrame, body: str, brands: dict, positive: Sequence[str], negative: Sequence[str],
    stages: Sequence[tuple[str, Sequence[tx.Term]]] = (), default_stage: str = "general discussion", min_length: int = 10,
) -> DataFrame:
    """Texts with a dominant brand, their normalised form, sentiment and journey stage."""
    named = add_kept(df, "brand", dominant_brand(F.lower(body), brands), lambda brand: brand.isNotNull())
    kept = add_kept(named, "processed_text", tx.normalize(F.col(body)), lambda text: F.length(text) >= min_length)
    scored = kept.withColumn("sentiment", list_sentiment(F.col("processed_text"), positive, negative))
    if not stages:
        return scored
    return scored.withColumn("journey_stage", tx.first_match(F.col("processed_text"), stages, default_stage))


def sentiment_by_brand(df: DataFrame) -> DataFrame:
    """Texts and percentage per sentiment and brand, absent classes as 0."""
    counted = df.groupBy("brand").agg(*[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENTS])
    total = F.col("negative") + F.col("neutral") + F.col("positive")
    return counted.withColumns({f"{s}_pct": percent(F.col(s), total) for s in SENTIMENTS})


def posneg_ratio(by_brand: DataFrame) -> DataFrame:
    return by_brand.select(
        "brand",
        F.col("positive").alias("positive_count"),
        F.col("negative").alias("negative_count"),
        F.col("neutral").alias("neutral_count"),
        (F.col("positive") / (F.col("negative") + 1)).alias("pos_neg_ratio"),
    )


def volume_engagement(df: DataFrame, score: str = "score") -> DataFrame:
    main = df.groupBy("brand").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.avg(score).alias("score_mean"),
        F.stddev(score).alias("score_std"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
    )
    return main.join(grouped_median(df, ["brand"], [score]), "brand", "left")


def column_name(term: str) -> str:
    return term.replace(" ", "_").replace("-", "_")


def term_counts(df: DataFrame, terms: Sequence[str], text: str = "processed_text", word: bool = False) -> DataFrame:
    """Occurrences of each term by brand, counted within each text."""
    return df.groupBy("brand").agg(*[
        F.sum(tx.occurrences(F.col(text), t, word)).alias(column_name(t)) for t in terms
    ])


def problem_vs_feature(df: DataFrame, problems: Sequence[str], features: Sequence[str], text: str = "processed_text") -> DataFrame:
    return df.groupBy("brand").agg(
        F.sum(_all_hits(F.col(text), problems)).alias("problems"),
        F.sum(_all_hits(F.col(text), features)).alias("features"),
    )


def text_length(df: DataFrame, body: str) -> DataFrame:
    return df.groupBy("brand").agg(F.avg(F.length(body)).alias("avg_length"))


def stage_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("journey_stage").agg(F.count(F.lit(1)).alias("n_rows"))
