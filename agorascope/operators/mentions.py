"""Which texts mention which features and brands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text as tx
from ..functions.binding import add_kept, as_rows
from ..functions.numeric import percent
from ..functions.valence import ValenceLexicon, add_valence, category

Dictionary = dict[str, Sequence[tx.Term]]


def feature_mentions(df: DataFrame, lowered: str, features: Dictionary, word: bool = False) -> DataFrame:
    """Rows mentioning each feature, zero included, in one scan and one aggregate."""
    named = df.select(tx.matched_names(F.col(lowered), features, word).alias("__names"))
    counts = named.agg(*[F.count_if(F.array_contains("__names", name)).alias(f"f{i}") for i, name in enumerate(features)])
    return counts.select(as_rows(("feature", "mentions"), [(F.lit(name), F.col(f"f{i}")) for i, name in enumerate(features)]))


def scored_features(df: DataFrame, text: str, features: Dictionary, lexicon: ValenceLexicon, word: bool = False) -> DataFrame:
    """(feature, sentiment_score) for every mention.

    Texts without a feature are dropped before scoring and the text itself before the
    explosion, so what is multiplied is one short name and one number per mention.
    """
    named = add_kept(df.select(text), "features", tx.matched_names(F.lower(text), features, word), lambda f: F.size(f) > 0)
    scored = add_valence(named, text, lexicon)
    return scored.select(F.explode("features").alias("feature"), "sentiment_score")


def feature_opinions(mentions: DataFrame, cut: float = 0.05, pain_cut: float = -0.1, fraction: float = 1.0) -> DataFrame:
    """Per feature: mentions by sentiment category with percentages, mean score, and negative
    mentions, scaled up when the texts were a sample of ``fraction``. One aggregate for both."""
    kind = category(F.col("sentiment_score"), ("positive", "negative", "neutral"), cut)
    counted = mentions.withColumn("kind", kind).groupBy("feature").agg(
        F.count(F.lit(1)).alias("total_mentions"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("positive", "negative", "neutral")],
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count_if(F.col("sentiment_score") <= pain_cut).alias("negative_mentions"),
    )
    shares = {f"{k}_pct": percent(F.col(k), F.col("total_mentions")) for k in ("positive", "negative", "neutral")}
    estimate = F.floor(F.col("negative_mentions") / fraction).cast("long")
    return counted.withColumns({**shares, "estimated_negative_mentions": estimate})


def feature_sentiment(mentions: DataFrame, cut: float = 0.05) -> DataFrame:
    return feature_opinions(mentions, cut).drop("negative_mentions", "estimated_negative_mentions")


def feature_pain_points(mentions: DataFrame, cut: float = -0.1, fraction: float = 1.0) -> DataFrame:
    opinions = feature_opinions(mentions, pain_cut=cut, fraction=fraction).where(F.col("negative_mentions") > 0)
    return opinions.select("feature", "negative_mentions", "estimated_negative_mentions")


def brand_feature_counts(
    df: DataFrame, lowered: str, brands: Dictionary, context: Sequence[tx.Term], features: Dictionary,
    min_texts: int = 10, word: bool = False,
) -> DataFrame:
    """Texts per (brand, feature) among those that name the brand, word-bounded, and a context
    term in either order; with the brand's number of matching texts. One scan for all brands.

    An extra null feature per text carries the brand total through the same aggregate, so a
    brand without features is still counted. Brands with fewer than ``min_texts`` are left out.
    """
    text = F.col(lowered)
    about = df.where(tx.text_mentions(text, context, word)).select(lowered)
    branded = add_kept(about, "brands", tx.matched_names(text, brands, word=True), lambda b: F.size(b) > 0)
    with_total = F.array_append(tx.matched_names(text, features, word), F.lit(None).cast("string"))
    counted = (
        branded.select("brands", with_total.alias("features"))
        .select(F.explode("brands").alias("brand"), "features")
        .select("brand", F.explode("features").alias("feature"))
        .groupBy("brand", "feature").agg(F.count(F.lit(1)).alias("mentions"))
    )
    total = F.max(F.when(F.col("feature").isNull(), F.col("mentions"))).over(Window.partitionBy("brand"))
    return (
        counted.withColumn("matching_texts", total)
        .where((F.col("matching_texts") >= min_texts) & F.col("feature").isNotNull())
    )


def brand_summary(matrix: DataFrame, k: int = 3) -> DataFrame:
    """Per brand the sum over features, the matching texts, and its k leading features as text."""
    order = Window.partitionBy("brand").orderBy(F.desc("mentions"), "feature")
    ranked = matrix.withColumn("place", F.row_number().over(order))
    entry = F.struct("place", F.format_string("%s (%d)", "feature", "mentions").alias("label"))
    return ranked.groupBy("brand").agg(
        F.sum("mentions").alias("total_mentions"),
        F.max("matching_texts").alias("matching_texts"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.when(F.col("place") <= k, entry))), lambda e: e["label"]), ", "
        ).alias("top_features"),
    )


def feature_report(opinions: DataFrame, brands: DataFrame, most: int = 10, lowest: int = 5) -> DataFrame:
    """The tables behind the text report as (section, rank, item, value): most discussed
    features, lowest sentiment, most negative mentions, and brands.

    All feature sections come from one row per feature, so the texts are scored once.
    """
    def section(name: str, value: str, k: int, ascending: bool = False) -> Column:
        number = F.col(value).cast("double")
        key = number if ascending else -number
        return F.struct(F.lit(name).alias("section"), number.alias("value"), key.alias("key"), F.lit(k).alias("k"))

    sections = F.array(
        section("most_discussed", "total_mentions", most),
        section("lowest_sentiment", "avg_sentiment", lowest, ascending=True),
        section("pain_points", "estimated_negative_mentions", most),
    )
    features = (
        opinions.select(F.col("feature").alias("item"), F.explode(sections).alias("s")).select("item", "s.*")
        .where((F.col("section") != "pain_points") | (F.col("value") > 0))
    )
    total = F.col("total_mentions").cast("double")
    ranked_brands = brands.select(
        F.col("brand").alias("item"), F.lit("brands").alias("section"), total.alias("value"), (-total).alias("key"),
        F.lit(None).cast("int").alias("k"),
    )
    order = Window.partitionBy("section").orderBy("key", "item")
    ranked = features.unionByName(ranked_brands).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("k").isNull() | (F.col("rank") <= F.col("k"))).select("section", "rank", "item", "value")
