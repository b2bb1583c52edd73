"""Before and after an event: volume, sentiment, keywords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as tx
from ..functions.binding import as_rows, named
from ..functions.numeric import percent
from ..functions.time import epoch_timestamp, epoch_within, month_text
from .hygiene import period_rows

PRE, POST = "Pre-Launch", "Post-Launch"


def corpus(
    texts: DataFrame, product: str | Sequence[str], first: str, last: str, event_day: str,
    min_length: int = 20, epoch: str = "created_utc",
) -> DataFrame:
    """Texts matching the product pattern, or any of several whatever the case, within the dates, with date, month and period.

    The date range is applied first, once on the stored epoch, where it reaches the scan, and once
    exactly; the pattern runs only on what is left.
    """
    dated = texts.where(epoch_within(F.col(epoch), first, last)).withColumn("date", F.to_date(epoch_timestamp(F.col(epoch))))
    inside = period_rows(dated, "date", first, last, event_day, PRE, POST)
    pattern = product if isinstance(product, str) else "(?i)" + "|".join(f"(?:{p})" for p in product)
    matching = inside.where(F.col("text").rlike(pattern) & (F.length("text") >= min_length))
    return matching.withColumn("year_month", month_text(F.col("date")))


def _volume(df: DataFrame, keys: Sequence, n: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), F.avg("score").alias("avg_score"))


def volume_by_period(df: DataFrame) -> DataFrame:
    return _volume(df, ["period"], "total_posts")


def volume_daily(df: DataFrame) -> DataFrame:
    return _volume(df, ["date"], "post_count").orderBy("date")


def volume_weekly(df: DataFrame) -> DataFrame:
    """By week, named by its Monday."""
    return _volume(df, [F.to_date(F.date_trunc("week", "date")).alias("week")], "post_count").orderBy("week")


def volume_monthly_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("year_month", "period", "type").agg(F.count(F.lit(1)).alias("count")).orderBy("year_month")


def sentiment_by(df: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg("sentiment_score").alias("avg_sentiment"), F.count(F.lit(1)).alias(n))


def sentiment_distribution(df: DataFrame) -> DataFrame:
    counted = df.groupBy("period", "sentiment_category").agg(F.count(F.lit(1)).alias("count"))
    return counted.withColumn("pct", percent(F.col("count"), F.sum("count").over(Window.partitionBy("period"))))


def keyword_flags(df: DataFrame, keywords: Sequence[str], text: str = "text") -> DataFrame:
    """A 0/1 column per distinct keyword."""
    lowered = F.lower(text)
    return df.withColumns({
        tx.keyword_column(k): tx.has_keyword(lowered, k).cast("int") for k in tx.unique_keywords(keywords)
    })


def keyword_rates(flagged: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Mentions, texts and rate per keyword and period from one aggregate."""
    names = tx.unique_keywords(keywords)
    summed = flagged.groupBy("period").agg(
        F.count(F.lit(1)).alias("total_posts"), *[F.sum(named(tx.keyword_column(k))).alias(f"c{i}") for i, k in enumerate(names)]
    )
    pairs = [(F.lit(k), F.col(f"c{i}")) for i, k in enumerate(names)]
    return (
        summed.select("period", "total_posts", as_rows(("keyword", "mentions"), pairs))
        .withColumn("mention_rate", percent(F.col("mentions"), F.col("total_posts")))
    )


def keyword_change(rates: DataFrame) -> DataFrame:
    """Rates side by side and the relative change; null where there was no mention before."""
    wide = rates.groupBy("keyword").agg(
        F.max(F.when(F.col("period") == PRE, F.col("mention_rate"))).alias("pre_rate"),
        F.max(F.when(F.col("period") == POST, F.col("mention_rate"))).alias("post_rate"),
    )
    change = percent(F.col("post_rate") - F.col("pre_rate"), F.col("pre_rate"))
    return wide.withColumn("change_pct", change).orderBy(F.desc_nulls_last("change_pct"), "keyword")


def summary(sentiment: DataFrame, change: DataFrame, k: int = 3) -> DataFrame:
    """Change of volume in percent, change of mean sentiment, and the k largest keyword changes,
    from the sentiment and keyword tables by period."""
    def of(value: str, period: str):
        return F.max(F.when(F.col("period") == period, F.col(value)))

    # A period without texts has a volume of 0 but no mean sentiment.
    before, after = (F.coalesce(of("total_posts", p), F.lit(0)) for p in (PRE, POST))
    periods = sentiment.agg(
        percent(after - before, before).alias("grown"),
        (of("avg_sentiment", POST) - of("avg_sentiment", PRE)).alias("shifted"),
    ).select(F.expr("stack(2, 'volume_change_pct', grown, 'sentiment_change', shifted) as (metric, value)"))
    words = change.where(F.col("change_pct").isNotNull()).orderBy(F.desc("change_pct"), "keyword").limit(k).select(
        F.concat(F.lit("keyword: "), F.col("keyword")).alias("metric"), F.col("change_pct").alias("value")
    )
    return periods.unionByName(words)
