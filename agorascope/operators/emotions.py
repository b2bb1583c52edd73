"""Emotion words: lexicon joins and the tables built on them.

A lexicon is a table of (word, emotion) with one row per tagged pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as tx
from ..functions.binding import add_kept, as_rows
from ..functions.numeric import percent
from ..presets import EMOTIONS, NEGATIVE_EMOTIONS
from .mentions import Dictionary
from .skew import fits, salted_join

LEXICON_ROWS_MAX = 500_000


def lexicon_hits(
    df: DataFrame, key: str, text: str, lexicon: DataFrame, max_broadcast_rows: int = LEXICON_ROWS_MAX, **salting
) -> DataFrame:
    """Hits per (row key, emotion): each token counts once for every emotion of its word.

    A lexicon of up to ``max_broadcast_rows`` is sent to the executors and tokens never leave
    their task before they are counted. A larger one is joined on the word, with frequent words
    salted.
    """
    said = df.select(key, F.explode(tx.tokens(F.col(text))).alias("word"))
    if fits(lexicon, max_broadcast_rows):
        found = said.join(F.broadcast(lexicon), "word")
    else:
        per_text = said.groupBy(key, "word").agg(F.count(F.lit(1)).alias("times"))
        found = salted_join(per_text, lexicon, "word", [key], **salting)
    times = F.col("times") if "times" in found.columns else F.lit(1)
    return found.groupBy(key, "emotion").agg(F.sum(times).alias("hits"))


def feature_emotion_hits(
    df: DataFrame, text: str, features: Dictionary, lexicon: DataFrame, keys: Sequence[str] = (),
    word: bool = False, max_broadcast_rows: int = LEXICON_ROWS_MAX,
) -> DataFrame:
    """Emotion hits in the texts mentioning each feature: keys, feature, emotion, hits.

    Tokens are exploded once and carry one flag per feature, so a text with many features is
    not multiplied by them. Counts per word come first and meet the lexicon as a table no larger
    than the vocabulary; a frequent word is one row by then. A lexicon small enough also drops
    other words before any exchange.
    """
    flags = F.array(*[tx.mentions(F.lower(text), terms, word) for terms in features.values()])
    flagged = add_kept(df.select(*keys, text), "__flags", flags, lambda f: F.array_contains(f, True))
    said = flagged.select(*keys, "__flags", F.explode(tx.tokens(F.col(text))).alias("word"))
    if fits(lexicon, max_broadcast_rows):
        said = said.join(F.broadcast(lexicon.select("word").distinct()), "word", "left_semi")
    counters = [f"f{i}" for i in range(len(features))]
    per_word = said.groupBy(*keys, "word").agg(*[
        F.count_if(F.get("__flags", F.lit(i))).alias(c) for i, c in enumerate(counters)
    ])
    pairs = [(F.lit(name), F.col(c)) for name, c in zip(features, counters)]
    return (
        per_word.join(lexicon, "word").groupBy(*keys, "emotion").agg(*[F.sum(c).alias(c) for c in counters])
        .select(*keys, "emotion", as_rows(("feature", "hits"), pairs))
        .where(F.col("hits") > 0)
    )


def pivot_emotions(hits: DataFrame, keys: Sequence[str], emotions: Sequence[str] = EMOTIONS) -> DataFrame:
    """One column per emotion and its percentage of all listed hits, zeros included."""
    wide = hits.groupBy(*keys).agg(*[
        F.sum(F.when(F.col("emotion") == e, F.col("hits")).otherwise(0)).alias(e) for e in emotions
    ])
    total = sum((F.col(e) for e in emotions[1:]), F.col(emotions[0]))
    shares = {f"{e}_pct": F.coalesce(percent(F.col(e), F.col("total_emotion_hits")), F.lit(0.0)) for e in emotions}
    return wide.withColumn("total_emotion_hits", total).withColumns(shares)


def feature_emotions(mentions: DataFrame, hits: DataFrame, emotions: Sequence[str] = EMOTIONS) -> DataFrame:
    """Per mentioned feature the number of texts and its emotion counts and percentages."""
    wide = pivot_emotions(hits, ["feature"], emotions)
    named = mentions.where(F.col("mentions") > 0).withColumnRenamed("mentions", "total_comments")
    numbers = [c for c in wide.columns if c != "feature"]
    return named.join(wide, "feature", "left").fillna(0, subset=numbers)


def pain_emotions(hits: DataFrame, emotions: Sequence[str] = NEGATIVE_EMOTIONS) -> DataFrame:
    """Hits of the negative emotions per feature."""
    return hits.where(F.col("emotion").isin(list(emotions))).groupBy("feature").agg(
        F.sum("hits").alias("estimated_negative_mentions")
    )


def negative_lean(table: DataFrame, k: int = 5, emotions: Sequence[str] = NEGATIVE_EMOTIONS) -> DataFrame:
    """The k features with most negative hits and the percentages of those emotions."""
    score = sum((F.col(e) for e in emotions[1:]), F.col(emotions[0])).alias("negative_hits")
    return (
        table.select("feature", score, *[f"{e}_pct" for e in emotions])
        .orderBy(F.desc("negative_hits"), "feature").limit(k)
    )


def brand_impressions(matrix: DataFrame, emotions: DataFrame, k: int = 2, ratio: float = 1.2) -> DataFrame:
    """The k leading features of each brand as strength, issue or mixed, by whether positive or
    negative emotion outweighs the other by ``ratio``; no tone where neither occurs."""
    order = Window.partitionBy("brand").orderBy(F.desc("mentions"), "feature")
    top = matrix.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    pos, neg = F.coalesce("positive_pct", F.lit(0.0)), F.coalesce("negative_pct", F.lit(0.0))
    tone = (
        F.when((pos == 0) & (neg == 0), F.lit(None).cast("string"))
        .when(pos >= neg * ratio, "strength").when(neg >= pos * ratio, "issue").otherwise("mixed")
    )
    return (
        top.join(emotions.select("feature", "positive_pct", "negative_pct"), "feature", "left")
        .select("brand", "rank", "feature", "mentions", tone.alias("tone"))
    )
