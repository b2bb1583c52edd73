"""Topics of each period, how well they fit, and which of them belong together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .hygiene import split_rows
from .models import fit

# Words that say nothing about the topic of a forum text.
FORUM_STOP_WORDS = ["https", "www", "com", "http", "deleted", "removed", "edit", "update", "im", "ive", "dont"]


@dataclass
class PeriodTopics:
    """The topics of one period: ``distributions`` has a row for each topic and a column for each word of the vocabulary."""

    period: str
    vocabulary: list[str]
    distributions: np.ndarray
    documents: int
    held_out: int
    #: Negative log-likelihood bound of a word of the held-out texts; none without such texts or words.
    log_perplexity: float | None


def all_stop_words(stop_words: Sequence[str] = ()) -> list[str]:
    return [*StopWordsRemover.loadDefaultStopWords("english"), *FORUM_STOP_WORDS, *stop_words]


def fit_topics(
    texts: DataFrame, periods: Sequence[str], key: str = "key", k: int = 5, iterations: int = 20, vocabulary: int = 1000,
    min_df: int = 5, stop_words: Sequence[str] = (), seed: int = 42, train: float = 1.0,
) -> list[PeriodTopics]:
    """An LDA model per period. With ``train`` below 1, the other texts, by key, judge the model.

    What comes back is bounded by topics and vocabulary. A period without words of its own has no topics.
    The texts are made once and kept at hand: vocabularies and counts of all periods come from one pass each,
    and the fits and their judgement read what is kept.
    """
    rows = texts.where(F.col("period").isin(list(periods))).select("period", key, F.coalesce("text", F.lit("")).alias("text"))
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_periods(kept, periods, key, k, iterations, vocabulary, min_df, all_stop_words(stop_words), seed, train)
    finally:
        kept.unpersist()


def _fit_periods(
    rows: DataFrame, periods: Sequence[str], key: str, k: int, iterations: int, vocabulary: int, min_df: int, stop_words: Sequence[str],
    seed: int, train: float,
) -> list[PeriodTopics]:
    all_learned, all_judged = split_rows(rows, key, train, seed) if train < 1 else (rows, rows.where("false"))
    sizes, held_sizes = ({r.period: r["count"] for r in part.groupBy("period").count().collect()} for part in (all_learned, all_judged))
    # At most ``vocabulary`` words a period, in an order of their own, so that models repeat.
    found = period_vocabulary(all_learned, vocabulary, min_df, stop_words).orderBy("period", F.desc("occurrences"), "term").collect()
    out = []
    for period in periods:
        words = [r.term for r in found if r.period == period]
        documents, held = sizes.get(period, 0), held_sizes.get(period, 0)
        if not words:
            out.append(PeriodTopics(period, [], np.zeros((0, 0)), documents, held, None))
            continue
        learned, judged = (part.where(F.col("period") == period).select(key, "text") for part in (all_learned, all_judged))
        counted = PipelineModel([
            Tokenizer(inputCol="text", outputCol="words"),
            CountVectorizerModel.from_vocabulary(words, inputCol="words", outputCol="features"),
        ])
        model = fit([LDA(k=k, maxIter=iterations, featuresCol="features", seed=seed)], counted.transform(learned).select(key, "features"), key).stages[-1]
        matrix = model.topicsMatrix().toArray().T
        perplexity = None
        if held:
            value = float(model.logPerplexity(counted.transform(judged)))
            perplexity = value if np.isfinite(value) else None
        out.append(PeriodTopics(period, words, matrix / matrix.sum(axis=1, keepdims=True), documents, held, perplexity))
    return out


def describe(spark: SparkSession, fitted: Sequence[PeriodTopics], terms: int = 10) -> DataFrame:
    """Leading terms of each topic and their weights as text; equal weights in the order of the vocabulary."""
    rows = []
    for topics in fitted:
        for number, weights in enumerate(topics.distributions):
            first = np.argsort(-weights, kind="stable")[:terms]
            rows.append((topics.period, number, ", ".join(topics.vocabulary[i] for i in first), ", ".join(f"{weights[i]:.3f}" for i in first)))
    return spark.createDataFrame(rows, "period string, topic_num int, top_terms string, weights string")


def topics_by_period(texts: DataFrame, periods: Sequence[str], terms: int = 10, **settings) -> DataFrame:
    """An LDA model per period and its topics: leading terms and their weights as text."""
    return describe(texts.sparkSession, fit_topics(texts, periods, **settings), terms)


def topic_fit(spark: SparkSession, fitted: Sequence[PeriodTopics]) -> DataFrame:
    """Texts and held-out perplexity of each period's model."""
    rows = [(t.period, len(t.vocabulary), t.documents, t.held_out, t.log_perplexity, None if t.log_perplexity is None else float(np.exp(t.log_perplexity))) for t in fitted]
    return spark.createDataFrame(rows, "period string, vocabulary int, documents long, held_out long, log_perplexity double, perplexity double")


def distances(first: PeriodTopics, second: PeriodTopics) -> np.ndarray:
    """Jensen-Shannon distances (0 to 1) of the topics' distributions over the words of either period."""
    words = {w: i for i, w in enumerate(dict.fromkeys([*first.vocabulary, *second.vocabulary]))}

    def spread(topics: PeriodTopics) -> np.ndarray:
        out = np.zeros((len(topics.distributions), len(words)))
        out[:, [words[w] for w in topics.vocabulary]] = topics.distributions
        return out

    def entropy(p: np.ndarray) -> np.ndarray:
        return -np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0).sum(axis=-1)

    a, b = spread(first), spread(second)
    between = np.stack([entropy((row + b) / 2) for row in a]) if len(a) else np.zeros((0, len(b)))
    return np.sqrt(np.maximum(between - (entropy(a)[:, None] + entropy(b)[None, :]) / 2, 0))


def paired_topics(spark: SparkSession, first: PeriodTopics, second: PeriodTopics, shared: int = 5) -> DataFrame:
    """Topics of two periods, the closest pair first, each in one pair at most; topics left over stand alone.

    ``shared_terms`` are those that weigh most in both.
    """
    apart = distances(first, second)
    rows, left, right = [], set(range(apart.shape[0])), set(range(apart.shape[1]))
    for _, i, j in sorted((apart[i, j], i, j) for i in left for j in right):
        if i in left and j in right:
            left.discard(i)
            right.discard(j)
            weights = {w: min(first.distributions[i][n], second.distributions[j][second.vocabulary.index(w)]) for n, w in enumerate(first.vocabulary) if w in second.vocabulary}
            terms = sorted(weights, key=lambda w: (-weights[w], w))[:shared]
            rows.append((int(i), int(j), float(apart[i, j]), ", ".join(terms)))
    rows += [(i, None, None, None) for i in sorted(left)] + [(None, j, None, None) for j in sorted(right)]
    return spark.createDataFrame(rows, "first_topic int, second_topic int, distance double, shared_terms string")


def period_vocabulary(texts: DataFrame, vocabulary: int = 1000, min_df: int = 5, stop_words: Sequence[str] | None = None) -> DataFrame:
    """``period, term, occurrences, documents, period_documents``: the words that topics are made of.

    Of a period's words in ``min_df`` texts or more, the most frequent ones, ties by name.
    """
    stops = all_stop_words() if stop_words is None else list(stop_words)
    words = F.filter(F.split(F.lower("text"), r"\s"), lambda w: (w != "") & ~w.isin(stops))
    said = texts.select("period", words.alias("words"))
    sizes = said.groupBy("period").agg(F.count(F.lit(1)).alias("period_documents"))
    # Each word of a text once as an occurrence and once for the text: both counts in one aggregate, without a shuffle by text.
    said_in = lambda source, whole: F.transform(source, lambda w: F.struct(w.alias("term"), F.lit(whole).alias("whole")))
    each = said.select("period", F.explode(F.concat(said_in("words", False), said_in(F.array_distinct("words"), True))).alias("word"))
    counted = each.groupBy("period", "word.term").agg(F.count_if(~F.col("word.whole")).alias("occurrences"), F.count_if("word.whole").alias("documents"))
    order = Window.partitionBy("period").orderBy(F.desc("occurrences"), "term")
    first = counted.where(F.col("documents") >= min_df).withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= vocabulary)
    return first.drop("__place").join(sizes, "period").select("period", "term", "occurrences", "documents", "period_documents")
