"""Word lexicons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import Term
from ..functions.valence import ValenceLexicon
from ..presets import EMOTION_LEXICON
from ..schemas import LEXICON_SCHEMA


#: Rows of a dictionary or lexicon that may become part of a plan.
TERMS_MAX = 20_000


def from_dict(spark: SparkSession, words: dict[str, list[str]]) -> DataFrame:
    """A (word, emotion) table from a small dictionary in code."""
    rows = [(word, emotion) for word, emotions in words.items() for emotion in emotions]
    return spark.createDataFrame(rows, "word string, emotion string")


def load(spark: SparkSession, path: str | None, separator: str = "\t") -> DataFrame:
    """(word, emotion) for the pairs whose association is 1, lower-cased, from a headerless file
    of word, emotion, association. Without a path, the small built-in lexicon."""
    if path is None:
        return from_dict(spark, EMOTION_LEXICON)
    raw = spark.read.schema(LEXICON_SCHEMA).option("sep", separator).csv(path)
    tagged = raw.where(F.col("association") == 1)
    return tagged.select(F.lower("word").alias("word"), F.lower("emotion").alias("emotion")).distinct()


def load_terms(spark: SparkSession, path: str, separator: str = "\t") -> dict[str, list[Term]]:
    """A term dictionary from files of feature, term, is_regex: plain terms lower-cased, patterns as they are.

    Dictionaries are written by people and become part of a plan, so their rows come to the driver;
    more than ``TERMS_MAX`` of them are an error.
    """
    raw = spark.read.schema("feature string, term string, is_regex boolean").option("sep", separator).csv(path)
    rows = raw.where("feature is not null and term is not null").distinct().limit(TERMS_MAX + 1).collect()
    if len(rows) > TERMS_MAX:
        raise ValueError(f"a term dictionary has at most {TERMS_MAX} terms")
    features: dict[str, list[Term]] = {}
    for row in sorted(rows, key=lambda r: (r.feature, r.term)):
        features.setdefault(row.feature, []).append({"re": row.term} if row.is_regex else row.term.lower())
    return features


def load_valence(spark: SparkSession, path: str, boosters: dict[str, float], negators: frozenset[str], separator: str = "\t") -> ValenceLexicon:
    """A valence lexicon from files whose first columns are word and mean valence; of repeated words the smallest value."""
    raw = spark.read.schema("word string, valence double").option("sep", separator).csv(path)
    rows = raw.where("word is not null and valence is not null").groupBy(F.lower("word").alias("word")).agg(F.min("valence").alias("valence"))
    found = rows.limit(TERMS_MAX + 1).collect()
    if len(found) > TERMS_MAX:
        raise ValueError(f"a valence lexicon has at most {TERMS_MAX} words")
    return ValenceLexicon({r.word: r.valence for r in found}, boosters, negators)
