"""Language identification by words, falling back to character n-grams.

A word that any language's model knows scores, for each language, by the logarithm of its relative
frequency there. A word that none knows is scored by its n-grams, with a space at either end: of
the longest ones of which some are known, the mean over those known; else of the next shorter ones.
A text's score for a language is the mean over its words; its language is the one with the best
score. ``score`` is that language's share of the probabilities that the means stand for.

Models keep the words, and n-grams of each length, with at least a share ``CUTOFF`` of a language's
occurrences. So a model has at most ``1 / CUTOFF`` of each, whatever the corpus, and can be sent to
all tasks. Counts cover all training texts.

Defined cases: a text that is null or has no letter, and any text if nothing was learned, is
``und`` with score 0; a training row without text or language teaches nothing; equal scores go to
the first language by name; repeated rows stay as rows and count again; columns besides the named
ones aren't read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import arrow_map, column, slices, stored

LONGEST = 6
CUTOFF = 2e-5
#: log10 of the probability of what a language's model lacks but another's has.
PENALTY = -7.0
UNKNOWN = "und"
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Distinct words whose n-grams a task counts.
WORDS_PER_TASK = 100_000

_WORDS = re.compile(r"[^\W\d_]+")
_COUNTS = "lang string, word string, n bigint"


def words_of(text: str | None) -> list[str]:
    """Runs of letters, in lower case. Runs with other numeric signs lose these."""
    found = _WORDS.findall(text.lower()) if text else []
    if text and not text.isascii():
        return [w for x in found for w in ([x] if x.isalpha() else "".join(c if c.isalpha() else " " for c in x).split())]
    return found


def word_counts(labelled: DataFrame) -> DataFrame:
    """``(lang, word, n)`` over whole texts, counted in each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, words in held.items():
                yield pa.record_batch([pa.array([lang] * len(words)), pa.array(list(words)), pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])
            held.clear()

        for batch in slices(batches, 256):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, Counter()).update(words_of(text.as_py()))
            if sum(map(len, held.values())) > HELD:
                yield from out()
        yield from out()

    rows = labelled.select("lang", "text").where("lang is not null and text is not null")
    return arrow_map(rows, count, _COUNTS).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def frequent_shares(counts: DataFrame, unit: str, cutoff: float) -> DataFrame:
    """``(lang, <unit>, size, p)``: units with at least a share ``cutoff`` of those of their language and size."""
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), ["lang", "size"]).withColumn("p", F.col("n") / F.col("total"))
    return shares.where(F.col("p") >= cutoff).select("lang", unit, "size", "p")


@dataclass
class Model:
    """Scores by language of known words and n-grams: rows of a table, and tuples."""

    languages: list[str]
    words: dict[str, int]
    table: np.ndarray
    grams: dict[str, tuple[float, ...]]
    longest: int

    def unseen(self, word: str) -> tuple[float, ...] | None:
        """The score of a word that no language has, from its longest known n-grams."""
        padded, grams = f" {word} ", self.grams.get
        for size in range(min(self.longest, len(padded)), 0, -1):
            known = [g for g in [grams(padded[i : i + size]) for i in range(len(padded) - size + 1)] if g is not None]
            if known:
                return tuple(sum(x) / len(known) for x in zip(*known))
        return None


class Judge:
    """A model at work in a task: unseen words' scores are kept, up to ``HELD``, as rows after the known words'."""

    def __init__(self, model: Model):
        self.model = model
        count = len(model.words)
        self.rows = np.zeros((count + HELD + 1, len(model.languages) + 1))  # the last column counts words with a score
        self.rows[:count, :-1] = model.table
        self.rows[:count, -1] = 1
        self.places = dict(model.words)

    def place(self, word: str) -> int:
        """The row of a word that has none yet; the last row is used again once all others are."""
        at = min(len(self.places), len(self.rows) - 1)
        got = self.model.unseen(word)
        self.rows[at] = 0 if got is None else (*got, 1)
        if at < len(self.rows) - 1:
            self.places[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        model, found = self.model, words_of(text)
        if not found or not model.languages:
            return UNKNOWN, 0.0
        get, extra, at = self.places.get, 0, []
        for word in found:
            row = get(word)
            if row is None:
                row = self.place(word)
                if row == len(self.rows) - 1:
                    extra = extra + self.rows[row]
                    continue
            at.append(row)
        total = self.rows[at].sum(axis=0) + extra
        # Letters, but none that any language has, speak for all languages alike.
        mean = total[:-1] / total[-1] if total[-1] else total[:-1]
        odds = 10.0 ** (mean - mean.max())
        best = int(np.argmax(odds))
        return model.languages[best], float(odds[best] / odds.sum())


def fit(labelled: DataFrame, cutoff: float = CUTOFF, longest: int = LONGEST) -> Model:
    """A model from rows ``(lang, text)``."""
    counts = stored(word_counts(labelled), "words")
    words = frequent_shares(counts.withColumn("size", F.lit(0)), "word", cutoff)
    # Words by the task: few tasks with many words each combine most of their n-grams before the shuffle.
    counts = counts.coalesce(max(1, -(-counts.count() // WORDS_PER_TASK)))
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") + 2)))
    sized = counts.select("lang", "n", padded.alias("word"), size.alias("size"))
    at = F.explode(F.sequence(F.lit(1), F.length("word") - F.col("size") + 1))
    cut = sized.select("lang", "n", "size", "word", at.alias("at"))
    grams = cut.groupBy("lang", "size", F.substring("word", F.col("at"), F.col("size")).alias("word")).agg(F.sum("n").alias("n"))
    rows = words.union(frequent_shares(grams, "word", cutoff)).collect()
    languages = sorted({r.lang for r in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    tables: tuple[dict[str, list[float]], dict[str, list[float]]] = ({}, {})
    for lang, unit, size, p in rows:
        scores = tables[size > 0].setdefault(unit, [PENALTY] * len(languages))
        scores[place[lang]] = max(PENALTY, math.log10(p))
    words, grams = tables
    table = np.array(list(words.values())).reshape(len(words), len(languages))
    return Model(languages, {w: i for i, w in enumerate(words)}, table, {g: tuple(x) for g, x in grams.items()}, longest)


_JUDGES: dict[int, Judge] = {}


def _judge(sent: Broadcast) -> Judge:
    """The judge of a worker, which serves many tasks: that of the last model."""
    model = sent.value
    if id(model) not in _JUDGES:
        _JUDGES.clear()
        _JUDGES[id(model)] = Judge(model)
    return _JUDGES[id(model)]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, which replace columns of these names; only ``text`` is looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # A row's other columns pass through, so that no join is needed.
    others = [c for c in docs.columns if c.lower() not in ("text", "lang_pred", "score")]
    rows = docs.select("text", F.struct(F.lit(True).alias("there"), *([F.struct(*map(column, others)).alias("others")] if others else [])).alias("row"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _judge(sent)
        for batch in slices(batches, 1024):
            found = [own.predict(t.as_py()) for t in batch.column(0)]
            yield pa.record_batch(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["text", "row", "lang_pred", "score"],
            )

    schema = StructType([*rows.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    found = arrow_map(rows, judge, schema)
    return found.select("text", *(["row.others.*"] if others else []), "lang_pred", "score")
