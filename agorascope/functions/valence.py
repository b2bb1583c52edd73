"""Rule-based sentiment of a text as one native expression.

The rules are those of Hutto and Gilbert (2014), "VADER: A Parsimonious Rule-based Model for
Sentiment Analysis of Social Media Text": word valences, boosters and negators among the three
preceding words with their exceptions, emphasis by capitals (of boosters too) and punctuation, the shift at "but", and the squashing
s / sqrt(s^2 + 15). The word list is a parameter; ``presets`` has a small one of our own.

Words are runs of letters of any script and apostrophes. Entries of several words ("to die for",
"kind of") are found first, the longest at each place, and stand as one word from then on, whether they
have a valence, boost or negate; words inside them don't count for themselves. Entries with other signs
are emoticons: they count where white space or an end of the text stands around them.

Everything stays inside Spark expressions, so scoring adds neither a Python worker nor a
shuffle. Word sets become literal IN-lists (hash lookups), which suits lists of up to some
thousand words.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .binding import let
from .phrases import longest_phrases, merged
from .text import quote

# Fixed values from the paper.
NORMALIZER = 15.0
NEGATED = -0.74
NEVER_SO = 1.25
STRESSED_NEVER = ("so", "this")
CAPITALS = 0.733
EXCLAMATION = 0.292
QUESTION = 0.18
QUESTION_MANY = 0.96
DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT = 0.5
AFTER_BUT = 1.5


#: Letters and marks of any script, and apostrophes.
WORD = r"[\p{L}\p{M}']+"


@dataclass(frozen=True)
class ValenceLexicon:
    words: dict[str, float]
    boosters: dict[str, float] = field(default_factory=dict)
    negators: frozenset[str] = frozenset()
    contrast: str = "but"

    def entries(self) -> set[str]:
        return {*self.words, *self.boosters, *self.negators}

    def phrases(self) -> list[str]:
        """Entries of several words."""
        return sorted(e for e in self.entries() if " " in e)

    def emoticons(self) -> list[str]:
        """Entries that are no words, the longest first."""
        return sorted((e for e in self.entries() if not all(c.isalpha() or c in "' " or unicodedata.category(c)[0] == "M" for c in e)), key=lambda e: (-len(e), e))

    def token(self) -> str:
        """The pattern of a token."""
        faces = "|".join(map(quote, self.emoticons()))
        return rf"(?<!\S)(?i:{faces})(?!\S)|{WORD}" if faces else WORD


def _lookup(word: Column, values: dict[str, float], default: float | None = 0.0) -> Column:
    """Value of a word: one hash-set test per distinct value rather than per word."""
    by_value: dict[float, list[str]] = defaultdict(list)
    for name, value in values.items():
        by_value[float(value)].append(name)
    result = F.lit(default).cast("double")
    if not by_value:
        return result
    cases = None
    for value, names in sorted(by_value.items()):
        test = word.isin(sorted(names))
        cases = F.when(test, F.lit(value)) if cases is None else cases.when(test, F.lit(value))
    return cases.otherwise(result)


def _is(word: Column, names) -> Column:
    names = sorted(names)
    return F.coalesce(word.isin(names), F.lit(False)) if names else F.lit(False)


def _negation(w1: Column, w2: Column, w3: Column, lexicon: ValenceLexicon) -> Column:
    """The factor of the three words before, the nearest first: a negator turns the sign, "never so"
    and "never this" stress instead, "without doubt" does nothing, and "least" turns the sign but
    after "at" and "very"."""
    def so(*before: Column) -> Column:
        return reduce(or_, [_is(w, STRESSED_NEVER) for w in before])

    def doubt(*before: Column) -> Column:
        return reduce(or_, [_is(w, ["doubt"]) for w in before])

    def factor(word: Column, *nearer: Column) -> Column:
        turned = F.when(_is(word, lexicon.negators), NEGATED).otherwise(1.0)
        if not nearer:
            return turned
        stressed, certain = _is(word, ["never"]) & so(*nearer), _is(word, ["without"]) & doubt(*nearer)
        return F.when(stressed, NEVER_SO).when(certain, 1.0).otherwise(turned)

    least = F.when(_is(w1, ["least"]) & ~_is(w2, ["at", "very"]), NEGATED).otherwise(1.0)
    return factor(w1) * factor(w2, w1) * factor(w3, w2, w1) * least


def _hit_score(text: Column, i: Column, lexicon: ValenceLexicon) -> Column:
    """Valence of the lexicon word at position i of a prepared text in its context."""
    words, raw, but_at = text["words"], F.get(text["raw"], i), text["but_at"]

    def in_context(value: Column) -> Column:
        sign = F.signum(value)

        def shouted(word: Column) -> Column:
            return F.when(text["mixed"] & _is_capitals(word), CAPITALS).otherwise(0.0)

        total = value + sign * shouted(raw)
        for distance, weight in enumerate(DAMPING, start=1):
            before = F.get(words, i - distance)
            # A booster in capitals counts more, in the direction of the word that it stands before.
            boost = _lookup(before, lexicon.boosters)
            loud = F.when(_is(before, lexicon.boosters), shouted(F.get(text["raw"], i - distance))).otherwise(0.0)
            total = total + (boost + loud) * sign * weight
        return total * _negation(*[F.get(words, i - d) for d in (1, 2, 3)], lexicon)

    but_weight = (
        F.when(but_at == 0, 1.0).when(i + 1 < but_at, BEFORE_BUT).when(i + 1 > but_at, AFTER_BUT).otherwise(1.0)
    )
    return let(_lookup(F.get(words, i), lexicon.words), in_context) * but_weight


def _is_capitals(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word) & (F.length(word) > 1)


def _punctuation(text: Column) -> Column:
    bangs = F.least(F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))), F.lit(4))
    marks = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    asked = F.when(marks <= 1, 0.0).when(marks <= 3, marks * QUESTION).otherwise(QUESTION_MANY)
    return bangs * EXCLAMATION + asked


def valence(text: Column, lexicon: ValenceLexicon) -> Column:
    """The compound score in [-1, 1], rounded to four places; null and empty texts score 0.

    Tokens and their context are bound step by step, so each text is tokenised once wherever the
    optimiser places the expression.
    """
    vocabulary = sorted(lexicon.words)

    # Most texts have no two letters in a row that aren't lower case; only the others need a look at each token.
    maybe_capitals = F.rlike(text, F.lit(r"[\p{L}\p{M}'&&[^\p{Ll}]]{2}"))
    phrases = lexicon.phrases()

    def whole_phrases(raw: Column) -> Column:
        if not phrases:
            return raw
        lowered = F.transform(raw, lambda w: F.lower(w))
        return let(let(lowered, lambda words: longest_phrases(words, phrases)), lambda found: merged(raw, found))

    def prepare(raw: Column) -> Column:
        capitals = F.when(maybe_capitals, F.size(F.filter(raw, _is_capitals))).otherwise(0)
        return F.struct(
            raw.alias("raw"),
            F.transform(raw, lambda w: F.lower(w)).alias("words"),
            ((capitals > 0) & (capitals < F.size(raw))).alias("mixed"),
        )

    def locate(t: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(0), F.size(t["words"]) - 1), lambda i: F.get(t["words"], i).isin(vocabulary))
        return F.struct(
            t["raw"].alias("raw"), t["words"].alias("words"), t["mixed"].alias("mixed"),
            F.array_position(t["words"], lexicon.contrast).cast("int").alias("but_at"),
            F.when(F.size(t["words"]) > 0, hits).otherwise(F.array().cast("array<int>")).alias("hits"),
        )

    def total(t: Column) -> Column:
        return F.aggregate(t["hits"], F.lit(0.0), lambda acc, i: acc + _hit_score(t, i, lexicon))

    whole = F.coalesce(text, F.lit(""))
    raw = F.regexp_extract_all(whole, F.lit(lexicon.token()), F.lit(0))
    s = let(let(raw, whole_phrases), lambda r: let(prepare(r), lambda p: let(locate(p), total)))
    stressed = let(s, lambda t: t + F.signum(t) * _punctuation(whole))
    return F.round(let(stressed, lambda t: t / F.sqrt(t * t + NORMALIZER)), 4)


def add_valence(df: DataFrame, text: str, lexicon: ValenceLexicon, out: str = "sentiment_score") -> DataFrame:
    return df.withColumn(out, valence(F.col(text), lexicon))


def category(score: Column, names=("Positive", "Negative", "Neutral"), cut: float = 0.05) -> Column:
    positive, negative, neutral = names
    return F.when(score >= cut, positive).when(score <= -cut, negative).otherwise(neutral)
