"""Phrases and dictionaries of whole words over the tokens of a text, by hash lookups.

A set of literals becomes a hash set inside generated code, so the number of phrases hardly
matters: what is looked up is each token, and the few n-grams that start with a phrase's first word.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from .binding import let

FOUND = "array<struct<start:int,size:int>>"


def among(value: Column, literals: Iterable[str]) -> Column:
    """Whether a value is one of the literals; never null."""
    literals = sorted(set(literals))
    return F.coalesce(value.isin(literals), F.lit(False)) if literals else F.lit(False)


def phrase_at(words: Column, i: Column, size: int) -> Column:
    """``size`` words from place ``i`` on, joined by spaces; fewer at the end of the text."""
    return F.array_join(F.slice(words, i + 1, F.lit(size)), " ")


def longest_phrases(words: Column, phrases: Iterable[str]) -> Column:
    """``(start, size)`` of the phrases in an array of words, from left to right, the longest at
    each place, none over another. Phrases are words joined by single spaces."""
    by_size: dict[int, list[str]] = {}
    for phrase in phrases:
        by_size.setdefault(len(phrase.split()), []).append(" ".join(phrase.split()))
    if not by_size:
        return F.array().cast(FOUND)
    firsts = {p.split()[0] for group in by_size.values() for p in group}
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: among(F.get(words, i), firsts))

    def longest(i: Column) -> Column:
        size = F.lit(0)
        for n in sorted(by_size):
            size = F.when((i + n <= F.size(words)) & among(phrase_at(words, i, n), by_size[n]), n).otherwise(size)
        return F.struct(i.alias("start"), size.alias("size"))

    def take(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        free = last["start"] + last["size"] <= x["start"]
        return F.when((x["size"] > 0) & free, F.array_append(done, x)).otherwise(done)

    some = let(F.when(F.size(words) > 0, places).otherwise(F.array().cast("array<int>")), lambda p: F.transform(p, longest))
    # An entry of no size to begin with, so that there always is a last one.
    start = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("size"))).cast(FOUND)
    return F.filter(F.aggregate(some, start, take), lambda x: x["size"] > 0)


def merged(words: Column, found: Column) -> Column:
    """The words, each found phrase as one of them."""
    def token(i: Column) -> Column:
        own = F.filter(found, lambda f: (f["start"] <= i) & (i < f["start"] + f["size"]))
        return let(own, lambda o: F.when(F.size(o) == 0, F.get(words, i)).when(
            o[0]["start"] == i, F.array_join(F.slice(words, i + 1, o[0]["size"]), " ")))

    joined = F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), token), lambda t: t.isNotNull())
    return F.when(F.size(found) > 0, joined).otherwise(words)


#: Words and what stands between them, as ``text.WORD_START`` and ``text.WORD_END`` see words.
PIECES = "[a-z0-9_]+|[^a-z0-9_]+"
LONGEST_TERM = 4


def looked_up(term: str) -> bool:
    """Whether a term can be found by lookups: it starts and ends with a word character and has at most ``LONGEST_TERM`` words."""
    return bool(re.fullmatch(r"[a-z0-9_](.*[a-z0-9_])?", term, re.DOTALL)) and len(re.findall("[a-z0-9_]+", term)) <= LONGEST_TERM


def found_terms(lowered: Column, terms: Iterable[str]) -> Column:
    """The terms, of those that ``looked_up`` allows, that stand in a text as whole words.

    At each word that some term begins with, the text from there over one to four words is looked up with
    what stands between them. So the cost is one lookup for each word, whatever the number of terms.
    """
    by_size: dict[int, list[str]] = {}
    for term in terms:
        by_size.setdefault(len(re.findall("[a-z0-9_]+", term)), []).append(term)
    all_terms = sorted({t for group in by_size.values() for t in group})
    firsts = {re.match("[a-z0-9_]+", t)[0] for t in all_terms}

    def spans(pieces: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(pieces)), lambda i: among(F.element_at(pieces, i), firsts))

        def own(i: Column) -> Column:
            # Words and what parts them take turns, so n words are 2n - 1 pieces.
            several = F.array(*[F.array_join(F.slice(pieces, i, F.lit(2 * n - 1)), "") for n in sorted(by_size)])
            return F.filter(several, lambda span: among(span, all_terms))

        return F.flatten(F.transform(places, own))

    pieces = F.regexp_extract_all(F.coalesce(lowered, F.lit("")), F.lit(PIECES), F.lit(0))
    return let(pieces, lambda p: F.when(F.size(p) > 0, spans(p)).otherwise(F.array().cast("array<string>")))
