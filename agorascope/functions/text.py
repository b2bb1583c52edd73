"""Text assembly, normalisation, tokens and term matching.

Matching functions expect text that is already lower-cased. A term is a literal string or
``{"re": pattern}``. In ``word`` mode a literal must not touch another word character; the
boundary is spelled with look-around on ASCII word characters so that an accented letter next
to a term counts as a boundary in every engine.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, functions as F

from .binding import let
from .phrases import among, found_terms, looked_up

Term = str | dict[str, str]

WORD_START = "(?<![a-z0-9_])"
WORD_END = "(?![a-z0-9_])"
TOKEN = "[a-z']+"
#: Word-bounded literals beyond which they are looked up word by word instead of searched for one by one.
SEARCHED_MAX = 32


def quote(literal: str) -> str:
    """A literal as a regular expression; only characters with a meaning are escaped."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", literal)


def word_pattern(terms: Sequence[Term]) -> str:
    """Word-bounded pattern for any of the terms; the boundary test is shared by all of them."""
    return f"{WORD_START}(?:{alternation(terms)}){WORD_END}"


def alternation(terms: Sequence[Term]) -> str:
    return "|".join(t["re"] if isinstance(t, dict) else quote(t.lower()) for t in terms)


def any_of(tests: Sequence[Column]) -> Column:
    """Whether any test holds, as a balanced tree: a chain of thousands is too deep for the analyser."""
    half = len(tests) // 2
    return tests[0] if len(tests) == 1 else any_of(tests[:half]) | any_of(tests[half:])


def _contains_any(lowered: Column, literals: Sequence[str]) -> Column:
    return any_of([F.contains(lowered, F.lit(t.lower())) for t in literals])


def mentions(lowered: Column, terms: Sequence[Term], word: bool = False) -> Column:
    """True where any term occurs.

    Plain substrings use ``contains``, a byte search inside generated code that costs next to
    nothing. Patterns go through the regular expression engine, all in one. So do word-bounded
    literals, but only in texts that contain one of them at all; many of them are looked up word by word.
    """
    literals = [t for t in terms if isinstance(t, str)]
    patterns = [t for t in terms if isinstance(t, dict)]
    known = {t.lower() for t in literals if looked_up(t.lower())} if word else set()
    tests = []
    if len(known) > SEARCHED_MAX:
        tests.append(F.size(found_terms(lowered, known)) > 0)
        literals = [t for t in literals if t.lower() not in known]
    if literals:
        found = _contains_any(lowered, literals)
        tests.append(found & F.rlike(lowered, F.lit(word_pattern(literals))) if word else found)
    if patterns:
        tests.append(F.rlike(lowered, F.lit(word_pattern(patterns) if word else alternation(patterns))))
    return reduce(or_, tests)


def text_mentions(text: Column, terms: Sequence[Term], word: bool = False) -> Column:
    """``mentions`` for text in any case, lower-cased once; for use in filters, which do not
    share common parts of an expression."""
    return let(F.lower(text), lambda lowered: mentions(lowered, terms, word))


def distinct_term_hits(lowered: Column, terms: Sequence[str], word: bool = False) -> Column:
    """How many of the terms occur at least once."""
    return reduce(
        lambda a, b: a + b,
        [F.coalesce(mentions(lowered, [t], word).cast("int"), F.lit(0)) for t in terms],
    )


def occurrences(lowered: Column, term: Term, word: bool = False) -> Column:
    """Non-overlapping occurrences of a term in one text."""
    if isinstance(term, dict):
        count = F.regexp_count(lowered, F.lit(word_pattern([term]) if word else term["re"]))
    elif word:
        # The term first, then a look back over it: the engine then searches for its characters
        # instead of testing a boundary at every position.
        literal = quote(term.lower())
        behind = WORD_START[:-1] + literal + ")"
        bounded = F.regexp_count(lowered, F.lit(literal + behind + WORD_END))
        count = F.when(F.contains(lowered, F.lit(term.lower())), bounded)
    else:
        # Removing the term and comparing lengths avoids the regular expression engine.
        gone = F.length(F.replace(lowered, F.lit(term.lower()), F.lit("")))
        count = F.floor((F.length(lowered) - gone) / len(term))
    return F.coalesce(count, F.lit(0)).cast("long")


def matched_names(lowered: Column, dictionary: dict[str, Sequence[Term]], word: bool = False) -> Column:
    """Array of the dictionary entries that a text mentions.

    In ``word`` mode a dictionary of many literals is looked up: the text is cut into words once, whatever
    the number of terms and entries. Terms that begin or end with other signs, or have more words
    than are looked up, and patterns are searched for as in ``mentions``.
    """
    lowered_terms = {name: [t if isinstance(t, dict) else t.lower() for t in terms] for name, terms in dictionary.items()}
    known = {name: {t for t in terms if isinstance(t, str) and looked_up(t)} for name, terms in lowered_terms.items()}
    every = set().union(*known.values()) if known else set()
    if not word or len(every) <= SEARCHED_MAX:
        tests = {name: mentions(lowered, terms, word) for name, terms in dictionary.items()}
        return F.array_compact(F.array(*[F.when(test, name) for name, test in tests.items()]))

    def entries(found: Column) -> Column:
        def test(name: str) -> Column:
            rest = [t for t in lowered_terms[name] if isinstance(t, dict) or t not in known[name]]
            own = F.exists(found, lambda t: among(t, known[name]))
            return own | mentions(lowered, rest, word) if rest else own

        return F.array_compact(F.array(*[F.when(test(name), name) for name in dictionary]))

    return let(found_terms(lowered, every), entries)


def assemble(title: Column, body: Column, nulls: str = "skip") -> Column:
    """Title and body as one text.

    ``skip`` drops a missing part, ``propagate`` makes the text null when either part is,
    ``empty`` gives '' when both are missing, ``title`` keeps the title alone when the body is
    missing or empty, ``collapse`` is ``skip`` lower-cased with runs of white space collapsed.
    """
    joined = F.concat_ws(" ", title, body)
    if nulls == "skip":
        return joined
    if nulls == "propagate":
        return F.concat(title, F.lit(" "), body)
    if nulls == "empty":
        return F.coalesce(F.concat(title, F.lit(" "), body), title, body, F.lit(""))
    if nulls == "title":
        return F.when(F.length(body) > 0, joined).otherwise(title)
    if nulls == "collapse":
        return F.lower(F.regexp_replace(joined, r"\s+", " "))
    raise ValueError(f"unknown null handling {nulls!r}")


def normalize(text: Column) -> Column:
    """Lower case, links removed, every run of other characters than a-z as one space."""
    def letters(lowered: Column) -> Column:
        linked = F.contains(lowered, F.lit("http")) | F.contains(lowered, F.lit("www"))
        unlinked = F.when(linked, F.regexp_replace(lowered, r"http\S+|www\S+", "")).otherwise(lowered)
        return F.trim(F.regexp_replace(unlinked, "[^a-z]+", " "))

    return let(F.lower(F.coalesce(text, F.lit(""))), letters)


def tokens(text: Column) -> Column:
    """ASCII word tokens in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def keyword_pattern(keyword: str) -> str:
    """Word-bounded pattern in which hyphen, space and nothing are interchangeable."""
    gap = r"[-\s]?"
    return WORD_START + gap.join(quote(p) for p in re.split(r"[-\s]", keyword.lower())) + WORD_END


def has_keyword(lowered: Column, keyword: str) -> Column:
    """Whether a text has the keyword; the pattern runs only where all its parts occur."""
    parts = [F.contains(lowered, F.lit(p)) for p in re.split(r"[-\s]", keyword.lower()) if p]
    return reduce(and_, parts) & F.rlike(lowered, F.lit(keyword_pattern(keyword)))


def keyword_column(keyword: str) -> str:
    return "mentions_" + re.sub(r"[-\s]", "_", keyword.lower())


def unique_keywords(keywords: Sequence[str]) -> list[str]:
    """Keywords without those that compile to a pattern already seen."""
    seen: dict[str, str] = {}
    for keyword in keywords:
        seen.setdefault(keyword_pattern(keyword), keyword)
    return list(seen.values())


def first_match(lowered: Column, stages: Sequence[tuple[str, Sequence[Term]]], default: str, word: bool = False) -> Column:
    """Name of the first stage that has a matching term."""
    (name, terms), *rest = stages
    label = F.when(mentions(lowered, terms, word), name)
    for name, terms in rest:
        label = label.when(mentions(lowered, terms, word), name)
    return label.otherwise(default)
