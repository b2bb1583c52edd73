"""Licence notices in texts, by ordered signature rules.

A text's words are looked up in the rules' keywords, and only the rules of which a keyword occurs
are tried. Every spelling that a pattern accepts has one of its rule's keywords, which is checked, so
this finds what trying all rules would. Each match is an interval of words with the rule's rank. Matches are taken by rank, then the
longer, then the earlier; one that lies within an interval already taken is suppressed. So "GNU
General Public License, version 3" isn't also a bare "General Public License".

Base phrases are looked up as they are, at all places, and never suppressed.

Defined cases: a null text has no words; repeated rows stay as rows; an empty table gives no rows;
columns besides ``doc_id`` and ``text`` aren't read; a rule whose pattern could match nothing, or
whose keywords aren't words, is an error when rules are read, and one that accepts a spelling without
its keywords before texts are.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _parser as syntax

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import alnum_words, arrow_map, slices
from .license_rules import RULES

#: Phrases that are always counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

FOUND = (
    "doc_id bigint, n_words bigint, base array<struct<first:bigint,label:string>>, "
    "detections array<struct<first:bigint,last:bigint,label:string,rule:int,weight:double>>"
)


@dataclass(frozen=True)
class Rule:
    rank: int
    label: str
    weight: float
    pattern: re.Pattern


#: In a spelling, any character that isn't told.
ANY = "\0"


def spellings(pattern: str) -> set[str]:
    """What a pattern matches; sets of more than ten characters stand as ``ANY``, and open repeats end after one more."""

    def of(node) -> set[str]:
        kind, value = str(node[0]), node[1]
        if kind == "LITERAL":
            return {chr(value)}
        if kind == "IN":
            told: set[str] = set()
            for what, x in value:
                if str(what) not in ("LITERAL", "RANGE"):
                    return {ANY}
                told |= {chr(x)} if str(what) == "LITERAL" else set(map(chr, range(x[0], x[1] + 1)))
            return told if len(told) <= 10 else {ANY}
        if kind == "ANY":
            return {ANY}
        if kind == "BRANCH":
            return set().union(*map(row, value[1]))
        if kind == "SUBPATTERN":
            return row(value[-1])
        if kind in ("MAX_REPEAT", "MIN_REPEAT"):
            once = row(value[2])
            return {"".join(x) for n in range(value[0], min(value[1], value[0] + 1) + 1) for x in product(once, repeat=n)}
        raise ValueError(f"not for rules: {kind}")

    def row(nodes) -> set[str]:
        out = {""}
        for node in nodes:
            out = {a + b for a in out for b in of(node)}
        return out

    return row(syntax.parse(pattern))


def _spelled(pattern: str) -> str:
    return pattern.replace("LICd", "licen[cs]ed").replace("LICs", "licen[cs]es?").replace("LIC", "licen[cs]e").replace("VER", "(?:version |ver |v |v)?")


def _parts(text: str) -> Iterator[tuple[int, str, str, list[str], str]]:
    lines = [line for line in text.splitlines() if line.strip() and not line.startswith("#")]
    for rank, line in enumerate(lines):
        label, weight, keywords, pattern = (part.strip() for part in line.split(";", 3))
        yield rank, label, weight, sorted(k for part in keywords.split(",") for k in spellings(part.strip())), _spelled(pattern)


def ungated(text: str = RULES) -> list[tuple[str, str]]:
    """Patterns, each with a spelling that has none of its rule's keywords: none, for right rules."""
    return [(pattern, s) for _, _, _, keywords, pattern in _parts(text) for s in sorted(spellings(pattern)) if not set(keywords) & set(s.split(" "))]


def read_rules(text: str = RULES) -> dict[bytes, list[Rule]]:
    """Rules by keyword, from lines ``label; weight; keywords; pattern`` in order of rank. A rule is under each of its keywords."""
    rules: dict[bytes, list[Rule]] = {}
    for rank, label, weight, keywords, pattern in _parts(text):
        compiled = re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )")
        if any(alnum_words(k) != [k.encode()] for k in keywords) or compiled.search(b"  "):
            raise ValueError(f"not a rule: {label}; {', '.join(keywords[:4])}; {pattern}")
        rule = Rule(rank, label, float(weight), compiled)
        for keyword in keywords:
            rules.setdefault(keyword.encode(), []).append(rule)
    return rules


def suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """What remains of matches (first word, last word, rule), by place."""
    kept: list[tuple[int, int, Rule]] = []
    firsts: list[int] = []  # taken intervals, none within another, so both ends ascend
    lasts: list[int] = []
    for first, last, rule in sorted(found, key=lambda x: (x[2].rank, x[0] - x[1], x[0])):
        at = bisect_left(lasts, last)
        if at < len(firsts) and firsts[at] <= first:
            continue
        kept.append((first, last, rule))
        end = bisect_left(firsts, first)
        stop = end
        while stop < len(lasts) and lasts[stop] <= last:  # taken ones within this interval
            stop += 1
        firsts[end:stop], lasts[end:stop] = [first], [last]
    return sorted(kept, key=lambda x: (x[0], x[1], x[2].rank))


def scan(words: list[bytes], rules: dict[bytes, list[Rule]], base: dict[bytes, str]) -> tuple[list[tuple[int, str]], list[tuple[int, int, Rule]]]:
    """Base places and detections of one text."""
    keywords = rules.keys() & set(words)
    line = b" " + b" ".join(words) + b" "
    starts: list[int] | None = None

    def word_at(place: int) -> int:
        nonlocal starts
        if starts is None:
            starts, at = [], 1
            for word in words:
                starts.append(at)
                at += len(word) + 1
        return bisect_left(starts, place)

    places: list[tuple[int, str]] = []
    for phrase, label in base.items():
        at = line.find(b" " + phrase + b" ")
        while at >= 0:
            places.append((word_at(at + 1), label))
            at = line.find(b" " + phrase + b" ", at + 1)
    found = []
    for rule in {r.rank: r for keyword in keywords for r in rules[keyword]}.values():
        for match in rule.pattern.finditer(line):
            found.append((word_at(match.start()), word_at(match.end() + 1) - 1, rule))
    return sorted(places), suppressed(found)


def scan_licenses(docs: DataFrame, rules: str = RULES, base: dict[str, str] = BASE) -> DataFrame:
    """Words, base places and detections of every whole text: ``FOUND``. Words count from 0."""
    phrases = {b" ".join(alnum_words(phrase)): label for phrase, label in base.items()}
    read_rules(rules)  # errors show here, not in a task
    if gaps := ungated(rules):
        raise ValueError(f"not in its rule's keywords: {gaps[0][1]!r} of {gaps[0][0]!r}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = read_rules(rules)
        types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("label", pa.string())])), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("rule", pa.int32()), ("weight", pa.float64())]))]
        for batch in slices(batches, 1024):
            sizes, bases, detections = [], [], []
            for text in batch.column(1):
                words = alnum_words(text.as_py())
                places, found = scan(words, compiled, phrases)
                sizes.append(len(words))
                bases.append([{"first": at, "label": label} for at, label in places])
                detections.append([{"first": a, "last": b, "label": r.label, "rule": r.rank, "weight": r.weight} for a, b, r in found])
            values = (batch.column(0).cast(pa.int64()), pa.array(sizes, types[1]), pa.array(bases, types[2]), pa.array(detections, types[3]))
            yield pa.record_batch(list(values), ["doc_id", "n_words", "base", "detections"])

    return arrow_map(docs.select("doc_id", "text"), search, FOUND)
