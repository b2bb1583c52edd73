"""Exact membership of URLs in lists of hosts and paths, by a cascade of Bloom filters.

A listed key is a host and the start of a path, ``example.org/es/``; a host alone stands for all
its pages. The keys that a corpus can ask for, its universe, are known: of every URL, the host's
suffixes of as many labels and the path's prefixes of as many letters as some listed key has. The
first filter of a cascade encodes the listed keys; the second those keys of the universe that the
first takes wrongly; the third the listed keys that the second takes wrongly; and so on, until no
key is wrong. A key's first filter that lacks it tells whether it is listed. So the answer is exact
for the whole universe, and no URL is joined with a list.

The filters of a list of r keys in a universe of s take about r * log2(s / r) bits, since the first
one's rate of errors is chosen as r / s. They are constants in the plan. A list whose filters would be
larger than ``LITERAL_BITS`` is dealt by hash to several cascades, and each is asked in a branch of
its own for the keys of its share. All steps are expressions and aggregates of DataFrames.

Defined cases: a URL that is null or has no ``://`` has an empty host and path and no listed key; an
empty list or table gives no match; repeated rows stay as rows; columns other than the named ones
pass through, whatever their names; those added replace columns of their names.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, column, stored

#: Bits of the filters that one plan carries as constants (8 MB).
LITERAL_BITS = 1 << 26
#: Rate of errors of all filters but the first.
LATER_RATE = 0.5
WORD = 64


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """``host`` and ``path`` of a URL; A-Z of the host in lower case."""
    pattern = r"://([^/?#]*)([^?#]*)"
    part = lambda group: F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))
    return df.withColumns({"host": ascii_lower(part(1)), "path": part(2)})


def split_key(key: str) -> tuple[str, str]:
    """A listed key's host and path."""
    at = key.find("/")
    return (key, "") if at < 0 else (key[:at], key[at:])


def key_shapes(listed: DataFrame) -> list[tuple[int, int]]:
    """Pairs of host labels and path letters that listed keys ``(key)`` have: few, whatever their number."""
    host = F.substring_index("key", "/", 1)
    labels = F.size(F.split(host, r"\."))
    letters = F.length("key") - F.length(host)
    return sorted(tuple(r) for r in listed.select(labels, letters).distinct().collect())


def candidate_keys(shapes: list[tuple[int, int]]) -> Column:
    """All keys of the shapes that fit a row's host and path, as an array."""
    labels = F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", r"\.")))
    keys = [
        F.when((labels >= n) & (F.length("path") >= letters), F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, letters)))
        for n, letters in shapes
    ]
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    a, b = (F.pmod(F.xxhash64(key, F.lit(level), F.lit(side)), F.lit(bits)) for side in (0, 1))
    return [F.pmod(a + F.lit(i) * b, F.lit(bits)) for i in range(hashes)]


@dataclass(frozen=True)
class Filter:
    """One level: its number, size, number of hashes, and bits as words of 64."""

    level: int
    bits: int
    hashes: int
    words: str

    def takes(self, key: Column) -> Column:
        words = F.from_json(F.lit(self.words), "array<bigint>")  # constant: parsed once for a plan
        positions = _positions(key, self.level, self.bits, self.hashes)
        tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), F.pmod(p, F.lit(WORD)).cast("int")) == 1 for p in positions]
        found = tests[0]
        for test in tests[1:]:
            found = found & test
        return found


def build_filter(keys: DataFrame, count: int, rate: float, level: int) -> Filter:
    """The bits of all keys, set in parallel by word and gathered: their number is bounded by ``count``."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(WORD, -(-int(count * hashes / math.log(2)) // WORD) * WORD)
    set_bits = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("p"))
    one = F.expr("shiftleft(1L, CAST(p % 64 AS INT))")
    rows = set_bits.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("v")).collect()
    words = [0] * (bits // WORD)
    for word, value in rows:
        words[word] = value
    return Filter(level, bits, hashes, json.dumps(words))


@dataclass(frozen=True)
class Cascade:
    """Filters that answer exactly for the keys of a universe."""

    filters: tuple[Filter, ...]

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.filters) % 2 == 1)
        for nth in range(len(self.filters), 0, -1):
            answer = F.when(self.filters[nth - 1].takes(key), answer).otherwise(F.lit(nth % 2 == 0))
        return answer


def _deduplicated(keys: DataFrame, label: str) -> tuple[DataFrame, int]:
    kept = stored(keys.distinct(), label)
    return kept, kept.count()


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """Of a universe ``(key)``, repeats allowed, and listed keys ``(key)``. The universe is scanned twice and not shuffled."""
    listed, r = _deduplicated(listed, "listed")
    if not r:
        return Cascade(())
    s = max(universe.agg(F.approx_count_distinct("key")).first()[0], 2 * r)
    filters = [build_filter(listed, r, min(0.5, r / s), 1)]
    # Only keys that the first filter takes are compared with the list.
    taken, _ = _deduplicated(universe.where(filters[0].takes(F.col("key"))), "taken")
    wrong, count = _deduplicated(taken.join(listed, "key", "left_anti"), "wrong")
    right = listed
    while count:
        level = len(filters) + 1
        filters.append(build_filter(wrong, count, LATER_RATE, level))
        right, wrong = wrong, right.where(filters[-1].takes(F.col("key")))
        wrong, count = _deduplicated(wrong, "wrong")
    return Cascade(tuple(filters))


def listed_matches(urls: DataFrame, lists: dict[str, DataFrame], literal_bits: int = LITERAL_BITS) -> DataFrame:
    """``urls``, with ``host`` and ``path``, and an array column for each list: its keys that fit the URL.

    ``lists`` maps column names to frames ``(key string)``.
    """
    for name, listed in lists.items():
        listed = listed.select("key").where("key is not null")
        shapes = key_shapes(listed)
        keys = candidate_keys(shapes)
        universe = urls.select(F.explode(keys).alias("key"))
        bits_a_key = 1.44 * 32 + 4  # for the largest universe that a key of 32 bits of rarity needs
        shares = max(1, math.ceil(listed.count() * bits_a_key / literal_bits))
        share_of = lambda key, n=shares: F.pmod(F.xxhash64(key), F.lit(n))
        # One share needs no dealing; more are asked one after another, each by its own expression.
        matches = None
        for share in range(shares):
            own = (lambda df: df) if shares == 1 else (lambda df, n=share: df.where(share_of(F.col("key")) == n))
            cascade = build_cascade(own(universe), own(listed))
            asked = keys if shares == 1 else F.filter(keys, lambda k, n=share: share_of(k) == n)
            found = F.filter(asked, cascade.contains)
            if shares == 1:
                matches = found
            else:
                urls = stored(urls.withColumn(name, F.concat(F.col(name), found) if share else found), "asked")
        if shares == 1:
            urls = urls.withColumn(name, matches)
    return urls


def judge_urls(pages: DataFrame, allow: list[str], block: list[str], blocked_hosts: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    Of the rules that fit, the longest decides, ties by name. Without one, a URL is blocked if its
    host or a domain above is among ``blocked_hosts (key)``, and else allowed.
    """
    spark = pages.sparkSession
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    lists = {"_allowed": frame(allow), "_blocked": frame(block), "_hosts": blocked_hosts}
    # Whole rows as one value, so that no name of theirs meets those of the steps.
    others = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows = pages.select(column(url).alias("url"), F.struct(*map(column, others)).alias("row"))
    found = listed_matches(with_host_and_path(rows, "url"), lists)
    ranked = lambda name, verdict: F.transform(name, lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"), F.lit(verdict).alias("verdict")))
    best = F.array_max(F.concat(ranked("_allowed", "allow"), ranked("_blocked", "block")))
    listed = F.when(F.size("_hosts") > 0, "block").otherwise("allow")
    judged = found.withColumn("_best", best)
    return judged.select("row.*", "host", "path", F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", listed).alias("verdict"))
