"""Column expressions on edge cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

from agorascope import presets
from agorascope.functions import numeric, phrases, sampling, text as tx, time as tm
from agorascope.functions.binding import add_kept
from agorascope.functions.valence import ValenceLexicon, add_valence, category
from agorascope.operators import mentions


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_epoch_seconds_millis_and_null(spark):
    df = spark.createDataFrame([(1700000000,), (1700000000123,), (None,), (10**12,)], "e long")
    got = values(df, F.unix_seconds(tm.epoch_timestamp(F.col("e"))))
    assert got == [1700000000, 1700000000, None, 10**12]


def test_dirty_numbers(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,), ("-3",)], "s string")
    assert values(df, numeric.whole_or_zero(F.col("s"))) == [7, 0, 0, -3]


def test_bins_are_inclusive_above(spark):
    scores = [-5, 0, 1, 2, 5, 6, 10, 11, 25, 26, 50, 51, 100, 101, None]
    df = spark.createDataFrame([(s,) for s in scores], "s int")
    got = values(df, numeric.bins(F.col("s"), presets.SCORE_EDGES, presets.SCORE_BINS, "missing"))
    assert got == ["<=1"] * 3 + ["2-5"] * 2 + ["6-10"] * 2 + ["11-25"] * 2 + ["26-50"] * 2 + ["51-100"] * 2 + ["100+", "missing"]


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "a int, b int")
    assert df.agg(numeric.pearson(F.col("a"), F.col("b"))).first()[0] is None
    assert df.agg(numeric.pearson(F.col("a"), F.col("a"))).first()[0] == pytest.approx(1)


@pytest.mark.parametrize("mode,expected", [
    ("skip", ["t b", "t", "b", "", "t "]),
    ("propagate", ["t b", None, None, None, "t "]),
    ("empty", ["t b", "t", "b", "", "t "]),
    ("title", ["t b", "t", "b", None, "t"]),
])
def test_text_assembly(spark, mode, expected):
    df = spark.createDataFrame([("t", "b"), ("t", None), (None, "b"), (None, None), ("t", "")], "title string, body string")
    assert values(df, tx.assemble(F.col("title"), F.col("body"), mode)) == expected


def test_literals_are_not_patterns(spark):
    df = spark.createDataFrame([("i like c++",), ("i like ccc",), (None,)], "t string")
    assert values(df, tx.mentions(F.col("t"), ["C++"])) == [True, False, None]
    assert values(df, tx.mentions(F.col("t"), [{"re": "c+$"}])) == [False, True, None]


def test_words_end_at_accents_and_punctuation(spark):
    df = spark.createDataFrame([("la voilà",), ("voilla",), ("élaé",), ("(la)",), ("la_x",)], "t string")
    assert values(df, tx.mentions(F.col("t"), ["la"], word=True)) == [True, False, True, True, False]


def test_occurrences(spark):
    df = spark.createDataFrame([("aaaa app apple happy",), (None,), ("",)], "t string")
    assert values(df, tx.occurrences(F.col("t"), "app")) == [3, 0, 0]
    assert values(df, tx.occurrences(F.col("t"), "aa")) == [2, 0, 0]
    assert values(df, tx.occurrences(F.col("t"), "app", word=True)) == [1, 0, 0]
    assert values(df, tx.occurrences(F.col("t"), {"re": "ap+"}, word=True)) == [1, 0, 0]


def test_normalize(spark):
    df = spark.createDataFrame([("See HTTPS://x.y/z and www.a.b, it's  GREAT!\n5 stars",), (None,), ("",)], "t string")
    assert values(df, tx.normalize(F.col("t"))) == ["see and it s great stars", "", ""]


def test_keywords_that_compile_alike_count_once():
    assert tx.unique_keywords(["usb-c", "usb c", "worth it"]) == ["usb-c", "worth it"]


def test_keyword_gaps(spark):
    df = spark.createDataFrame([("a usb-c plug",), ("a usb c plug",), ("usbc",), ("usb-cable",)], "t string")
    assert values(df, tx.has_keyword(F.col("t"), "usb-c")) == [True, True, True, False]


def test_journey_stage_precedence(spark):
    df = spark.createDataFrame([("bought it, now broken",), ("which one",), ("arrived",), ("still fine",), ("hm",), (None,)], "t string")
    got = values(df, tx.first_match(F.col("t"), presets.JOURNEY_STAGES, presets.JOURNEY_DEFAULT))
    assert got == ["troubleshooting", "research", "post-purchase", "long-term use", "general discussion", "general discussion"]


def test_add_kept_keeps_every_passing_row(spark):
    df = spark.range(10)
    got = add_kept(df, "x", F.col("id") * 2, lambda x: x >= 10)
    assert sorted(r["x"] for r in got.collect()) == [10, 12, 14, 16, 18]


def test_sample_is_stable_and_near_its_fraction(spark):
    df = spark.range(20000)
    one = {r[0] for r in df.where(sampling.in_sample(F.col("id"), 0.2, 1)).collect()}
    two = {r[0] for r in df.repartition(7).where(sampling.in_sample(F.col("id"), 0.2, 1)).collect()}
    assert one == two and 3600 < len(one) < 4400


WORDS = ValenceLexicon({"good": 2.0, "bad": -2.0}, {"very": 0.293, "slightly": -0.293}, frozenset({"not"}))


def squash(s):
    return round(s / math.sqrt(s * s + 15), 4)


@pytest.mark.parametrize("text,total", [
    ("good", 2.0),
    ("bad", -2.0),
    ("not good", 2.0 * -0.74),
    ("not very good", (2.0 + 0.293) * -0.74),
    ("very bad", -2.293),
    ("slightly good", 1.707),
    ("very x y good", 2.0 + 0.293 * 0.9),
    ("not a b c good", 2.0),
    ("GOOD day", 2.733),
    ("GOOD DAY", 2.0),
    ("good but bad", 2.0 * 0.5 - 2.0 * 1.5),
    ("VERY good day", 2.0 + 0.293 + 0.733),
    ("VERY bad day", -2.0 - 0.293 - 0.733),
    ("VERY GOOD", 2.293),
    ("never so good", 2.0 * 1.25),
    ("never x this good", 2.0 * 1.25),
    ("never so x good", 2.0 * 1.25),
    ("not this good", 2.0 * -0.74),
    ("without a doubt good", 2.0),
    ("without doubt good", 2.0),
    ("least good", 2.0 * -0.74),
    ("at least good", 2.0),
    ("very least good", 2.0 + 0.293 * 0.95),
    ("good!!", 2.0 + 2 * 0.292),
    ("good!!!!!!", 2.0 + 4 * 0.292),
    ("bad??", -2.0 - 2 * 0.18),
    ("bad?????", -2.0 - 0.96),
    ("", 0.0),
    (None, 0.0),
    ("!!!", 0.0),
    ("nothing here", 0.0),
])
def test_valence_rules(spark, text, total):
    df = spark.createDataFrame([(text,)], "t string")
    assert add_valence(df, "t", WORDS).first()["sentiment_score"] == pytest.approx(squash(total), abs=1e-4)


PHRASES = ValenceLexicon(
    {"good": 2.0, "bad": -2.0, "für": 1.0, "bad ass": 1.5, "kiss of death": -1.5, "bus stop": 0.0, "kiss": 1.0, "stop": -1.0, ":)": 2.0, "<3": 1.9, ":d": 2.3, ":-(": -1.9},
    {"very": 0.293, "kind of": -0.293, "kind of very": 0.5}, frozenset({"not", "far from"}),
)


@pytest.mark.parametrize("text,total", [
    ("a kiss of death", -1.5),  # an idiom counts instead of its words
    ("a kiss of Death, really", -1.5),
    ("a kiss of a death", 1.0),
    ("BAD ASS day", 1.5 + 0.733),
    ("bad bad ass", -2.0 + 1.5),
    ("at the bus stop", 0.0),
    ("stop at the bus", -1.0),
    ("not a kiss of death", -1.5 * -0.74),
    ("very bad ass", 1.5 + 0.293),
    ("kind of good", 2.0 - 0.293),  # boosters of two words, at the distance of one
    ("kind of x good", 2.0 - 0.293 * 0.95),
    ("kind of very good", 2.0 + 0.5),  # the longest
    ("kind of bad", -2.0 + 0.293),
    ("KIND OF good", 2.0 - 0.293 + 0.733),
    ("kind off good", 2.0),
    ("far from good", 2.0 * -0.74),  # a negator of two words
    ("far good", 2.0),
    ("fun :)", 2.0),
    (":) :)", 4.0),
    ("fun:)", 0.0),
    ("(:)", 0.0),
    ("well :D", 2.3),
    ("not :)", 2.0 * -0.74),
    ("good <3 but :-(", 2.0 * 0.5 + 1.9 * 0.5 - 1.9 * 1.5),
    ("bus :) stop", 2.0 - 1.0),  # an emoticon is a word between others
    ("für", 1.0),  # letters of any script
    ("fü r", 0.0),
    ("FÜR alle", 1.0 + 0.733),
    ("中文 good", 2.0),  # no capitals, as there is no lower case
])
def test_valence_of_phrases_and_emoticons(spark, text, total):
    df = spark.createDataFrame([(text,)], "t string")
    assert add_valence(df, "t", PHRASES).first()["sentiment_score"] == pytest.approx(squash(total), abs=1e-4)


def test_longest_phrases_from_left_to_right(spark):
    known = ["a b", "b c", "a b c d", "d e", "x"]
    df = spark.createDataFrame([("a b c d e",), ("a b c",), ("b c d e x",), ("a",), ("",), ("e a",)], "t string")
    words = F.filter(F.split("t", " "), lambda w: w != "")
    found = df.select("t", phrases.merged(words, phrases.longest_phrases(words, known)).alias("m"))
    assert {r.t: r.m for r in found.collect()} == {
        "a b c d e": ["a b c d", "e"], "a b c": ["a b", "c"], "b c d e x": ["b c", "d e", "x"], "a": ["a"], "": [], "e a": ["e", "a"]}
    assert values(df, F.size(phrases.longest_phrases(words, []))) == [0] * 6


def test_many_whole_word_terms_by_lookup_as_by_pattern(spark):
    r = random.Random(7)
    parts = ["usb", "c", "b&o", "life", "battery", "5.3", "naïve", "x_y", "noise", "anc", "-", "a"]
    many = {"w%d" % i for i in range(3000)} | {"battery life", "usb-c", "usb c", "5.3", "noise  anc", "b&o", "a b c d", "a b c d e", ".net", "c++", "x_y", "Battery", "naïve"}
    terms = sorted(many)
    dictionary = {"one": terms[::3], "two": terms[1::3], "three": terms[2::3] + [{"re": "li[fv]es?"}], "none": ["zzz"]}
    texts = ["".join(r.choice(parts + ["w%d" % r.randint(0, 4000)]) + r.choice([" ", " ", "  ", "-", "", "++", "."]) for _ in range(r.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in [*texts, "a b c d e", "use .net", "x.net", "c++", "noise anc", "noise  anc", "my lives", "", None]], "t string")
    want = {n: F.rlike("t", F.lit(tx.word_pattern(terms))) for n, terms in dictionary.items()}
    rows = df.select("t", tx.matched_names(F.col("t"), dictionary, word=True).alias("names"), *[F.coalesce(w, F.lit(False)).alias(n) for n, w in want.items()]).collect()
    for row in rows:
        assert row.names == [n for n in dictionary if row[n]]
    assert sum(len(row.names) for row in rows) > 100
    single = df.select(*[F.coalesce(tx.mentions(F.col("t"), terms, word=True), F.lit(False)).alias(n) for n, terms in dictionary.items()]).collect()
    assert [tuple(s) for s in single] == [tuple(row[n] for n in dictionary) for row in rows]
    counts = mentions.feature_mentions(df, "t", dictionary, word=True).collect()
    assert {c.feature: c.mentions for c in counts} == {n: sum(row[n] for row in rows) for n in dictionary}


def test_category_edges(spark):
    df = spark.createDataFrame([(0.05,), (0.049,), (-0.05,), (-0.049,)], "s double")
    assert values(df, category(F.col("s"))) == ["Positive", "Neutral", "Negative", "Neutral"]
