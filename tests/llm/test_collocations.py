"""Phrases against a plain count of all of them."""

import random
import re
from collections import Counter

import duckdb
import pytest
from agorascope.llm import collocations as C, queries

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows: list[tuple[str | None, str | None]], least: int = 30, top: int = 2000) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        n = sum(f for p, f in own.items() if len(p) == 1)
        found = []
        for p, a in own.items():
            if len(p) < 2 or a < least:
                continue
            longer = [q for q, f in own.items() if f >= least and len(q) > len(p) and 100 * f >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not longer:
                score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i, p.decode(), -a, l, r, n, -score) for i, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def rows_of(df) -> list[tuple]:
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    vocabulary = ["new", "York", "city", "of", "the", "Ünï", "中文", "a\x00b", "x\x1cy", " "]
    rows = []
    for _ in range(400):
        words = [r.choice(vocabulary[: r.randint(2, 10)]) + r.choice([" ", " ", "\t", "  ", ", ", "\n", "! "]) for _ in range(r.randint(0, 60))]
        rows.append((r.choice(["en", "en", "en", "und", None, "Δ"]), "".join(words)))
    rows += [("en", "One Two three FOUR five. ")] * 40 + [("en", "two three four")] * 5 + [(None, None), ("en", None), ("xx", ""), ("xx", ".,;")]
    return rows


@pytest.mark.parametrize("chunk, top", [(1 << 21, 2000), (300, 7)])
def test_by_brute_force(spark, texts, chunk, top):
    df = spark.createDataFrame(texts, "lang string, text string").repartition(5)
    got = rows_of(C.collocations(df, top=top, chunk_tokens=chunk))
    assert got == brute(texts, top=top) and {"en", "und", "Δ"} == {g[0] for g in got}
    assert ("en", "one two three four", 40) in {(g[0], g[2], g[3]) for g in got} or top == 7


def test_sql_counterpart_on_the_same_texts(spark, texts):
    import pandas as pd

    documents = pd.DataFrame(texts, columns=["lang", "text"])  # noqa: F841
    got = duckdb.sql(queries.ORACLES["op13_collocations"]).fetchall()
    assert sorted(tuple(r) for r in got) == brute(texts)


def test_every_length_and_its_neighbours(spark, texts):
    _, levels = C.count_phrases(spark.createDataFrame(texts, "lang string, text string"), least=5)
    own = {}
    for lang, text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    key = (lang or "und", " ".join(w[i : i + size]), size)
                    own[key] = own.get(key, 0) + 1
    assert {(r.lang, r.phrase): r.f for r in levels[0].collect()} == {k[:2]: f for k, f in own.items() if f >= 5 and k[2] == 1}
    for size, found in enumerate(C.merge_streams(levels), 2):
        rows = found.collect()
        assert {(r.lang, r.phrase): r.f for r in rows} == {k[:2]: f for k, f in own.items() if f >= 5 and k[2] == size}
        assert all(len(r.lefts) == len(r.rights) == size - 1 and min(r.lefts + r.rights) >= r.f for r in rows)


def test_exact_beyond_64_bits(spark):
    big = 2**61
    df = spark.createDataFrame([(big, [big + 1], [big + 2])], "f bigint, lefts array<bigint>, rights array<bigint>")
    cut = df.selectExpr(f"{C._CUT} as cut").first().cut
    assert cut.score == 2_000_000 * big // (2 * big + 3)


def test_odd_rows_of_texts(spark, odd, none):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert rows_of(C.collocations(odd)) == brute(rows)
    assert C.collocations(none).count() == 0


def test_sample_by_brute_force(spark, sample):
    df, rows = sample
    texts = [(lang, text) for _, text, lang in rows]
    assert rows_of(C.collocations(df)) == brute(texts)
