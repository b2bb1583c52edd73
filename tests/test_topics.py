"""Topics of two periods: determinism, pairs by plain distances, vocabulary by plain counts."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from agorascope.operators import topics

SETTINGS = {"k": 2, "iterations": 8, "min_df": 2, "vocabulary": 50}


@pytest.fixture(scope="module")
def texts(spark):
    r = random.Random(11)
    sound, price, case = ["bass", "treble", "noise", "music", "loud"], ["price", "cheap", "deal", "money", "sale"], ["case", "lid", "cable", "port", "charge"]
    rows = []
    for i in range(160):
        period = "before" if i < 80 else "after"
        group = r.choice([sound, price] if period == "before" else [sound, case])
        rows.append((f"k{i}", period, " ".join(r.choice(group) for _ in range(12)) + " the and https"))
    return spark.createDataFrame([*rows, ("e", "empty", "the and"), ("n", "before", None)], "key string, period string, text string").repartition(5)


def test_topics_repeat_and_are_distributions(spark, texts):
    rows = [topics.topics_by_period(texts, ["before", "after"], terms=5, **SETTINGS).orderBy("period", "topic_num").collect() for _ in range(2)]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    assert not any(w in {"the", "and", "https"} for r in rows[0] for w in r.top_terms.split(", "))
    before, after = topics.fit_topics(texts, ["before", "after"], **SETTINGS)
    assert np.allclose(before.distributions.sum(axis=1), 1) and before.documents == 81 and before.log_perplexity is None
    assert {w for w in after.vocabulary} == {"bass", "treble", "noise", "music", "loud", "case", "lid", "cable", "port", "charge"}


def test_held_out_texts_judge_a_model(spark, texts):
    fitted = topics.fit_topics(texts.where("text is not null"), ["before", "after", "empty", "none"], train=0.75, **SETTINGS)
    table = {r.period: r for r in topics.topic_fit(spark, fitted).collect()}
    for period in ("before", "after"):
        r = table[period]
        assert r.documents + r.held_out == 80 and r.held_out > 5
        assert r.perplexity == pytest.approx(math.exp(r.log_perplexity)) and 1 < r.perplexity < 60
    assert table["empty"].perplexity is None and table["none"].documents == 0


def test_closest_topics_are_paired(spark, texts):
    before, after = topics.fit_topics(texts, ["before", "after"], **SETTINGS)
    apart = topics.distances(before, after)
    words = sorted({*before.vocabulary, *after.vocabulary})
    for i, p in enumerate(before.distributions):
        for j, q in enumerate(after.distributions):
            a, b = ([dict(zip(t.vocabulary, d)).get(w, 0.0) for w in words] for t, d in ((before, p), (after, q)))
            divergence = sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(a, b)) / 2
            assert apart[i, j] == pytest.approx(math.sqrt(max(divergence, 0)), abs=1e-9)
    pairs = topics.paired_topics(spark, before, after).collect()
    assert pairs[0].distance == pytest.approx(apart.min()) and {p.first_topic for p in pairs} == {0, 1} == {p.second_topic for p in pairs}
    assert set(pairs[0].shared_terms.split(", ")) <= {"bass", "treble", "noise", "music", "loud"}
    alone = topics.paired_topics(spark, before, topics.PeriodTopics("x", [], np.zeros((0, 0)), 0, 0, None)).collect()
    assert [(r.first_topic, r.second_topic) for r in alone] == [(0, None), (1, None)]


def test_vocabulary_by_plain_counts(spark, texts):
    got = {(r.period, r.term): (r.occurrences, r.documents, r.period_documents) for r in topics.period_vocabulary(texts, 7, 2).collect()}
    want = {}
    rows = texts.collect()
    for period in ("before", "after"):
        own = [[w for w in (r.text or "").lower().split() if w not in {"the", "and", "https"}] for r in rows if r.period == period]
        total, found = Counter(w for t in own for w in t), Counter(w for t in own for w in set(t))
        for w in sorted((w for w in total if found[w] >= 2), key=lambda w: (-total[w], w))[:7]:
            want[period, w] = (total[w], found[w], len(own))
    assert got == want
