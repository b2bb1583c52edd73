import random
import re

import pytest

from agorascope.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            n = min(window, len(p))
            for own in {tuple(p[i : i + n]) for i in range(len(p) - n + 1)} if n else ():
                for i in range(len(w) - n + 1):
                    if tuple(w[i : i + n]) == own:
                        hit |= set(range(i, i + n))
                        found |= {item}
        out.append((key, len(w), len(hit), sorted(f for f in found if f is not None)))
    return sorted(out, key=repr)


def cases():
    r = random.Random(3)
    some = lambda n: " ".join(r.choice("ab cd éf gh 1x".split()) for _ in range(n))
    items = [(1, "Ab, cd; éF"), (2, some(9)), (2, some(4)), (3, ""), (4, None), (5, "gh"), (None, "cd cd cd"), (6, some(5))]
    docs = [(i, some(r.randint(0, 40))) for i in range(60)] + [(7, "AB.CD-éf"), (8, None), (9, ""), (None, "gh gh")]
    return docs, items


@pytest.mark.parametrize("block,shard", [(1 << 20, 1 << 20), (1 << 20, 50), (12, 50)])
def test_windows_by_brute_force(spark, block, shard):
    docs, items = cases()
    texts, benchmark = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found = D.judged(D.benchmark_hits(texts, benchmark, 4, block_words=block, shard_words=shard))
    got = sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in found.collect()), key=repr)
    assert got == brute(docs, items, 4)


def test_sample_by_brute_force_and_contamination_rule(spark, sample):
    df, rows = sample
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    planted = [(1000, "x " * 20 + items[0][1]), (1001, "y " * 2000 + " ".join(items[1][1].split()[:13]))]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + planted, "doc_id bigint, text string")
    found = D.judged(D.benchmark_hits(docs, benchmark)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, sorted(r["items"])) for r in found), key=repr) == brute([(k, t) for k, t, _ in rows] + planted, items, 13)
    judged = {r.doc_id: r.contaminated for r in found}
    assert judged[1000] and not judged[1001]


def test_proximity_takes_any_order_within_reach_and_one_document(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha x x x x x x x beta gamma"), (4, "alpha beta"), (5, "gamma")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    found = {r.doc_id: r["items"] for r in D.benchmark_hits(docs, items, 3, reach=5).collect()}
    assert found == {1: [1], 2: [1], 3: [], 4: [], 5: []}


def test_odd_rows_and_empty_tables(spark, odd, none):
    benchmark = spark.createDataFrame([(1, "all rights reserved")], "item_id bigint, text string")
    found = D.benchmark_hits(odd, benchmark).collect()
    assert len(found) == odd.count() and [r.doc_id for r in found if r["items"]] == [None]
    assert D.benchmark_hits(none, benchmark).count() == 0
    assert all(not r["items"] for r in D.benchmark_hits(odd, benchmark.where("false")).collect())
