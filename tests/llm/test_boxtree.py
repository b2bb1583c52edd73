"""Hard negatives against all pairs, and trees against their bounds."""

import math
import random

import numpy as np
import pytest
from agorascope.llm import boxtree as B, queries


def brute(rows: list[tuple], divisor: int = 100, positives: int = 5, negatives: int = 10) -> list[tuple]:
    rows = [(i, l, [math.floor(256 * x) for x in v]) for i, v, l in rows]
    out = []
    for anchor, label, v in rows:
        if anchor % divisor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, l == label) for i, l, w in rows if i != anchor)
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            hard = [(i, -n) for n, i, same in scored if not same and 30 * -p <= 100 * -n <= 90 * -p][:negatives]
            out += [(anchor, pid, rank, nid, -p, n) for rank, (nid, n) in enumerate(hard, 1)]
    return sorted(out)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*B.RESULT).collect())


SCHEMA = "vec_id bigint, embedding array<double>, label int, rank string, tile string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def clustered():
    r = random.Random(4)
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(8)]
    rows = [(i, [c + r.gauss(0, 0.4) for c in centres[i % 8 if i % 3 else 0]], r.choice([0, 0, 0, 1, 2, 3])) for i in range(1500)]
    # A third of the rows are one vector; some products are negative or zero, some components large.
    rows += [(2000 + i, centres[0], i % 2) for i in range(700)] + [(3000 + i, [0.0] * 6, 1) for i in range(5)]
    return rows + [(4000, [1e6, -2e6, 3e5, 1e-9, 0.0, 7.0], 2), (4100, [-c for c in centres[0]], 9), (-100, [3e6] * 6, 3)]


@pytest.mark.parametrize("settings", [{}, {"anchors": 7, "shard_rows": 300, "leaf": 16}])
def test_by_brute_force(spark, clustered, settings):
    got = rows_of(B.mine(frame(spark, clustered), **settings))
    assert got == brute(clustered) and len(got) > 500


def test_given_vectors(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert rows_of(queries.QUERIES["op12_hard_negatives"](spark, folder)) == brute(rows)


def test_rows_that_take_no_part_repeated_rows_and_none(spark, clustered):
    nan, inf = float("nan"), float("inf")
    rows = clustered[:400]
    odd = [(100, None, 1), (700, [1.0] * 6, None), (None, [1.0] * 6, 1), (800, [1.0] * 5 + [nan], 1), (900, [inf] + [0.0] * 5, 1),
           (1000, [None] + [1.0] * 5, 1), (1100, [], 1), (1200, [1.0], 1), (1300, [1e300] * 6, 1)]
    assert rows_of(B.mine(frame(spark, rows + odd))) == brute(rows)
    twice = [(7, [0.5, 1.0], 1)] * 2 + [(0, [1.0, 1.0], 1)] * 2 + [(8, [0.5, 0.5], 2)] * 2
    assert rows_of(B.mine(frame(spark, twice))) == sorted((0, 7, rank, 8, 98304, 65536) for _ in range(2) for rank in (1, 2))
    assert B.mine(frame(spark, rows).where("false")).count() == 0
    assert B.mine(frame(spark, [(1, [1.0], 1)])).count() == 0
    assert B.mine(frame(spark, [(0, [1.0], 1)])).count() == 0
    assert B.mine(frame(spark, [(0, [], 1), (1, [], 1), (2, [], 2)])).count() == 1  # all scores are zero


def tree_of(x, labels, leaf=8, fanout=3):
    rows = np.column_stack([labels, x])
    found = list(B.packed(rows, [0, *range(1, rows.shape[1])], leaf))
    assert sorted(np.concatenate(found)) == list(range(len(x))) and max(map(len, found)) <= leaf
    return B.Tree([(p, labels[p], x[p]) for p in found], fanout), found


def test_boxes_bound_what_is_below_them():
    r = np.random.default_rng(5)
    x, labels = r.integers(-300, 300, (200, 5)), r.integers(0, 4, 200)
    tree, found = tree_of(x, labels)
    assert len(tree.children[-1]) > 0 and len(found) == len(tree.leaves)
    q = B.Queries(np.arange(9), r.integers(0, 4, 9), r.integers(-300, 300, (9, 5)), np.full(9, -2000), np.full(9, 90000), False, 3)

    def below(node):
        return [i for c in tree.children[node] for i in below(c)] if tree.children[node] else list(found[node])

    for node in range(len(tree.children)):
        bound = tree.bounds(q, [node])[:, 0]
        for n in range(9):
            fits = [s for i in below(node) if labels[i] != q.labels[n] and -2000 <= (s := int(q.vectors[n] @ x[i])) <= 90000]
            assert not fits or bound[n] >= max(fits)


def test_search_prunes_boxes_and_finds_all():
    r = np.random.default_rng(6)
    centres = r.integers(-2000, 2000, (20, 4))
    x = centres[r.integers(0, 20, 4000)] + r.integers(-30, 30, (4000, 4))
    labels = r.integers(0, 3, 4000)
    tree, _ = tree_of(x, labels, 32, 8)
    opened, take = [], B._take
    q = B.Queries(np.arange(30), labels[:30], x[:30], np.full(30, -10**6), np.full(30, 10**7), True, 5)
    ids, best = np.zeros((30, 5), np.int64), np.full((30, 5), B.NONE)
    B._take = lambda tree, leaf, q, rows, *rest: (opened.append(len(rows)), take(tree, leaf, q, rows, *rest))
    try:
        B.search(tree, q, ids, best)
    finally:
        B._take = take
    for n in range(30):
        want = sorted((-int(x[n] @ x[i]), i) for i in range(4000) if i != n and labels[i] == labels[n] and -10**6 <= x[n] @ x[i] <= 10**7)[:5]
        assert [(-b, i) for b, i in zip(best[n].tolist(), ids[n].tolist()) if b != B.NONE] == want
    assert sum(opened) < 0.25 * 30 * len(tree.leaves)


def test_scores_beyond_doubles_are_exact():
    a, b = np.array([[2**30 + 1, 1]]), np.array([[2**30 + 3, 5], [-(2**30), 2**29]])
    assert B._scores(a, b, 2.0**31).tolist() == [[(2**30 + 1) * (2**30 + 3) + 5, -(2**30 + 1) * 2**30 + 2**29]]
    assert B.windows(7, 30, 90) == (3, 6) and B.windows(0, 30, 90) == (0, 0) and B.windows(2**60, 30, 90)[1] == 90 * 2**60 // 100
