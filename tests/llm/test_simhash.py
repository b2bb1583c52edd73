import random

import numpy as np
import pytest
import xxhash

from agorascope.llm import components as C, simhash as S


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(codes):
    arr, parent = np.array(codes, np.uint64), list(range(len(codes)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 4):
            parent[max(top(i), top(int(j)))] = min(top(i), top(int(j)))
    return [top(i) for i in range(len(codes))]


def test_sample_by_brute_force(spark, sample):
    df, rows = sample
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()}
    codes = [brute_fingerprint(t) for _, t, _ in rows]
    roots = brute_components(codes)
    assert got == {k: (f"{c:016x}", rows[r][0]) for (k, _, _), c, r in zip(rows, codes, roots)}


@pytest.mark.parametrize("bucket", [4096, 20])
def test_links_of_dense_groups(spark, monkeypatch, bucket):
    r, codes = random.Random(1), set()
    for _ in range(20):
        center = r.getrandbits(64)
        codes |= {center} | {center ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 6))) for _ in range(20)}
    center = r.getrandbits(64)
    codes |= {center ^ sum(1 << b for b in r.sample(range(32), r.randint(1, 3))) for _ in range(150)}  # one key of the first segment
    codes = sorted(codes)
    if bucket == 20:
        from pyspark import cloudpickle

        monkeypatch.setattr(S, "BUCKET", bucket)
        cloudpickle.register_pickle_by_value(S)
    try:
        signed = np.array(codes, np.uint64).view(np.int64).tolist()
        links = S.near_links(spark.createDataFrame([(c,) for c in signed], "code bigint"))
        got = {r.node: r.root for r in C.components(links).collect()}
    finally:
        if bucket == 20:
            cloudpickle.unregister_pickle_by_value(S)
    groups = {}
    for code, root in zip(signed, brute_components(codes)):
        groups.setdefault(root, []).append(code)
    assert got == {c: min(g) for g in groups.values() for c in g if c != min(g)}


def test_components_of_a_long_chain_a_hub_and_no_links(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in C.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 50)} | {201: 200}
    assert C.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_odd_rows_and_empty_table(spark, odd, none):
    rows = S.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {0: 0, 1: 0, 2: 0}
    assert {r.component_id for r in rows if r.doc_id == 7} == {3}
    assert S.near_duplicates(none).count() == 0 and S.first_of_groups(none).count() == 0
    kept = sorted((r.doc_id, r.text or "") for r in S.first_of_groups(odd).collect() if r.doc_id is not None)
    assert [k for k, _ in kept] == [0, 3, 3, 4, 5, 6, 8]
