"""Samples of an exact size against ordering all rows."""

import hashlib

import pytest
from agorascope.operators import clusters, resampling


def fraction(key, seed):
    text = str(seed) + (f":{key}" if key is not None else "")
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


@pytest.mark.parametrize("n, ranges", [(40, 1 << 16), (40, 4), (1, 1), (0, 16), (5000, 8)])
def test_exactly_n_of_each_stratum(spark, n, ranges):
    rows = [(i, "a" if i % 3 else None, "x") for i in range(900)] + [(5000 + i, "few", "y") for i in range(7)] + [(None, "none", "z")]
    df = spark.createDataFrame(rows, "id int, `s.t` string, __range string").withColumnRenamed("__range", "other").repartition(6)
    got = {}
    for r in resampling.exact_sample(df, "id", n, ["s.t"], seed=9, ranges=ranges).collect():
        got.setdefault(r[1], []).append(r[0])
    for stratum in {r[1] for r in rows}:
        own = sorted((r[0] for r in rows if r[1] == stratum), key=lambda i: (fraction(i, 9), i or 0))[:n]
        assert sorted(got.get(stratum, []), key=str) == sorted(own, key=str)


def test_of_all_rows_repeated_rows_and_none(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(200)], "id int")
    assert resampling.exact_sample(df, "id", 30).count() == 30
    small, large = ({r.id for r in resampling.exact_sample(df.distinct(), "id", n).collect()} for n in (10, 20))
    assert len(small) == 10 and len(large) == 20 and small < large
    assert resampling.exact_sample(df.where("false"), "id", 5).count() == 0
    with pytest.raises(ValueError):
        resampling.exact_sample(df, "id", -1)


def test_sweep_judged_on_a_sample(spark):
    rows = [(i, i % 2, (i // 2) % 2, int(i % 7 == 0)) for i in range(300)]
    vectors = spark.createDataFrame(rows, "id int, a int, b int, c int")
    full = clusters.kmeans_sweep(vectors, ["a", "b", "c"], [2, 3]).collect()
    part = clusters.kmeans_sweep(vectors, ["a", "b", "c"], [2, 3], key="id", judged_rows=60).collect()
    assert [r.inertia for r in full] == [r.inertia for r in part] and all(-1 <= r.silhouette <= 1 for r in part)
    assert [r.silhouette for r in part] == [r.silhouette for r in clusters.kmeans_sweep(vectors, ["a", "b", "c"], [2, 3], key="id", judged_rows=60).collect()]
