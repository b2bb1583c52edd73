import random

import numpy as np
import pytest

from agorascope.llm import suffixdedup as S


def brute(docs):
    """Spans and kept bytes; documents by id, null first."""
    seen, out = set(), {}
    order = sorted({k for k, _ in docs}, key=lambda k: (k is not None, k))
    for key in order:
        own = [(t or "").encode() for k, t in docs if k == key]
        for b in own:
            gone = bytearray(len(b))
            for i in range(len(b) - 49):
                if b[i : i + 50] in seen:
                    gone[i : i + 50] = b"\1" * 50
            cuts = [i for i in range(len(b) + 1) if (gone[i] if i < len(b) else 0) != (gone[i - 1] if i else 0)]
            out.setdefault(key, []).append(([tuple(cuts[i : i + 2]) for i in range(0, len(cuts), 2)], bytes(c for c, g in zip(b, gone) if not g)))
        seen.update(b[i : i + 50] for b in own for i in range(len(b) - 49))
    return {k: sorted(v) for k, v in out.items()}


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(([(s.start, s.stop) for s in r.spans], bytes(r.kept)))
    return {k: sorted(v) for k, v in out.items()}


def corpus():
    r = random.Random(5)
    some = lambda n: "".join(r.choice("abcdefgh é\n") for _ in range(n))
    lines, docs = [some(r.choice((40, 49, 50, 51, 90, 700))) for _ in range(12)], []
    for i in range(70):
        docs.append((i // 2 if i < 10 else i, some(r.randint(0, 80)) + "".join(r.choice(lines) + some(r.randint(0, 60)) for _ in range(r.randint(0, 4)))))
    docs += [(80, docs[20][1]), (81, docs[20][1]), (None, docs[30][1]), (82, "z" * 400), (83, "z" * 120), (84, None), (85, ""), (86, "x" * 49), (87, lines[5] + "\0" * 60), (88, "\0" * 55)]
    return docs


@pytest.mark.parametrize("group", [50_000, 3])
def test_by_brute_force(spark, monkeypatch, group):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    if group == 3:  # nearly all triggers are too large to be sorted at once
        from pyspark import cloudpickle

        monkeypatch.setattr(S, "GROUP", group)
        cloudpickle.register_pickle_by_value(S)
    try:
        assert found(S.repeated_passages(df)) == brute(docs)
    finally:
        if group == 3:
            cloudpickle.unregister_pickle_by_value(S)


def test_sample_by_brute_force(spark, sample):
    df, rows = sample
    assert found(S.repeated_passages(df)) == brute([(k, t) for k, t, _ in rows])


def test_smallest_places_and_rolling_hash():
    h = np.random.default_rng(0).integers(0, 9, 300).astype(np.uint64) << np.uint64(32)
    for width in (1, 2, 3, 8, 39):
        assert S.smallest_places(h, width).tolist() == [i + int(np.argmin(h[i : i + width])) for i in range(301 - width)]
    h = S.rolling_hashes(np.frombuffer(b"abcdefghijklmnop--abcdefghijklmnop", np.uint8), 12)
    assert (h[:5] == h[18:23]).all() and len(set(h.tolist())) == len(h) - 5


def test_odd_rows_keep_columns_and_empty_table(spark, odd, none):
    df = S.repeated_passages(odd)
    assert {"a.b", "tick`s", "key", "rest", "score"} <= set(df.columns) and df.columns.count("kept") == 1
    assert found(df) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert S.repeated_passages(none).count() == 0
