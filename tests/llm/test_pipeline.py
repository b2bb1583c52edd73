"""Each stage of the pipeline against a brute-force version, on odd rows, and as a whole."""

import random

import corpus_pipeline as P
import pytest
from agorascope.llm import langid
from test_decontaminate import brute as brute_hits
from test_simhash import brute_components, brute_fingerprint
from test_suffixdedup import brute as brute_passages

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(spark, sample):
    """The sample with copies, near copies, junk, shared passages and benchmark passages."""
    r, rows = random.Random(9), [(k, t, lang, "s", len(t)) for k, t, lang in sample[1]]
    items = [x.text for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    some = lambda n: " ".join("".join(r.choice("aeinrst") for _ in range(r.randint(2, 8))) for _ in range(n))
    passage, long = some(60), some(400)
    words = long.split()
    words[200] = "changed"
    add = [long, long, " ".join(words), some(40) + " " + passage, some(40) + " " + passage, some(30) + " " + items[0], some(900) + " " + " ".join(items[1].split()[:13]), "12 34 !!", None, ""]
    rows += [(1000 + i, t, "en" if i < 7 else None, "s", len(t or "")) for i, t in enumerate(add)]
    return rows, spark.createDataFrame(rows, COLUMNS)


def test_language_stage_drops_what_has_no_letters(spark, planted):
    rows, df = planted
    got = P.identify_language(spark, df, FOLDER)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in rows if langid.words_of(r[1]))


def test_near_duplicate_stage(spark, planted):
    rows, df = planted
    roots = brute_components([brute_fingerprint(r[1]) for r in rows])
    first = {}
    for root, row in zip(roots, rows):
        first[root] = min(first.get(root, row[0]), row[0])
    got = P.drop_near_duplicates(spark, df, FOLDER)
    assert got.columns == df.columns and sorted(tuple(r) for r in got.collect()) == sorted((r for r in rows if r[0] in first.values()), key=lambda r: r[0])
    assert {1001, 1002} & {r.doc_id for r in got.collect()} == set()


def test_passage_stage(spark, planted):
    rows, df = planted
    want = brute_passages([(r[0], r[1]) for r in rows])
    got = P.cut_repeated_passages(spark, df, FOLDER)
    assert got.columns == df.columns and got.count() == len(rows)
    for r in got.collect():
        old = next(x for x in rows if x[0] == r.doc_id)
        text = want[r.doc_id][0][1].decode("utf-8", "ignore")
        assert (r.text or "") == text and (r.text is None) == (old[1] is None) and r.n_chars == (len(text) if text != old[1] else old[4]) and r.lang == old[2]


def test_decontamination_stage(spark, planted):
    rows, df = planted
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {k for k, n, hit, _ in brute_hits([(r[0], r[1]) for r in rows], items, 13) if hit and 20 * hit >= n}
    got = P.drop_contaminated(spark, df, FOLDER)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in rows if r[0] not in dirty)
    assert 1005 in dirty and 1006 not in dirty


@pytest.mark.parametrize("stage", P.STAGES, ids=[n for n, _ in P.STAGES])
def test_stages_take_odd_rows_and_empty_tables(spark, odd, none, stage):
    for docs in (odd, none):
        got = stage[1](spark, docs, FOLDER)
        assert got.count() <= max(odd.count() * 400, 0) and (stage[0] == "lexical_packing" or got.columns == docs.columns)
    assert stage[1](spark, none, FOLDER).count() == 0


def test_whole_pipeline(spark):
    pieces = P.run(spark, FOLDER).collect()
    sizes = {}
    for p in pieces:
        sizes[p.sequence_id] = sizes.get(p.sequence_id, 0) + p.length
    assert pieces and all(n & (n - 1) == 0 for n in sizes.values())
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert {p.doc_id for p in pieces} <= {r.doc_id for r in docs.select("doc_id").collect()}
