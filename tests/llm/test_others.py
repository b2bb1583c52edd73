"""Tokens, packing, licences, languages, the class model, and nearest vectors."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agorascope.llm import classlm, langid, licenses, onebit, packing, queries, tokenbin
from agorascope.llm.encoder import Encoder
from agorascope.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


# Token ids

@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_any_tokenizer_file_are_the_librarys(sample, name):
    own, whole = Encoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    assert own.known_rule == (name == "word_bpe_49k.json")
    texts = ["Mixed CASE, don't  stop\n\n42 times; é ß 中文 \U0001F600 <|endoftext|> x", " lead and trail \t", "", *[t for _, t, _ in sample[1] if t][:40]]
    for text in texts:
        assert np.frombuffer(own.encode(text), own.dtype).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_encoder_gives_the_librarys_ids(library, sample):
    tool = Encoder(PATH)
    texts = [t for _, t, _ in sample[1]] + [
        "a<|endoftext|>b c", "İstanbul ß×÷ ÀÉ x", "don't I'LL 's1 1a２ ...'s", "ΟΔΟΣ οδος", "é å", "a​b 　c \x1c d \x85 e\x1f", "x" * 5000,
        "ÿŸ ª º µ ½ ²", "\x00\x01 \x7f", "été ́x", "汉字 かな", "", " \n", "\U0001F600!?", "'S 'Re it'd",
    ]
    assert all(np.frombuffer(tool.encode(t), tool.dtype).tolist() == library.encode(t, add_special_tokens=False).ids for t in texts)
    assert tool.encode(None) == b""


@pytest.mark.parametrize("percentile", [1, 50, 90, 100])
def test_blocks_round_trip(percentile):
    r = np.random.default_rng(0)
    for n in (0, 1, 127, 128, 129, 1000, 20_000):
        for high in (1, 2, 300, 49_408, 2**32 - 1):
            ids = r.integers(0, high, n).astype(np.uint32)
            ids[::17] = min(5, high - 1)
            payload = tokenbin.pack(ids, percentile)
            assert (tokenbin.unpack(payload) == ids).all()
            if n == 1000:
                assert (tokenbin.unpack_blocks(payload, 2, 4) == ids[256:512]).all()


def expected_ids(library, rows, end):
    return [(k, np.array([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4")) for k, t in rows]


def test_written_ids_by_brute_force(spark, library, sample):
    df, rows = sample
    got = queries.QUERIES["op6_token_blocks"](spark, "/root/testdata/sf0.001")
    start, want = 0, []
    for key, ids in expected_ids(library, [(k, t) for k, t, _ in rows], 1):
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows_in_blocks(spark, library, odd, none):
    path = scratch_dir(spark, "odd")
    tokenbin.write_ids(odd, path, PATH, 1)
    got = sorted((tuple(r) for r in tokenbin.read_documents(spark, path).collect()), key=lambda r: r[1])
    order = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for row, (key, ids) in zip(got, expected_ids(library, order, 1), strict=True):
        assert row == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    path = scratch_dir(spark, "none")
    tokenbin.write_ids(none, path, PATH, 1)
    assert tokenbin.read_documents(spark, path).count() == 0


# Packing

def check_packing(library, rows, pieces, window):
    docs = collections.defaultdict(list)
    for key, text in rows:
        docs[key].append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
        assert any(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 and len(ids) == p.doc_tokens for ids in docs[p.doc_id])
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window and at & (at - 1) == 0  # so there is no padding
    total = sum(len(ids) for own in docs.values() for ids in own)
    assert sum(p.length for p in pieces) == total
    for key, own in docs.items():
        covered = collections.Counter(i for p in pieces if p.doc_id == key for i in range(p.start, p.start + p.length))
        assert covered == collections.Counter(i for ids in own for i in range(len(ids)))
    return sequences


def test_packing_covers_each_id_once(spark, library, sample):
    df, rows = sample
    pieces = queries.QUERIES["op10_lexical_packing"](spark, "/root/testdata/sf0.001").collect()
    check_packing(library, [(k, t) for k, t, _ in rows], pieces, 4096)


def test_packing_of_odd_rows_small_windows_and_shards(spark, library, odd, none):
    pieces = packing.pack_documents(odd, PATH, 2, window=64, shard_tokens=100).collect()
    check_packing(library, [(r.doc_id, r.text) for r in odd.collect()], pieces, 64)
    assert packing.pack_documents(none, PATH, 2).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(none, PATH, 2, window=100)


def test_windows_take_neighbours_by_bm25():
    r = np.random.default_rng(1)
    topics = [r.integers(1000 * t, 1000 * t + 40, 30) for t in range(4) for _ in range(3)]
    tails = [topics[i] for i in r.permutation(12)]
    filled = list(packing.windows(tails, 90))
    assert sum(n for w in filled for _, _, n in w) == 360 and all(len({tails[t][0] // 1000 for t, _, _ in w}) == 1 for w in filled)
    index = packing.Bm25(tails)
    scores = np.zeros(len(tails))
    sizes = np.array([len(t) for t in tails])
    for term in np.unique(tails[0]):
        df = sum(term in t for t in tails)
        if 2 * df <= len(tails):
            for i, t in enumerate(tails):
                n = (t == term).sum()
                scores[i] += np.log1p((len(tails) - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * sizes[i] / sizes.mean()))
    want = [i for i in np.lexsort((np.arange(12), -scores.round(9))) if scores[i] > 0]
    assert sorted(index.neighbours(tails[0], np.ones(12, bool)).tolist()) == sorted(want)
    assert index.neighbours(tails[0], np.ones(12, bool))[0] == want[0]


# Licences

def test_rules_are_many_and_read():
    rules = licenses.read_rules()
    assert sum(map(len, rules.values())) > 250
    for bad in ("x; 1; two words; a b", "x; 1; a; a*"):
        with pytest.raises(ValueError):
            licenses.read_rules(bad)


def labels(text):
    words = licenses.alnum_words(text)
    base = {p.encode(): label for p, label in licenses.BASE.items()}
    places, found = licenses.scan(words, licenses.read_rules(), base)
    return places, [(a, b, r.label) for a, b, r in found]


@pytest.mark.parametrize("text,want", [
    ("GNU General Public License, version 3", {"gpl-3.0"}), ("the general public licence", {"gpl"}), ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2.0-or-later"}),
    ("Licensed under the Apache License, Version 2.0", {"apache-2.0"}), ("CC BY-SA 4.0", {"cc-by-sa-4.0"}), ("the new BSD license", {"bsd-3-clause"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", {"mit"}), ("https://creativecommons.org/licenses/by-nc/4.0/", {"cc-by-nc"}),
    ("tous droits réservés", {"reserved"}), ("no such thing here", set()), ("mozilla public license version 2.0 and mit license", {"mpl-2.0", "mit"}),
])
def test_signatures(text, want):
    assert {label for _, _, label in labels(text)[1]} == want


def test_keywords_lose_no_match_of_any_rule_and_spelling():
    assert licenses.ungated() == []
    assert licenses.ungated("x; 1; b; a b?") == [("a b?", "a ")]
    keyed = licenses.read_rules()
    rules = list({r.rank: r for own in keyed.values() for r in own}.values())
    tried = set()
    for _, _, _, _, pattern in licenses._parts(licenses.RULES):
        for spelling in random.Random(0).sample(told := sorted(licenses.spellings(pattern)), min(len(told), 200)):
            text = spelling.replace(licenses.ANY, "7").strip()
            words = licenses.alnum_words(text)
            line = b" " + b" ".join(words) + b" "
            found = [(line[: m.start()].count(b" ") - 1, line[: m.end()].count(b" ") - 1, r) for r in rules for m in r.pattern.finditer(line)]
            assert licenses.scan(words, keyed, {})[1] == licenses.suppressed(found), text
            tried |= {r.rank for _, _, r in found}
    assert tried == {r.rank for r in rules}


@pytest.mark.parametrize("text,want", [
    ("End-User License Agreement", {"eula"}), ("Open Software License version 3.0", {"osl-3.0"}), ("FreeBSD license", {"bsd-2-clause"}),
    ("for noncommercial use only", {"non-commercial"}), ("Beerware license", {"beerware"}), ("Open RAIL-M license", {"openrail"}), ("\u00a92020", {"copyright"}),
    ("Common Development and Distribution License Version 1.1", {"cddl-1.1"}),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions", {"mit"}),
    ("Permission to use, copy, modify, and distribute this software and its documentation", {"hpnd"}),
])
def test_rules_whose_keyword_was_not_in_the_text(text, want):
    assert {label for _, _, label in labels(text)[1]} == want


def test_suppression_keeps_no_interval_within_a_better_one():
    r = random.Random(0)
    rule = lambda rank: licenses.Rule(rank, str(rank), 1.0, None)
    for _ in range(300):
        found = [(a, a + r.randint(0, 9), rule(r.randint(0, 5))) for a in (r.randint(0, 20) for _ in range(r.randint(0, 12)))]
        want = []
        for x in sorted(found, key=lambda x: (x[2].rank, x[0] - x[1], x[0])):
            if not any(k[0] <= x[0] and x[1] <= k[1] for k in want):
                want.append(x)
        assert licenses.suppressed(found) == sorted(want, key=lambda x: (x[0], x[1], x[2].rank))


def test_base_places_by_brute_force(spark, sample, odd, none):
    df, rows = sample
    planted = [(1000 + i, t) for i, t in enumerate(["cc by cc-by CC.BY", "All rights, reserved. General Public License", "ccby all rights", "all rights reserved " * 3])]
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + planted, "doc_id bigint, text string")
    for r in licenses.scan_licenses(docs).collect():
        words = [w.decode() for w in licenses.alnum_words(dict([(k, t) for k, t, _ in rows] + planted)[r.doc_id])]
        want = sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        assert [(b.first, b.label) for b in r.base] == want and r.n_words == len(words)
    assert licenses.scan_licenses(odd).count() == odd.count() and licenses.scan_licenses(none).count() == 0


def test_license_query_keeps_base_labels(spark):
    for r in queries.QUERIES["op5_license_scan"](spark, "/root/testdata/sf0.001").collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.n_base == 0) == (r.first_word is None) == (r.base_labels == "")


# Languages

def test_held_out_languages(spark):
    rows = queries.QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect()
    true = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {k for k in true if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_backoff_by_brute_force(spark):
    texts = [("aa", "Der hund und die katze, die maus"), ("aa", "hund"), ("bb", "the cat and the dog; mouse"), (None, "ignored words"), ("bb", None)]
    model = langid.fit(spark.createDataFrame(texts, "lang string, text string"), cutoff=0.01, longest=3)
    counts = {lang: collections.Counter(w for k, t in texts if k == lang for w in langid.words_of(t)) for lang in ("aa", "bb")}

    def score(word):
        if any(word in c for c in counts.values()):
            return [math.log10(c[word] / sum(c.values())) if word in c else -7 for c in counts.values()]
        for size in (3, 2, 1):
            tables = []
            for c in counts.values():
                grams = collections.Counter()
                for w, n in c.items():
                    for i in range(len(w) + 3 - size):
                        grams[f" {w} "[i : i + size]] += n
                tables.append({g: n / grams.total() for g, n in grams.items() if n / grams.total() >= 0.01})
            own = [g for i in range(len(word) + 3 - size) if any((g := f" {word} "[i : i + size]) in t for t in tables)]
            if own:
                return [sum(math.log10(t[g]) if g in t else -7 for g in own) / len(own) for t in tables]
        return None

    judge = langid.Judge(model)
    for text in ("die hunde", "dogs and catz zzz", "THE", "qqq katzen xx"):
        scores = [s for s in map(score, langid.words_of(text)) if s]
        means = [sum(x) / len(scores) for x in zip(*scores)] if scores else [0.0, 0.0]
        odds = [10 ** (m - max(means)) for m in means]
        lang, share = judge.predict(text)
        assert lang == ("aa", "bb")[odds.index(1.0)] and share == pytest.approx(1 / sum(odds))


def test_odd_texts_have_a_language_or_none(spark, odd, none, sample):
    model = langid.fit(sample[0])
    found = langid.identify(odd, model)
    assert found.columns.count("score") == 1 and "tick`s" in found.columns
    for r in found.collect():
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
    assert langid.identify(none, model).count() == 0
    nothing = langid.fit(none)
    assert {(r.lang_pred, r.score) for r in langid.identify(odd.select("text"), nothing).collect()} == {("und", 0.0)}


# The class model

def test_base_scores_by_brute_force_and_gain_on_held_out(spark, sample):
    df, rows = sample
    got = {r.doc_id: r for r in queries.QUERIES["op7_class_model"](spark, "/root/testdata/sf0.001").collect()}
    tokens = {k: [*(t or "").encode().lower().split(), b"\n"] for k, t, _ in rows}
    counts = collections.Counter(w for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in t)
    total, distinct = sum(counts.values()), len(counts)
    for key, own in tokens.items():
        want = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        r = got[key]
        assert r.base_score == pytest.approx(want) and r.n_tokens == len(own) and r.n_known == sum(w in counts for w in own) and r.train_tokens == total
        assert r.held_out == (zlib.crc32(str(key).encode()) % 5 == 1) and r.score < 0
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exchange_finds_classes_and_probabilities_sum_to_one(spark):
    r = random.Random(2)
    names, verbs = [f"n{i}" for i in range(8)], [f"v{i}" for i in range(8)]
    texts = [(i, True, " ".join(w for _ in range(6) for w in (r.choice(names), r.choice(verbs)))) for i in range(300)] + [(900, True, "odd"), (901, True, "strange n1")]
    chunks = classlm.tokenise(spark.createDataFrame(texts, "doc_id bigint, train boolean, text string"), 500)
    totals, stats = classlm.word_totals(chunks, 0.01)
    of, joint = classlm.exchange(classlm.bigrams(chunks, stats.words), stats, classes=2, rounds=8)
    kind = {w.decode(): c for w, c in zip(stats.words, of.tolist())}
    assert {kind[w] for w in names} != {kind[w] for w in verbs} and len({kind[w] for w in names}) == len({kind[w] for w in verbs}) == 1
    model = classlm.build_model(stats, of, joint)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    for c in range(2):
        assert sum(10 ** model.emission[i] for i in range(len(stats.words)) if of[i] == c) == pytest.approx(1)
    assert stats.rare_tokens == 2 and stats.rare_distinct == 2 and joint.sum() == stats.tokens


def test_best_class_gains_what_the_likelihood_gains():
    r = np.random.default_rng(3)
    pairs = r.integers(0, 20, (12, 12))
    of = r.integers(0, 4, 12)

    def likelihood(of):
        joint = np.zeros((4, 4))
        np.add.at(joint, (of[:, None], of[None, :]), pairs)
        sides = joint.sum(axis=1), joint.sum(axis=0)
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        return joint, f(joint) - f(sides[0]) - f(sides[1])

    pairs = pairs + pairs.T  # as often before as after, as in circular texts
    for word in range(12):
        joint, now = likelihood(of)
        before, after = np.bincount(of, pairs[:, word], 4), np.bincount(of, pairs[word], 4)
        best, gain = classlm.best_class(joint, of[word], before, after, pairs[word, word], 4)
        values = [likelihood(np.where(np.arange(12) == word, c, of))[1] for c in range(4)]
        assert values[best] == pytest.approx(max(values)) and gain == pytest.approx(max(values) - now)


def test_many_words_choose_as_each_alone():
    r = np.random.default_rng(4)
    pairs = r.integers(0, 9, (40, 40)) * (r.random((40, 40)) < 0.2)
    pairs = pairs + pairs.T
    of = np.append(r.integers(0, 5, 38), [5, 6])
    joint = np.zeros((7, 7))
    np.add.at(joint, (of[:, None], of[None, :]), pairs)
    words = np.arange(38)
    before, after = (np.array([np.bincount(of, x[w], 7) for w in words]) for x in (pairs.T, pairs))
    best, gain = classlm.best_classes(joint, of[words], before, after, np.diagonal(pairs)[words], 5)
    want = [classlm.best_class(joint, of[w], before[w], after[w], pairs[w, w], 5) for w in words]
    assert gain == pytest.approx([g for _, g in want]) and (best == [b for b, _ in want]).all()


def test_all_words_of_five_tokens_have_classes_and_neighbours(spark, sample):
    df, rows = sample
    chunks = classlm.tokenise(df.select("doc_id", F.lit(True).alias("train"), "text"), 3000)
    totals, stats = classlm.word_totals(chunks)
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for _, t, _ in rows]
    counts = collections.Counter(w for own in tokens for w in own)
    listed = stats.words.listed()
    assert len(listed) == len({w for w, _ in listed}) and dict(listed) == {w: n for w, n in counts.items() if n >= 5 or w == b"\n"}
    assert any(n < 5e-5 * stats.tokens or n == 5 for _, n in listed)
    pairs = classlm.bigrams(chunks, stats.words)
    of, joint = classlm.exchange(pairs, stats, classes=4, rounds=0)
    number = {w: i for i, (w, _) in enumerate(listed)}
    kind = lambda w: of[number.get(w, len(listed))]
    want = np.zeros((6, 6))
    for c in chunks.collect():  # the last of a chunk stands before its first
        own = [bytes(c.words[i]) for i in c.tokens]
        for a, b in zip([own[-1], *own], own):
            want[kind(a), kind(b)] += 1
    assert (joint == want).all()
    last = classlm.exchange(pairs, stats, classes=4)[1]
    value = lambda j: classlm._entropy(j).sum() - 2 * classlm._entropy(j.sum(axis=1)).sum()
    assert value(last) > value(joint) and last.sum() == stats.tokens


def test_scores_by_brute_force(spark, sample):
    """Every text's probability from plain counts of the classes that the exchange finds."""
    df, rows = sample
    learn = df.withColumn("train", F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in classlm.score_documents(learn, classes=6, rounds=3).collect()}
    chunks = classlm.tokenise(learn)
    _, stats = classlm.word_totals(chunks)
    of, _ = classlm.exchange(classlm.bigrams(chunks, stats.words), stats, classes=6, rounds=3)
    number = {w: i for i, (w, _) in enumerate(stats.words.listed())}
    tokens = {k: [*(t or "").encode().lower().split(), b"\n"] for k, t, _ in rows}
    counts = collections.Counter(w for k, own in tokens.items() if k % 3 for w in own)
    kind = {w: int(of[number[w]]) if w in number else 6 for own in tokens.values() for w in own}
    joint = np.zeros((8, 8))
    for c in chunks.collect():  # the last of a chunk stands before its first
        learned = np.repeat(c.train, c.sizes)
        own = [kind[bytes(c.words[i])] for i, use in zip(c.tokens, learned) if use]
        for a, b in zip([own[-1], *own], own):
            joint[a, b] += 1
    size = joint.sum(axis=0)
    rare = sum(n for w, n in counts.items() if w not in number)
    distinct = sum(w not in number for w in counts)
    share = (size + 0.5) / (size.sum() + 0.5 * 8)
    for k, own in tokens.items():
        want, before = 0.0, 7
        for w in own:
            c = kind[w]
            step = (joint[before, c] + classlm.SMOOTHING * share[c]) / (joint[before].sum() + classlm.SMOOTHING)
            word = counts[w] / size[c] if w in number else (counts[w] + 0.5) / (rare + 0.5 * (distinct + 1))
            want, before = want + math.log10(step * word), c
        assert got[k] == pytest.approx(want, rel=1e-9)


def test_class_model_of_odd_rows(spark, odd, none):
    learn = odd.withColumn("train", F.col("doc_id") != 5)
    rows = classlm.score_documents(learn, chunk_tokens=4).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r.score) and r.n_tokens >= 1 for r in rows)
    unlearned = classlm.score_documents(odd.withColumn("train", F.lit(None).cast("boolean"))).collect()
    assert all(r.base_score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in unlearned)
    assert classlm.score_documents(none.withColumn("train", F.lit(True))).count() == 0


# Nearest vectors

def brute_nearest(rows, divisor, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    sizes = collections.Counter(len(v) for _, v in good)
    size = max(sizes, key=lambda n: (sizes[n], -n)) if sizes else 0
    good = [(i, v) for i, v in good if len(v) == size]
    out = []
    for q, x in good:
        if q % divisor == 0:
            ranked = sorted((-(float(x @ v) / float(np.linalg.norm(x) * np.linalg.norm(v))), i) for i, v in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)]
    return out


def test_recall_and_scores_on_the_sample(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op9_nearest_vectors"](spark, "/root/testdata/sf0.01").collect())
    want = sorted(brute_nearest(rows, 50, 5))
    hits = len({(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want})
    assert hits >= 0.9 * len(want)
    score = {(q, i): s for q, _, i, s in brute_nearest(rows, 50, 1000)}
    assert all(abs(score[q, i] - s) < 1e-12 for q, _, i, s in got)


@pytest.mark.parametrize("block", [2048, 3])
def test_ties_copies_and_unusable_vectors(spark, block):
    r = random.Random(4)
    v = [r.gauss(0, 1) for _ in range(6)]
    rows = [(i, v) for i in range(30)] + [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(30, 60)]
    rows += [(60, None), (70, []), (80, [0.0] * 6), (90, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (100, [float("nan")] * 6), (110, [float("inf")] + [1.0] * 5), (120, [1.0, 2.0]), (None, v), (130, [1e-30 * x for x in v]), (140, [1e30 * x for x in v])]
    df = spark.createDataFrame([(i, x, "a") for i, x in rows], "vec_id bigint, embedding array<float>, score string").repartition(4)
    held = [(x.vec_id, x.embedding) for x in df.collect()]
    got = sorted(tuple(x) for x in onebit.nearest(df, 10, 5, block=block).collect())
    want = sorted(brute_nearest(held, 10, 5))
    assert [x[:2] for x in got] == [x[:2] for x in want] and all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(got, want))
    assert [x[2] for x in got if x[0] == 0] == [1, 2, 3, 4, 5] or {x[2] for x in got if x[0] == 0} <= {*range(1, 30), 130, 140}


def test_double_vectors_of_any_size(spark):
    r = random.Random(12)
    rows = []
    for i in range(60):
        size = 10.0 ** r.choice([-200, 0, 200])
        rows.append((i, [r.gauss(0, 1) * size for _ in range(8)]))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(x) for x in onebit.nearest(df, divisor=10, k=3, epsilon=10.0).orderBy("query_id", "rank").collect()]
    scaled = [(i, [x / max(map(abs, v)) for x in v]) for i, v in rows]
    want = sorted(brute_nearest(scaled, 10, 3))
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_fewer_candidates_than_asked_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in onebit.nearest(df).collect()] == [(0, 1, 1)]
    assert onebit.nearest(df.where("vec_id = 0")).count() == 0 and onebit.nearest(df.where("false")).count() == 0
