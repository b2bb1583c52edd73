"""Passages that repeat across documents, by prefix-free parsing and suffix sorting of the dictionary.

A byte goes if it lies in a string of ``LENGTH`` bytes (50) that also starts in a document with a
smaller ``doc_id``. Texts are parsed at triggers of a rolling hash of 20 bytes, which depend on
content alone, so copies are parsed alike wherever they lie.

1. Long phrases end where the hash is 0 modulo 256. A phrase stands for all 50-byte strings that
   start in it, so it is kept with the 49 bytes that follow: no phrase of the dictionary is then
   another's prefix or part by chance of position. Of equal phrases only those of the smallest
   document can hold new strings; all strings of the others repeat. Each document gets the list of
   phrases of which it is the first: at most its own, however many copies there are.
2. Short phrases are the runs of 50-byte strings with one trigger, which is the smallest hash in
   the string. Strings can only be equal if their triggers' hashes are, so a trigger that is in one
   document alone shows its strings to be new. Only short phrases of triggers in several documents,
   within new long phrases, go into the second dictionary, each with its first document.
3. The dictionary is sorted by trigger. Of each task's part the suffixes of 50 bytes and more are
   sorted (a suffix array), equal strings stand together, and the first document of any of their
   phrases is the corpus's first one. A trigger with more phrases than ``GROUP`` isn't held at once:
   its strings' digests are aggregated by Spark. Each first document gets a bit for each string of
   its phrases; in other documents all strings of a phrase repeat.

The order of the corpus is that of ``doc_id``, so the parse need not be sorted itself: a phrase's
place in it is its first document. What returns to a document is about its own phrases only, and
these lists are bounded by its text, however many copies there are.

Defined cases: a null text is empty; a null ``doc_id`` is before all others; rows with one ``doc_id``
are one document's, and don't repeat each other; texts under 50 bytes, and empty tables, have
nothing to remove; all other columns pass through, but for
such with names of the three added ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from .common import arrow_map, column, stored, text_slices

LENGTH = 50
GRAM = 20
LONG_PHRASE = 256
#: Short phrases of one trigger that a task sorts at once.
GROUP = 50_000
#: Short phrases that a task holds before it hands them on, and strings that it sorts at once.
HELD, SORTED = 100_000, 300_000
#: Bytes of texts that are parsed together, unless one text is longer.
BATCH_BYTES = 250_000
FIRST_KEY = -(1 << 63)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def rolling_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The hash of each run of ``gram`` bytes: a polynomial modulo 2 ** 64, mixed."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(data) - 1, _INVERSE)]))
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE)]))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down)])
        h = (sums[gram:] - sums[:-gram]) * up
        h ^= h >> np.uint64(31)
        h *= _MIX
        h ^= h >> np.uint64(29)
        h *= _BASE
        h ^= h >> np.uint64(32)
    return h


def smallest_places(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the place of the smallest by its upper 32 bits, the first of equal ones."""
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    done, skipped, size = None, 0, 1
    while True:  # minima over 1, 2, 4, ... hashes, joined to one over ``width``
        if width & size:
            if done is None:
                done = least
            else:
                right = least[skipped : skipped + len(done)]
                done = np.minimum(done[: len(right)], right)
            skipped += size
        if 2 * size > width:
            return (done[: len(h) - width + 1] & np.uint64(0xFFFFFFFF)).astype(np.int32)
        least = np.minimum(least[size:], least[:-size])
        size *= 2


class Parse:
    """The documents of a batch, parsed together."""

    def __init__(self, texts: list[bytes], short: bool = True):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.bytes = b"".join(texts)
        data = np.frombuffer(self.bytes, np.uint8)
        self.hashes = rolling_hashes(data)
        # Strings: places where 50 bytes of one document start.
        last = np.maximum(self.ends - LENGTH + 1, self.starts)
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, self.starts, 1)
        np.add.at(change, last, -1)
        self.whole = np.cumsum(change[:-1]) > 0
        # A document's first phrase starts with it. A trigger counts only if its bytes are all the document's.
        at = np.flatnonzero(self.hashes % np.uint64(LONG_PHRASE) == 0)
        own = np.searchsorted(self.ends, at, "right")
        at = at[at + GRAM <= self.ends[own]]
        self.cuts = np.unique(np.concatenate([self.starts[sizes > 0], at]))
        if short and len(self.whole):
            places = smallest_places(self.hashes, LENGTH - GRAM + 1) if len(data) >= LENGTH else np.zeros(0, np.int32)
            self.trigger = np.full(len(data), -1, np.int32)
            self.trigger[: len(places)] = places
            self.trigger[~self.whole] = -1
        else:
            self.trigger = np.zeros(0, np.int32)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def long_phrases(self) -> tuple[np.ndarray, list[bytes]]:
        """The document and digest of each long phrase in which strings start."""
        docs = self.document(self.cuts)
        ends = np.minimum(np.append(self.cuts[1:], len(self.bytes)), self.ends[docs] if len(docs) else 0)
        stops = np.minimum(ends + LENGTH - 1, self.ends[docs] if len(docs) else 0)
        view, digest = memoryview(self.bytes), xxhash.xxh3_128_digest
        return docs, [digest(view[a:b]) for a, b in zip(self.cuts.tolist(), stops.tolist())]

    def short_phrases(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the runs of wanted strings with one trigger."""
        key = np.where(wanted, self.trigger, -1)
        change = np.flatnonzero(np.diff(key)) + 1
        firsts, lasts = np.concatenate([[0], change]), np.concatenate([change, [len(key)]]) - 1
        there = key[firsts] >= 0 if len(key) else np.zeros(0, bool)
        return firsts[there], lasts[there]


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text", BATCH_BYTES):
        docs, digests = Parse(_texts(batch.column(1)), short=False).long_phrases()
        keys = batch.column(0).to_numpy()
        yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(keys[docs])], ["phrase", "key"])


def _triggers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text", BATCH_BYTES):
        parse = Parse(_texts(batch.column(1)))
        firsts, _ = parse.short_phrases(parse.trigger >= 0)
        h, docs = parse.hashes[parse.trigger[firsts]], parse.document(firsts)
        yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(batch.column(0).to_numpy()[docs])], ["trigger", "key"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by trigger and key, the distinct ones of triggers with several keys. A trigger's rows aren't held."""
    last: tuple[int, int] | None = None  # the row before
    given = False  # whether the trigger before is known to be shared, and its rows are out
    for batch in batches:
        t, k = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(t):
            continue
        if last is not None:
            t, k = np.concatenate([[last[0]], t]), np.concatenate([[last[1]], k])
        same = np.concatenate([[False], t[1:] == t[:-1]])
        fresh = ~same | np.concatenate([[True], k[1:] != k[:-1]])
        run = np.cumsum(~same) - 1
        shared = np.bincount(run, fresh) > 1
        if given:
            shared[0] = True
        emit = fresh & shared[run]
        if given:
            emit[0] = False
        yield pa.record_batch([pa.array(k[emit]), pa.array(t[emit])], ["key", "trigger"])
        last, given = (int(t[-1]), int(k[-1])), bool(shared[-1])


def _wanted(parse: Parse, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Strings in new long phrases, and those of them that have a shared trigger."""
    docs, digests = parse.long_phrases()
    lists = [set(x) if x is not None else set() for x in batch.column("phrases").to_pylist()]
    new = np.array([d in lists[i] for i, d in zip(docs.tolist(), digests)], bool)
    sizes = np.diff(np.append(parse.cuts, len(parse.bytes)))
    fresh = np.repeat(new, sizes) & parse.whole if len(sizes) else np.zeros(len(parse.bytes), bool)
    firsts, lasts = parse.short_phrases(parse.trigger >= 0)
    h, of = parse.hashes[parse.trigger[firsts]].view(np.int64), parse.document(firsts)
    known = batch.column("triggers")
    # Looked up for all documents at once: hashes are mixed with the document's number. Should two mixtures
    # be alike by chance, a phrase more goes into the dictionary.
    sizes = known.value_lengths().to_numpy()
    mix = lambda values, docs: values ^ (docs.astype(np.int64) * np.int64(0x2545F4914F6CDD1D))
    common = np.isin(mix(h, of), mix(known.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)))
    shared = np.zeros(len(parse.bytes), bool)
    shared[parse.trigger >= 0] = np.repeat(common, lasts - firsts + 1)
    return fresh, fresh & shared


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short phrases with shared triggers, each once with its smallest key among those seen."""
    held: dict[bytes, tuple[int, int]] = {}

    def out() -> pa.RecordBatch:
        columns = (pa.array([t for t, _ in held.values()], pa.int64()), pa.array(list(held), pa.binary()), pa.array([k for _, k in held.values()], pa.int64()))
        held.clear()
        return pa.record_batch(list(columns), ["trigger", "phrase", "key"])

    for batch in text_slices(batches, "text", BATCH_BYTES):
        parse = Parse(_texts(batch.column("text")))
        firsts, lasts = parse.short_phrases(_wanted(parse, batch)[1])
        triggers = parse.hashes[parse.trigger[firsts]].view(np.int64)
        keys = batch.column("key").to_numpy()[parse.document(firsts)]
        for a, b, t, k in zip(firsts.tolist(), lasts.tolist(), triggers.tolist(), keys.tolist()):
            phrase = parse.bytes[a : b + LENGTH]
            got = held.get(phrase)
            if got is None or k < got[1]:
                held[phrase] = (t, k)
        if len(held) >= HELD:
            yield out()
    if held:
        yield out()


def _strings(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes of at least 50 bytes, cut to 50, and the number of each phrase's."""
    counts = np.array([len(p) - LENGTH + 1 for p in phrases], np.int64)
    data = np.frombuffer(b"".join(phrases), np.uint8)
    bases = np.cumsum(counts + LENGTH - 1) - counts - LENGTH + 1
    at = np.repeat(bases - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    grid = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]
    return np.ascontiguousarray(grid).view(f"S{LENGTH}").ravel(), counts


def repeats(phrases: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each string of the phrases has a smaller key in another phrase, by their suffix array; and strings by phrase."""
    strings, counts = _strings(phrases)
    owner = np.repeat(keys, counts)
    by_key = np.argsort(owner, kind="stable")
    order = by_key[np.argsort(strings[by_key], kind="stable")]
    ranked = strings[order]
    start = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    first = owner[order][np.flatnonzero(start)][np.cumsum(start) - 1]
    out = np.zeros(len(strings), bool)
    out[order] = first < owner[order]
    return out, counts


def _masks(flags: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The flags of each phrase's strings, at most 31, as bits of a number."""
    nth = np.arange(len(flags)) - np.repeat(np.cumsum(counts) - counts, counts)
    bits = np.where(flags, np.int64(1) << nth, 0)
    return np.add.reduceat(bits, np.cumsum(counts) - counts) if len(counts) else bits


def _digests(phrases: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(p) for p in phrases], np.uint64).view(np.int64)


_FIRSTS = "key bigint, phrase bigint, mask bigint, nth int, string binary"


def _sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of phrases sorted by trigger, text and key: a first document's mask for each; strings of large triggers as rows."""
    names = [f.split()[0] for f in _FIRSTS.split(", ")]

    def out(phrases: list[bytes], keys: list[int]) -> pa.RecordBatch:
        owner = np.array(keys, np.int64)
        flags, counts = repeats(phrases, owner)
        n = len(phrases)
        return pa.record_batch([pa.array(owner), pa.array(_digests(phrases)), pa.array(_masks(flags, counts)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)

    def rows(phrases: list[bytes], keys: list[int]) -> pa.RecordBatch:
        strings, counts = _strings(phrases)
        nth = np.arange(len(strings)) - np.repeat(np.cumsum(counts) - counts, counts)
        # 128 bits for 50 bytes; the view cuts zero bytes at a string's end, which its length restores.
        digests = [xxhash.xxh3_128_digest(s.ljust(LENGTH, b"\0")) for s in strings.tolist()]
        return pa.record_batch([pa.array(np.repeat(np.array(keys, np.int64), counts)), pa.array(np.repeat(_digests(phrases), counts)), pa.nulls(len(strings), pa.int64()), pa.array(nth.astype(np.int32)), pa.array(digests, pa.binary())], names)

    ready: tuple[list[bytes], list[int]] = ([], [])  # of triggers that are complete
    group: tuple[list[bytes], list[int]] = ([], [])
    now, large, before = None, False, None
    for batch in batches:
        for trigger, phrase, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if trigger != now:
                if large and group[0]:
                    yield rows(*group)
                elif not large:
                    ready[0].extend(group[0])
                    ready[1].extend(group[1])
                group = ([], [])
                now, large, before = trigger, False, None
                if 16 * len(ready[0]) >= SORTED:
                    yield out(*ready)
                    ready = ([], [])
            if phrase == before:
                continue  # the same phrase with a larger key
            before = phrase
            group[0].append(phrase)
            group[1].append(key)
            if len(group[0]) >= GROUP:
                large = True
                yield rows(*group)
                group = ([], [])
    if large and group[0]:
        yield rows(*group)
    elif not large:
        ready[0].extend(group[0])
        ready[1].extend(group[1])
    if ready[0]:
        yield out(*ready)


_SPAN = StructType([StructField("start", LongType()), StructField("stop", LongType())])
_APPLIED = [StructField("spans", ArrayType(_SPAN)), StructField("kept", BinaryType()), StructField("kept_text", StringType())]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated bytes of each document, and the bytes that stay."""
    for batch in text_slices(batches, "text", BATCH_BYTES):
        texts = _texts(batch.column("text"))
        parse = Parse(texts)
        fresh, open_strings = _wanted(parse, batch)
        repeated = parse.whole & ~fresh
        firsts, lasts = parse.short_phrases(open_strings)
        known = [{x["phrase"]: x["mask"] for x in own or ()} for own in batch.column("firsts").to_pylist()]
        digests = _digests([parse.bytes[a : b + LENGTH] for a, b in zip(firsts.tolist(), lasts.tolist())]).tolist()
        for a, b, doc, digest in zip(firsts.tolist(), lasts.tolist(), parse.document(firsts).tolist(), digests):
            mask = known[doc].get(digest, -1)
            if mask == -1:
                repeated[a : b + 1] = True
            elif mask:
                repeated[a : b + 1] = (mask >> np.arange(b - a + 1)) & 1
        # A byte goes if one of the 50 strings that end at or after it, and start at or before it, repeats.
        change = np.zeros(len(parse.bytes) + 1, np.int32)
        at = np.flatnonzero(repeated)
        change[at] += 1
        change[at + LENGTH] -= 1
        gone = np.cumsum(change[:-1]) > 0
        spans, kept = [], []
        for a, b in zip(parse.starts.tolist(), parse.ends.tolist()):
            own = np.concatenate([[False], gone[a:b], [False]])
            starts, stops = np.flatnonzero(~own[:-1] & own[1:]).tolist(), np.flatnonzero(own[:-1] & ~own[1:]).tolist()
            spans.append([{"start": s, "stop": e} for s, e in zip(starts, stops)])
            cuts = [0, *(x for pair in zip(starts, stops) for x in pair), b - a]
            kept.append(b"".join(parse.bytes[a + s : a + e] for s, e in zip(cuts[::2], cuts[1::2])))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        texts = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        yield pa.record_batch([batch.column("rest"), pa.array(spans, kind), pa.array(kept, pa.binary()), texts], ["rest", "spans", "kept", "kept_text"])


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text``, with ``spans`` of bytes that repeat, the bytes ``kept``, and these as ``kept_text``, without characters of which a part went."""
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_KEY))
    texts = docs.select(key.alias("key"), F.col("text").cast("binary").alias("text"))
    phrases = arrow_map(texts, _long, "phrase binary, key bigint").groupBy("phrase").agg(F.min("key").alias("key"))
    new = phrases.groupBy("key").agg(F.collect_list("phrase").alias("phrases"))
    triggers = arrow_map(texts, _triggers, "trigger bigint, key bigint")
    shared = arrow_map(triggers.repartition("trigger").sortWithinPartitions("trigger", "key"), _shared, "key bigint, trigger bigint")
    of_doc = shared.groupBy("key").agg(F.collect_list("trigger").alias("triggers"))
    empty = F.array().cast("array<bigint>")
    known = stored(new.join(of_doc, "key", "left").select("key", "phrases", F.coalesce("triggers", empty).alias("triggers")), "phrases")

    def parsed(df: DataFrame) -> DataFrame:
        return df.join(known, "key", "left").withColumn("triggers", F.coalesce("triggers", empty))

    dictionary = arrow_map(parsed(texts), _dictionary, "trigger bigint, phrase binary, key bigint")
    sorted_ = arrow_map(dictionary.repartition("trigger").sortWithinPartitions("trigger", "phrase", "key"), _sort, _FIRSTS)
    firsts = _with_large(stored(sorted_, "suffixes"))
    lists = firsts.groupBy("key").agg(F.collect_list(F.struct("phrase", "mask")).alias("firsts"))
    names = [c for c in docs.columns if c.lower() not in ("text", "spans", "kept", "kept_text")]
    rest = F.struct(*map(column, names)).alias("rest")
    whole = docs.select(key.alias("key"), F.col("text").cast("binary").alias("text"), rest)
    schema = StructType([whole.schema["rest"], *_APPLIED])
    return arrow_map(parsed(whole).join(lists, "key", "left"), _apply, schema).select("rest.*", "spans", "kept", "kept_text")


def _with_large(sorted_: DataFrame) -> DataFrame:
    """Masks of all phrases, those of large triggers made from their strings' first keys."""
    strings = sorted_.where("string is not null")
    least = strings.groupBy("string").agg(F.min("key").alias("least"))
    flag = F.when(F.col("least") < F.col("key"), F.expr("shiftleft(1L, nth)")).otherwise(F.lit(0).cast("bigint"))
    masks = strings.join(least, "string").groupBy("key", "phrase").agg(F.bit_or(flag).alias("mask"))
    return sorted_.where("string is null").select("key", "phrase", "mask").union(masks)
