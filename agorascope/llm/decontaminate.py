"""Benchmark passages in training texts, by a positional inverted index.

The index is cut by documents: a shard is one row with the postings of some million words, for
each term the sorted places where it stands. Places count words through the shard, with a gap
between documents, so a phrase can't cross them. Queries are sent to every shard. A phrase starts
from the postings of its rarest term there, moved back by the term's offset, and keeps the starts
that the other terms' postings, moved by theirs, have too, in order of rarity. So a phrase of
which one term is missing costs nothing.

Queries go to the shards in blocks of a bounded number of words. For one block, postings are kept
of its terms only; for more, of all terms.

Defined cases: a null text has no words; an item without words matches nothing; an item shorter
than a window is one window; hits of an item without id count, but it isn't listed; repeated
documents stay as rows; an item id that occurs twice is listed once; an empty benchmark gives every
document without hits; other columns aren't read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import alnum_words, arrow_map, slices, stored

WINDOW = 13
SHARD_WORDS = 1 << 20
#: Words of the items that go to the shards at once, some 100 MB in a worker.
BLOCK_WORDS = 1 << 20

SHARDS = "doc_nos array<bigint>, doc_ids array<bigint>, doc_words array<bigint>, terms array<binary>, starts array<bigint>, places array<int>"
HITS = "doc_no bigint, doc_id bigint, n_words bigint, spans array<struct<first:bigint,last:bigint>>, items array<bigint>"


def build_index(docs: DataFrame, vocabulary: frozenset[bytes] | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Shards of a positional index of whole texts; of the given terms only, if there are any."""
    known = None if vocabulary is None else {w: i for i, w in enumerate(sorted(vocabulary))}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 40)
        terms = known if known is not None else defaultdict(count().__next__)
        keys: list[int | None] = []
        sizes: list[int] = []
        ids: list[np.ndarray] = []
        places: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            term = np.concatenate(ids)
            order = np.argsort(term, kind="stable")
            found, first = np.unique(term[order], return_index=True)
            names = list(terms)
            values = (
                [[next(number) for _ in keys]], [keys], [sizes], [[names[i] for i in found.tolist()]],
                [np.append(first, len(order))], [np.concatenate(places)[order].astype(np.int32)],
            )
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32())
            return pa.record_batch([pa.array(v, pa.list_(k)) for v, k in zip(values, kinds)], [f.split()[0] for f in SHARDS.split(", ")])

        for batch in slices(batches, 256):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = alnum_words(text.as_py())
                if known is None:
                    own = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
                else:
                    own = np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words))
                at = np.flatnonzero(own >= 0)
                keys.append(key)
                sizes.append(len(words))
                ids.append(own[at])
                places.append(at + held)
                held += len(words) + 1
                if held >= shard_words:
                    yield shard()
                    keys, sizes, ids, places, held = [], [], [], [], 0
                    if known is None:
                        terms.clear()
                        terms.default_factory = count().__next__
        if keys:
            yield shard()

    return arrow_map(docs.select("doc_id", "text"), build, SHARDS)


class Shard:
    """One row of the index, for searching."""

    def __init__(self, row: pa.RecordBatch):
        self.sizes = row.column("doc_words").flatten().to_numpy()
        self.bases = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.terms = {t.as_py(): i for i, t in enumerate(row.column("terms").flatten())}
        self.starts = row.column("starts").flatten().to_numpy()
        self.places = row.column("places").flatten().to_numpy()
        self.length = int((self.sizes + 1).sum())

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.starts[term] : self.starts[term + 1]]

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, places, "right") - 1

    def _by_rarity(self, words: list[int]) -> list[tuple[int, int]]:
        """(offset, term), the rarest term first; empty if a term is missing."""
        if min(words, default=-1) < 0:
            return []
        return sorted(enumerate(words), key=lambda x: (self.starts[x[1] + 1] - self.starts[x[1]], x[0]))

    def phrase(self, words: list[int]) -> np.ndarray:
        """Places where the terms stand one after another."""
        starts = np.zeros(0, np.int32)
        for nth, (offset, term) in enumerate(self._by_rarity(words)):
            moved = self.postings(term) - offset
            if nth:
                at = np.searchsorted(moved, starts)
                at[at == len(moved)] = 0
                moved = starts[moved[at] == starts]
            starts = moved
            if not len(starts):
                break
        return starts

    def near(self, words: list[int], reach: int) -> np.ndarray:
        """Places of the rarest term within ``reach`` words of which, in its document, all other terms stand."""
        ranked = self._by_rarity(words)
        places = self.postings(ranked[0][1]) if ranked else np.zeros(0, np.int32)
        for _, term in ranked[1:]:
            doc = self.documents(places)
            low = np.maximum(places - reach, self.bases[doc])
            high = np.minimum(places + reach, self.bases[doc] + self.sizes[doc] - 1)
            own = self.postings(term)
            places = places[np.searchsorted(own, low) < np.searchsorted(own, high, "right")]
        return places


def item_windows(words: list, window: int) -> list[list]:
    if len(words) <= window:
        return [words] if words else []
    return [words[i : i + window] for i in range(len(words) - window + 1)]


def search(index: DataFrame, items: list[tuple[int | None, list[bytes]]], window: int = WINDOW, reach: int | None = None) -> DataFrame:
    """Every indexed document with its hit spans and the ids of its items: ``HITS``.

    ``items`` is one block. Without ``reach``, hits are exact windows, and spans cover their words.
    With it, a hit is a place of a window's rarest term with all its terms within ``reach`` words, in any
    order, and spans cover these places.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            shard = Shard(row)
            change = np.zeros(shard.length + 1, np.int32)
            pairs: list[np.ndarray] = []
            for key, words in items:
                ids = [shard.terms.get(w, -1) for w in words]
                for own in item_windows(ids, window):
                    if reach is None:
                        starts, size = shard.phrase(own), len(own)
                    else:
                        starts, size = shard.near(own, reach), 1
                    if len(starts):
                        change[starts] += 1
                        np.subtract.at(change, starts + size, 1)
                        if key is not None:
                            doc = np.unique(shard.documents(starts))
                            pairs.append(np.stack([doc, np.full(len(doc), key)], axis=1))
            covered = np.concatenate([[False], np.cumsum(change) > 0, [False]])
            firsts, ends = np.flatnonzero(~covered[:-1] & covered[1:]), np.flatnonzero(covered[:-1] & ~covered[1:])
            of = shard.documents(firsts)
            counts = np.bincount(of, minlength=len(shard.sizes))
            spans = pa.StructArray.from_arrays([pa.array(firsts - shard.bases[of]), pa.array(ends - 1 - shard.bases[of])], ["first", "last"])
            named = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *pairs]), axis=0)
            listed = np.bincount(named[:, 0], minlength=len(shard.sizes))
            cut = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            yield pa.record_batch(
                [row.column("doc_nos").flatten(), row.column("doc_ids").flatten(), pa.array(shard.sizes), pa.ListArray.from_arrays(cut(counts), spans), pa.ListArray.from_arrays(cut(listed), pa.array(named[:, 1]))],
                ["doc_no", "doc_id", "n_words", "spans", "items"],
            )

    return arrow_map(index, find, HITS)


def _merged(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch made one."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"))
        apart = (F.size(done) == 0) | (span["first"] > last["last"] + 1)
        return F.when(apart, F.concat(done, F.array(span))).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer)))

    ordered = F.array_sort(spans)
    return F.aggregate(ordered, F.slice(ordered, 1, 0), add)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, reach: int | None = None, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``search`` of a whole benchmark ``(item_id, text)``, in as many blocks as its words need."""
    letters = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-letters // (2 * block_words)))  # a word takes two bytes at least

    def block(nth: int) -> list[tuple[int | None, list[bytes]]]:
        own = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == nth).select("item_id", "text")
        return [(key, alnum_words(text)) for key, text in own.collect()]

    if blocks == 1:
        items = block(0)
        index = build_index(docs, frozenset(w for _, words in items for w in words), shard_words)
        return search(stored(index, "index"), items, window, reach)
    index = stored(build_index(docs, None, shard_words), "index")
    found = None
    for nth in range(blocks):
        hits = stored(search(index, block(nth), window, reach), "hits")
        found = hits if found is None else found.union(hits)
    return found.groupBy("doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        _merged(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )


def judged(hits: DataFrame, share: int = 20) -> DataFrame:
    """``hits`` with the number of hit words and whether they are one in ``share`` words or more."""
    n = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"] + 1)
    return hits.withColumn("n_hit", n).withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
