"""Near-duplicates by SimHash, linked through multi-index hashing.

A fingerprint of 64 bits is split into two segments of 32. Two fingerprints that differ in at most
four bits differ in at most two bits of the first segment or in at most one of the second. So each
fingerprint is filed under every key at distance one or less from each of its segments, 66 keys in
all: segments within two bits of each other meet under a key. Under each key the complete distance
decides. Copies share a fingerprint and are filed once.

The texts under a key are few for unrelated texts. A key of many near copies is not expanded into
pairs: its members give a spanning forest of their links, and beyond ``BUCKET`` members it is cut
into blocks, whose pairs are separate groups. No link between components is lost.

Defined cases: null or empty texts, or such without words, have fingerprint zero and are linked as
any other; fewer words than a shingle has are one shingle; repeated rows stay as rows; a component
of rows that have no ``doc_id`` has a null one; an empty table gives no rows; columns besides
``doc_id`` and ``text`` aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import arrow_map, column, slices, space_words, stored
from .components import components

SHINGLE_WORDS, SEED, DISTANCE = 4, 42, 4
#: Members of a key that one task compares at once.
BUCKET = 4096

_KEYS = "a bigint, b bigint, key bigint, block int"


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 bits, each set if it is set in over half of the hashes of the text's shingles."""
    found = space_words(text)
    if not found:
        return 0
    line = b" ".join(found)
    ends = [at - 1 for at in accumulate(len(w) + 1 for w in found)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    last = ends[words - 1 :] or ends[-1:]
    hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts, last)], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, a hash of the text, and the fingerprint, as a signed number, of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1024):
            codes = np.array([fingerprint(t.as_py(), words, seed) for t in batch.column(1)], np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(codes.view(np.int64))], ["doc_id", "text_hash", "code"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return arrow_map(rows, sign, "doc_id bigint, text_hash bigint, code bigint")


def forest(codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what lies within the distance, directly or by way of others, with no cycles."""
    left = codes.view(np.uint64)
    tails: list[np.ndarray] = []
    heads: list[np.ndarray] = []
    queue: list[np.uint64] = []
    while len(left):
        if not queue:
            queue, left = [left[0]], left[1:]
        code = queue.pop()
        near = np.bitwise_count(left ^ code) <= distance
        if near.any():
            found = left[near]
            left = left[~near]
            tails.append(np.full(len(found), code))
            heads.append(found)
            queue.extend(found)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *tails]).view(np.int64), np.concatenate([empty, *heads]).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each code under the keys at distance one or less of both of its segments."""
    ball = np.array([0, *(1 << bit for bit in range(32))], np.uint64)
    for batch in slices(batches, 4096):
        codes = batch.column(0).to_numpy().view(np.uint64)
        first = (codes >> np.uint64(32))[:, None] ^ ball
        second = ((codes & np.uint64(0xFFFFFFFF))[:, None] ^ ball) | np.uint64(1 << 32)
        keys = np.concatenate([first, second], axis=1).reshape(-1)
        yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(np.repeat(codes.view(np.int64), 66))], ["key", "code"])


def _meet(distance: int):
    """Of rows sorted by key, the links under each key; members of a key too large for one task, in blocks."""

    def out(a, b, key=None, block=None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        keys = none if key is None else pa.array(np.full(len(a), key))
        return pa.record_batch(
            [pa.array(a), none if b is None else pa.array(b), keys, pa.nulls(len(a), pa.int32()) if block is None else pa.array(np.full(len(a), block, np.int32))],
            ["a", "b", "key", "block"],
        )

    def runs(keys: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keys that are complete."""
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
        size = np.repeat(ends - starts, ends - starts)
        for step in range(1, 8):
            if step >= len(keys):
                break
            same = np.flatnonzero((keys[step:] == keys[:-step]) & (size[step:] <= 8))
            a, b = codes[same], codes[same + step]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
            if near.any():
                yield out(a[near], b[near])
        for s, e in zip(starts[ends - starts > 8].tolist(), ends[ends - starts > 8].tolist()):
            if e - s <= BUCKET:
                yield out(*forest(codes[s:e], distance))
            else:
                yield from blocks(keys[s], codes[s:e], 0)

    def blocks(key: int, codes: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
        for block, at in enumerate(range(0, len(codes), BUCKET)):
            yield out(codes[at : at + BUCKET], None, key, first + block)

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, codes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        large, block = None, 0  # a key of which blocks are out, and their number
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            codes = np.concatenate([codes, batch.column(1).to_numpy()])
            if large is not None:
                end = int(np.searchsorted(keys, large, "right"))
                yield from blocks(large, codes[:end], block)
                block += -(-end // BUCKET)
                keys, codes = keys[end:], codes[end:]
            if len(keys):
                last = int(np.searchsorted(keys, keys[-1], "left"))
                if last:
                    yield from runs(keys[:last], codes[:last])
                keys, codes, large = keys[last:], codes[last:], None
            if len(keys) > BUCKET:
                large, block = int(keys[0]), -(-len(keys) // BUCKET)
                yield from blocks(large, codes, 0)
                keys, codes = keys[:0], codes[:0]
        if len(keys):
            yield from runs(keys, codes)

    return links


def _block_links(distance: int):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        a, b = forest(group["a"].to_numpy(), distance)
        return pd.DataFrame({"a": a, "b": b})

    return links


def near_links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links ``(a, b)`` that join all distinct codes within the distance, directly or through others."""
    if not 0 <= distance <= 4:
        raise ValueError("the keys cover distances up to 4")
    filed = arrow_map(codes.select("code"), _keys, "key bigint, code bigint")
    met = stored(arrow_map(filed.repartition("key").sortWithinPartitions("key"), _meet(distance), _KEYS), "near")
    large = met.where("key is not null").select("key", "block", "a")
    # Every member of a large key goes to the pairs of its block with each block of the key.
    counts = large.groupBy("key").agg(F.max("block").alias("last"))
    other = F.explode(F.sequence(F.lit(0), "last"))
    paired = large.join(counts, "key").select("key", "a", "block", other.alias("other"))
    paired = paired.select("key", "a", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    blocks = paired.groupBy("key", "x", "y").applyInPandas(_block_links(distance), "a bigint, b bigint")
    return met.where("key is null").select("a", "b").union(blocks)


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED, distance: int = DISTANCE) -> DataFrame:
    """One row for each document: ``doc_id, text_hash, fingerprint`` in hexadecimal, ``component_id`` and ``component``, a number of its own for each."""
    signed = stored(fingerprints(docs, words, seed), "fingerprints")
    codes = stored(signed.groupBy("code").agg(F.min("doc_id").alias("low")), "codes")
    roots = components(near_links(codes, distance))
    placed = codes.join(roots, codes["code"] == roots["node"], "left").select("code", "low", F.coalesce("root", "code").alias("component"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    of_code = placed.select("code", "component").join(lowest, "component")
    hexadecimal = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return signed.join(of_code, "code").select("doc_id", "text_hash", hexadecimal.alias("fingerprint"), "component_id", "component")


def first_of_groups(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED, distance: int = DISTANCE) -> DataFrame:
    """One row of each component of ``docs``: that with the smallest ``doc_id``, ties by the text's hash; ids before null ones."""
    groups = near_duplicates(docs, words, seed, distance)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("least")
    # Plain equality on two columns, so that the join's partitions serve the last step too.
    key = lambda c: F.coalesce(c.cast("bigint"), F.lit(-(1 << 63)))
    first = groups.groupBy("component").agg(least).select(key(F.col("least.doc_id")).alias("key"), F.col("least.text_hash").alias("hash"))
    # Whole rows as one value, so that no name of theirs meets the keys'.
    keyed = docs.select(key(F.col("doc_id")).alias("key"), F.xxhash64("text").alias("hash"), F.struct(*map(column, docs.columns)).alias("row"))
    return keyed.join(first, ["key", "hash"], "left_semi").dropDuplicates(["key", "hash"]).select("row.*")
