"""Phrases of words that stand together, by external counting and merges of ordered count streams.

Texts are tokenised once, into chunks of one language: rows with many documents' words as numbers,
and the words that they stand for. Then phrases are counted by length. A phrase of ``n`` words can be
frequent only if its first and its last ``n - 1`` words are, so it is a pair of frequent shorter
phrases that overlap, and each is one number: a pair of numbers stands for a phrase of any length.
Chunks add up their own pairs, so a pair is shuffled once for each chunk at most;
the frequent ones get numbers, which go back to the chunks that hold them. Nothing that has to be
looked up lies on the driver, and a chunk's part of the numbers is bounded by its tokens.

The frequent counts of each length are a stream that is kept in two orders: by the number of a phrase's
first words (prefix order) and by that of its last words (suffix order). Merged with the stream of
phrases one word shorter, the one gives the counts of all first parts and the largest count of
a phrase that goes on to the right, the other those of all last parts and of phrases that begin
further to the left. Merges are Spark's sort-merge joins: both sides are read in order, no side is held
in a hash table. A longer phrase that keeps ``share`` of a shorter one's count contains a phrase
one word longer than that which keeps it, too; so these neighbours are all that has to be asked.

Defined cases: null or empty texts and texts of breaks alone have no words; a null language is
``und``; repeated rows count again, whatever their ids; equal scores and counts rank by phrase, so ranks
are without ties; languages without frequent phrases, and empty tables, give no rows; columns besides
the named ones aren't read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow_map, discard, slices, stored

UNKNOWN = "und"
LEAST_COUNT = 30
LONGEST = 4
TOP = 2000
#: Percent of a phrase's count with which a longer one replaces it.
SHARE = 80
SCALE = 2_000_000
#: Parts of a language's phrases that are ranked apart before they are ranked together.
PARTS = 64
#: Tokens of a chunk, and of all chunks that a task builds at a time.
CHUNK_TOKENS, HELD_TOKENS = 1 << 21, 1 << 23
#: Pairs that are handed over at once.
STEP = 1 << 17

#: No byte of UTF-8 is 255: it stands for the breaks between pieces.
BREAK = b"\xff"
_PIECES = bytes(255 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))

_CHUNKS = "chunk bigint, lang string, size int, state binary, words array<string>, counts array<bigint>, n bigint"
#: What neighbouring rows share comes first, so that it costs the shuffle little.
_PAIRS = "chunk bigint, n bigint, a bigint, b bigint"
_STATES = "chunk bigint, size int, state binary, ids array<bigint>"


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, after lower-casing A-Z, with ``BREAK`` between pieces."""
    return text.lower().translate(_PIECES).replace(BREAK, b" \xff ").split()


def _pack(state: np.ndarray) -> bytes:
    return pa.compress(state.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), "<i4")


class _Chunk:
    """Words of one language as they come: place 0 is a break."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict(count(1).__next__, {BREAK: 0})
        self.tokens: list[np.ndarray] = []
        self.held = 0

    def add(self, words: list[bytes]) -> None:
        self.tokens += [np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        self.held += len(words) + 1

    def row(self, number: int, lang: str) -> pa.RecordBatch:
        flat = np.concatenate(self.tokens)
        counts = np.bincount(flat, minlength=len(self.ids))
        words = pa.array([b"", *list(self.ids)[1:]], pa.binary()).cast(pa.string())
        lists = pa.ListArray.from_arrays([0, len(words)], words), pa.ListArray.from_arrays([0, len(words)], pa.array(counts, pa.int64()))
        columns = [pa.array([number]), pa.array([lang]), pa.array([len(flat)], pa.int32()), pa.array([_pack(flat - 1)]), *lists, pa.array([int(counts[1:].sum())])]
        return pa.record_batch(columns, [f.split()[0] for f in _CHUNKS.split(", ")])


def tokenise(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Chunks of ``(lang, text)``, written: ``state`` is each token's place in ``words``, less one; -1 at breaks."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        chunks: dict[str, _Chunk] = defaultdict(_Chunk)
        held = 0
        for batch in slices(batches, 256):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                words = words_of(text.as_py())
                chunks[lang].add(words)
                held += len(words) + 1
                full = lang if chunks[lang].held >= chunk_tokens else None
                if held >= HELD_TOKENS:
                    full = max(chunks, key=lambda c: chunks[c].held)
                if full is not None:
                    chunk = chunks.pop(full)
                    held -= chunk.held
                    yield chunk.row(next(numbers), full)
        for lang, chunk in chunks.items():
            yield chunk.row(next(numbers), lang)

    rows = docs.where(F.col("text").isNotNull()).select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    return stored(arrow_map(rows, build, _CHUNKS), "chunks")


def _frequent(rows: DataFrame, keys: list[str], back: list[str], least: int, label: str) -> DataFrame:
    """The rows of keys whose counts ``n`` reach ``least`` together: ``chunk, *back``, and the key's number ``id``.

    The first row of a key has the key and the sum ``f``, too; in all others these are null, unless they are to go back.

    A key has one row for each chunk at most, so its rows meet in one shuffle, and what is
    found goes back to the chunks without another one by the key. Numbers are those of a key's first row in its
    task; they are written with the rows, so that they stay as they are.
    """
    whole = Window.partitionBy(*keys)
    numbered = rows.repartition(*keys).withColumn("row", F.monotonically_increasing_id())
    summed = numbered.withColumns({"f": F.sum("n").over(whole), "id": F.min("row").over(whole)})
    first = F.col("row") == F.col("id")
    once = [F.when(first, F.col(c)).alias(c) for c in (*keys, "f") if c not in back]
    return stored(summed.where(F.col("f") >= least).select("chunk", *back, *once, "id", first.alias("first")), label)


def _overlaps(state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two phrases of a state overlap, and a code for each such pair."""
    at = np.flatnonzero((state[:-1] >= 0) & (state[1:] >= 0))
    return at, state[at].astype(np.int64) << 32 | state[at + 1]


def _pairs(states: DataFrame) -> DataFrame:
    """``(chunk, n, a, b)``: each chunk's distinct overlapping pairs, by the numbers of their phrases, and their count."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            state = _unpack(row.column("state")[0].as_py(), row.column("size")[0].as_py())
            ids = row.column("ids").flatten().to_numpy()
            codes, n = np.unique(_overlaps(state)[1], return_counts=True)
            for at in range(0, len(codes), STEP):
                part = codes[at : at + STEP]
                values = [np.full(len(part), row.column("chunk")[0].as_py()), n[at : at + STEP], ids[part >> 32], ids[part & 0xFFFFFFFF]]
                yield pa.record_batch([pa.array(v) for v in values], ["chunk", "n", "a", "b"])

    return arrow_map(states, emit, _PAIRS)


def _known(found: DataFrame, *names: str) -> DataFrame:
    """``(chunk, known)``: the frequent phrases of each chunk with their numbers; as many as it has tokens at most."""
    return found.groupBy("chunk").agg(F.collect_list(F.struct(*names, "id")).alias("known"))


def _advance(chunks: DataFrame, known: DataFrame, pairs: bool) -> DataFrame:
    """States of the next length: the place, among the frequent phrases, of the one that begins at each token, or -1."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in slices(batches, 1):
            state = _unpack(row.column("state")[0].as_py(), row.column("size")[0].as_py())
            known = row.column("known").flatten()
            ids = known.field("id").to_numpy()
            if pairs:
                at, codes = _overlaps(state)
                distinct, of = np.unique(codes, return_inverse=True)
                shorter = row.column("ids").flatten().to_numpy()
                order = np.argsort(shorter)
                a, b = (order[np.searchsorted(shorter, known.field(side).to_numpy(), sorter=order)] for side in ("a", "b"))
                places = np.searchsorted(distinct, a << 32 | b)
            else:
                at = np.flatnonzero(state >= 0)
                of, distinct = state[at], np.arange(int(state.max()) + 1)
                places = known.field("place").to_numpy()
            number = np.full(len(distinct), -1, np.int32)
            number[places] = np.arange(len(places))
            new = np.full(len(state), -1, np.int32)
            new[at] = number[of]
            columns = [row.column("chunk"), row.column("size"), pa.array([_pack(new)]), pa.ListArray.from_arrays([0, len(ids)], pa.array(ids, pa.int64()))]
            yield pa.record_batch(columns, ["chunk", "size", "state", "ids"])

    return stored(arrow_map(chunks.select("chunk", "size", "state", *(["ids"] if pairs else [])).join(known, "chunk"), step, _STATES), "states")


def count_phrases(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, chunk_tokens: int = CHUNK_TOKENS) -> tuple[DataFrame, list[DataFrame]]:
    """``(lang, n)``, and for each length the phrases that occur ``least`` times or more, written.

    Single words are ``(lang, phrase, f, id)``, longer phrases ``(a, b, f, id)``: the numbers of their
    first words but one and their last words but one.
    """
    chunks = tokenise(docs, chunk_tokens)
    totals = stored(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    each = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "word")
    words = chunks.select("chunk", "lang", each).where("place > 0").select("chunk", "lang", (F.col("place") - 1).alias("place"), F.col("word.words").alias("phrase"), F.col("word.counts").alias("n"))
    found = _frequent(words, ["lang", "phrase"], ["place"], least, "words")
    levels = [stored(found.where("first").select("lang", "phrase", "f", "id"), "words")]
    states = chunks
    for length in range(2, longest + 1):
        before, states = states, _advance(states, _known(found, *(("a", "b") if length > 2 else ("place",))), length > 2)
        discard(before, found)
        found = _frequent(_pairs(states), ["a", "b"], ["a", "b"], least, f"phrases-{length}")
        levels.append(stored(found.where("first").select("a", "b", "f", "id"), f"counts-{length}"))
    discard(states, found)
    return totals, levels


def merge_streams(levels: list[DataFrame]) -> list[DataFrame]:
    """``(id, lang, phrase, f, lefts, rights, longer)`` for each length from two words on.

    ``lefts`` and ``rights`` are the counts before and after each cut, ``longer`` the largest count of a phrase one word longer.
    """
    nothing = F.array().cast("array<bigint>")
    shorter = levels[0].select("id", "lang", "phrase", F.col("phrase").alias("last"), "f", nothing.alias("lefts"), nothing.alias("rights"))
    out = []
    for length, counts in enumerate(levels[1:], 2):
        first = shorter.select(F.col("id").alias("a"), "lang", F.col("phrase").alias("start"), F.array_append("lefts", F.col("f")).alias("lefts"))
        rest = shorter.select(F.col("id").alias("b"), "last", F.array_prepend("rights", F.col("f")).alias("rights"))
        # Prefix order, then suffix order.
        merged = counts.join(first.hint("merge"), "a").join(rest.hint("merge"), "b")
        phrase = F.concat_ws(" ", "start", "last").alias("phrase")
        shorter = stored(merged.select("id", "lang", phrase, "last", "f", "lefts", "rights"), f"merged-{length}")
        found = shorter
        if length < len(levels):
            for side in ("a", "b"):
                longer = levels[length].groupBy(F.col(side).alias("id")).agg(F.max("f").alias(f"longer_{side}"))
                found = found.join(longer.hint("merge"), "id", "left")
            found = found.withColumn("longer", F.greatest("longer_a", "longer_b"))
        else:
            found = found.withColumn("longer", F.lit(None).cast("bigint"))
        out.append(found.select("id", "lang", "phrase", "f", "lefts", "rights", "longer"))
    return out


#: The lowest-scoring cut, exactly: products and sums of counts are decimals.
_CUT = (
    "array_min(transform(sequence(1, size(lefts)), k -> struct("
    f"cast({SCALE} as decimal(7,0)) * cast(f as decimal(19,0)) div (cast(lefts[k - 1] as decimal(19,0)) + cast(rights[k - 1] as decimal(19,0))) as score, "
    "k as k, lefts[k - 1] as l, rights[k - 1] as r)))"
)


def collocations(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, share: int = SHARE, top: int = TOP, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, k`` of each language's best phrases; ``k`` words stand before the cut."""
    totals, levels = count_phrases(docs, least, longest, chunk_tokens)
    kept = None
    for found in merge_streams(levels):
        whole = "decimal(19,0)"
        replaced = F.lit(100).cast("decimal(3,0)") * F.col("longer").cast(whole) >= F.lit(share).cast("decimal(3,0)") * F.col("f").cast(whole)
        own = found.where(~F.coalesce(replaced, F.lit(False))).select("lang", "phrase", "f", F.expr(_CUT).alias("cut"))
        kept = own if kept is None else kept.union(own)
    def best(rows: DataFrame, *parts: str) -> DataFrame:
        order = Window.partitionBy("lang", *parts).orderBy(F.desc("cut.score"), F.desc("f"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # The best rows of a language's parts first: what meets for its ranks is bounded, however many phrases it has.
    ranked = best(best(kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))), "part"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("f").alias("a"), F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"), F.col("cut.k").alias("k"),
    )
