"""Pack documents into token windows filled with lexical neighbours.

Documents are tokenised once. What a document has beyond whole windows of its own, its tail, is
dealt by a lexical signature to shards of a bounded number of tokens. Each shard holds a BM25
inverted index of its tails. A window starts with a seed, the first unused tail; the index returns
the seed's unused neighbours, best first, and they fill the window greedily. The last one is cut
at the window's end and its rest seeds the next window, so that windows have no padding. The last
window of a shard is cut into windows of powers of two, which need none either.

Equal and nearly equal tails share a signature and so tend to meet in a shard; a group of copies
larger than a shard is spread over several, since shards end by size, not by key. Defined cases: a
null or empty text is its end id alone; rows with one ``doc_id`` are documents of their own; an
empty table gives no piece; columns besides ``doc_id`` and ``text`` aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import arrow_map, slices, stored
from .encoder import encoder

WINDOW = 4096
#: Tokens of a shard, after which the next one begins.
SHARD_TOKENS = 1 << 20
#: BM25's saturation and length parameters.
K1, B = 1.2, 0.75

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
TAILS = "doc_id bigint, start bigint, doc_tokens bigint, signature bigint, ids binary"


def _signatures(count: int, seed: int) -> np.ndarray:
    """A random order of the token ids."""
    return np.random.default_rng(seed).permutation(count).astype(np.int64)


class Bm25:
    """An inverted index of a shard's tails, with scores of each posting computed once."""

    def __init__(self, tails: list[np.ndarray]):
        sizes = np.array([len(t) for t in tails], np.int64)
        doc = np.repeat(np.arange(len(tails)), sizes)
        term = np.concatenate(tails).astype(np.int64) if tails else np.zeros(0, np.int64)
        pairs, counts = np.unique((term << 32) | doc, return_counts=True)
        terms, self.docs = pairs >> 32, pairs & 0xFFFFFFFF
        self.terms, first, df = np.unique(terms, return_index=True, return_counts=True)
        self.starts = np.append(first, len(pairs))
        idf = np.log1p((len(tails) - df + 0.5) / (df + 0.5))
        # A term that most tails have tells nothing of them: its classic weight isn't positive.
        idf[2 * df > len(tails)] = 0
        norm = K1 * (1 - B + B * sizes / max(sizes.mean(), 1)) if len(sizes) else sizes
        self.weights = np.repeat(idf, df) * counts * (K1 + 1) / (counts + norm[self.docs])
        self.useful = idf > 0
        self.count = len(tails)

    def neighbours(self, query: np.ndarray, unused: np.ndarray) -> np.ndarray:
        """Unused tails that share a term with the query, best first, ties by place."""
        at = np.searchsorted(self.terms, np.unique(query))
        at = at[self.useful[at]]
        starts, sizes = self.starts[at], self.starts[at + 1] - self.starts[at]
        places = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores = np.bincount(self.docs[places], self.weights[places], self.count)
        found = np.flatnonzero((scores > 0) & unused)
        return found[np.lexsort((found, -scores[found]))]


def windows(tails: list[np.ndarray], window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, start in it, length); every token is in one of them."""
    index = Bm25(tails)
    unused = np.ones(len(tails), bool)
    seed, begun, following = -1, 0, 0
    while True:
        if seed < 0:
            while following < len(tails) and not unused[following]:
                following += 1
            if following == len(tails):
                return
            seed, begun = following, 0
            unused[seed] = False
        filled: list[tuple[int, int, int]] = []
        room = window
        ranked: Iterator[int] | None = None
        tail, start = seed, begun
        while True:
            take = min(room, len(tails[tail]) - start)
            filled.append((tail, start, take))
            room -= take
            if not room:
                seed, begun = (tail, start + take) if start + take < len(tails[tail]) else (-1, 0)
                break
            if ranked is None:
                ranked = iter(index.neighbours(tails[seed], unused).tolist())
            tail = next(ranked, -1)
            if tail < 0:  # no neighbour is left: the next unused tail, and its neighbours
                while following < len(tails) and not unused[following]:
                    following += 1
                if following == len(tails):
                    seed = -1
                    break
                tail = seed = following
                ranked = None
            unused[tail], start = False, 0
        yield filled


def _powers(filled: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A window cut into windows whose lengths are powers of two, the largest first."""
    total = sum(n for _, _, n in filled)
    while total:
        size = 1 << (total.bit_length() - 1)
        head, left = [], size
        while left:
            tail, start, n = filled[0]
            take = min(left, n)
            head.append((tail, start, take))
            left -= take
            filled = [(tail, start + take, n - take), *filled[1:]] if take < n else filled[1:]
        total -= size
        yield head


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row for each piece of a document: ``PIECES``. ``window`` is a power of two."""
    if window & (window - 1):
        raise ValueError("the window must be a power of two")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        end = np.array([end_id], tool.dtype).tobytes()
        order = _signatures(max(tool.library.get_vocab_size(), end_id + 1), 7)
        for batch in slices(batches, 256):
            keys, texts = batch.column(0), batch.column(1)
            starts, totals, marks, data = [], [], [], []
            for text in texts:
                ids = tool.encode(text.as_py()) + end
                n = len(ids) // tool.width
                whole = n // window * window
                tail = np.frombuffer(ids, tool.dtype)[whole:] if whole < n else np.frombuffer(ids, tool.dtype)
                starts.append(whole)
                totals.append(n)
                marks.append(int(order[tail].min()))
                data.append(ids)
            yield pa.record_batch([keys.cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(totals, pa.int64()), pa.array(marks, pa.int64()), pa.array(data, pa.binary())], ["doc_id", "start", "doc_tokens", "signature", "ids"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = encoder(tokenizer).dtype
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def piece(key: int | None, ids: np.ndarray, total: int, start: int, length: int, offset: int) -> None:
            part = ids[start : start + length].astype("<u4")
            rows.append((key, start, length, zlib.crc32(part.tobytes()), total, sequence, offset))

        def flush(force: bool) -> Iterator[pa.RecordBatch]:
            if rows and (force or len(rows) >= 10_000):
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                rows.clear()
                yield pa.record_batch(columns, [f.split()[0] for f in PIECES.split(", ")])

        shard: list[tuple[int | None, int, np.ndarray]] = []
        held = 0

        def close() -> None:
            nonlocal sequence, held
            for filled in windows([ids[start:] for _, start, ids in shard], window):
                full = sum(n for _, _, n in filled) == window
                for own in [filled] if full else _powers(filled):
                    offset = 0
                    for tail, start, n in own:
                        key, first, ids = shard[tail]
                        piece(key, ids, len(ids), first + start, n, offset)
                        offset += n
                    sequence += 1
            shard.clear()
            held = 0

        for batch in slices(batches, 256):
            for key, start, data in zip(batch.column("doc_id").to_pylist(), batch.column("start").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(data.as_buffer(), dtype)
                for at in range(0, start, window):
                    piece(key, ids, len(ids), at, window, 0)
                    sequence += 1
                if start < len(ids):
                    shard.append((key, start, ids.copy()))
                    held += len(ids) - start
                if held >= shard_tokens:
                    close()
            yield from flush(False)
        close()
        yield from flush(True)

    # Dealing by ranges reads its input twice, so the ids are written first.
    tokens = stored(arrow_map(docs.select("doc_id", "text"), tokenise, TAILS), "tokens")
    # The order within a signature is by document, so that a group of copies can be cut anywhere.
    dealt = tokens.repartitionByRange("signature", "doc_id").sortWithinPartitions("signature", "doc_id", "doc_tokens", "ids")
    return arrow_map(dealt, deal, PIECES)
