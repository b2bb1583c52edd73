"""Token ids of a corpus in packed blocks: patched frame of reference.

Ids are cut into blocks of 128. Of each block its minimum is subtracted; the rest is packed at the
width that holds a given percentile of its values. Larger values leave their low bits in place and
their high bits in the block's exception list. Blocks of a segment lie one after another in one
payload, and an index of block starts lets any block be decoded alone.

A segment is a row: ``part, segment, first, n_ids, doc_ids, doc_sizes, payload``. It holds whole
documents, of one range of ``doc_id``; ``first`` counts the ids of its part before it. Segments
are kept as Parquet files, so that any store Spark writes to will do, and a lost task's file is
written anew by Spark's committer. Defined cases: a null text has no ids but the end id; null
``doc_id`` comes first; rows with one ``doc_id`` are documents of their own, in the order of their
texts; an empty table gives no segment; columns besides the named two aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import arrow_map, slices
from .encoder import encoder

BLOCK = 128
#: Ids after which a segment ends with its document. A longer document is a segment of its own.
SEGMENT_IDS = 1 << 17
PERCENTILE = 90

SEGMENTS = "part int, segment int, first bigint, n_ids bigint, doc_ids array<bigint>, doc_sizes array<bigint>, payload binary"
DOCUMENTS = "doc_id bigint, part int, at bigint, n_tokens bigint, ids_crc32 bigint"


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values packed at a width, the lowest bit first; a row's bytes are 16 * width."""
    planes = (values[:, :, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")


def _values(packed: np.ndarray, width: int) -> np.ndarray:
    planes = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), BLOCK, width)
    out = np.zeros((len(packed), BLOCK), np.uint32)
    for bit in range(width):
        out |= planes[:, :, bit].astype(np.uint32) << np.uint32(bit)
    return out


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Ids as one payload: counts, block starts, block heads and bodies.

    uint32 n, uint32 blocks, uint32 starts[blocks + 1]; each block at its start: uint32 minimum, uint8 width,
    uint8 exceptions, packed values, then the exceptions' places (uint8) and high parts (uint32).
    """
    n = len(ids)
    count = -(-n // BLOCK)
    if not count:
        return np.array([0, 0, 0], "<u4").tobytes()
    grid = np.concatenate([ids, np.repeat(ids[-1:], count * BLOCK - n)]).astype(np.uint32).reshape(count, BLOCK)
    low = grid.min(axis=1)
    rest = grid - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    fitting = np.partition(rest, rank, axis=1)[:, rank]
    widths = np.frexp(fitting.astype(np.float64))[1].astype(np.uint32)  # bits of a value; 0 for 0
    high = rest >> np.minimum(widths, 31)[:, None]
    high[widths > 31] = 0
    outlying = high > 0
    extra = outlying.sum(axis=1)
    bodies: list[bytes] = [b""] * count
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        packed = _bits(rest[own], int(width))
        for i, row in zip(own, packed):
            bodies[i] = row.tobytes()
    rows, places = np.nonzero(outlying)
    cuts = np.concatenate([[0], np.cumsum(extra)])
    places, high = places.astype(np.uint8), high[rows, places].astype("<u4")
    blocks = []
    for i in range(count):
        a, b = cuts[i], cuts[i + 1]
        head = int(low[i]).to_bytes(4, "little") + bytes((int(widths[i]), b - a))
        blocks.append(b"".join((head, bodies[i], places[a:b].tobytes(), high[a:b].tobytes())))
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
    return b"".join([np.array([n, count], "<u4").tobytes(), starts.astype("<u4").tobytes(), *blocks])


def unpack(payload: bytes) -> np.ndarray:
    """The ids of a payload."""
    n, count = np.frombuffer(payload, "<u4", 2).tolist()
    return unpack_blocks(payload, 0, count)[:n]


def unpack_blocks(payload: bytes, first: int, last: int) -> np.ndarray:
    """The ids of blocks ``first`` to ``last - 1``, found by the index; padding of the last block included."""
    count = int(np.frombuffer(payload, "<u4", 1, 4)[0])
    base = 8 + 4 * (count + 1)
    starts = np.frombuffer(payload, "<u4", last - first + 1, 8 + 4 * first).astype(np.int64) + base
    raw = np.frombuffer(payload, np.uint8)
    at = starts[:-1]
    low = sum(raw[at + k].astype(np.uint32) << np.uint32(8 * k) for k in range(4)) if len(at) else np.zeros(0, np.uint32)
    widths, extra = raw[at + 4].astype(np.int64), raw[at + 5].astype(np.int64)
    out = np.zeros((last - first, BLOCK), np.uint32)
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        size = BLOCK // 8 * int(width)
        out[own] = _values(raw[(at[own] + 6)[:, None] + np.arange(size)], int(width))
    total = int(extra.sum())
    if total:
        rows = np.repeat(np.arange(last - first), extra)
        nth = np.arange(total) - np.repeat(np.cumsum(extra) - extra, extra)
        lists = at + 6 + BLOCK // 8 * widths
        places = raw[lists[rows] + nth]
        value_at = lists[rows] + extra[rows] + 4 * nth
        high = sum(raw[value_at + k].astype(np.uint32) << np.uint32(8 * k) for k in range(4))
        out[rows, places] |= high << widths[rows].astype(np.uint32)
    return (out + low[:, None]).reshape(-1)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, percentile: float = PERCENTILE) -> None:
    """Encode whole texts and write their ids, each document's ended by ``end_id``, in ascending ``doc_id`` order."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        tool = encoder(tokenizer)
        end = np.array([end_id], tool.dtype).tobytes()
        keys: list[int | None] = []
        pieces: list[bytes] = []
        held = 0

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), tool.dtype)
            values = ([part], [segment], [first], [len(ids)], [keys], [[len(p) // tool.width for p in pieces]], [pack(ids, percentile)])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], ["part", "segment", "first", "n_ids", "doc_ids", "doc_sizes", "payload"])

        for batch in slices(batches, 256):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                pieces.append(tool.encode(text.as_py()) + end)
                held += len(pieces[-1]) // tool.width
                if held >= SEGMENT_IDS:
                    yield row()
                    segment, first, keys, pieces, held = segment + 1, first + held, [], [], 0
        if keys:
            yield row()

    arrow_map(ordered, encode, SEGMENTS).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def part_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part, by a sum over parts: as many rows as the writing stage had tasks."""
    sizes = read_segments(spark, path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    total, bases = 0, []
    for part, n in sorted(tuple(r) for r in sizes.collect()):
        bases.append((part, total))
        total += n
    return spark.createDataFrame(bases, "part int, base bigint")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row for each written document: its ids' place in the corpus, number and CRC-32, from the decoded blocks."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            part, first = batch.column("part")[0].as_py(), batch.column("first")[0].as_py()
            ids = unpack(batch.column("payload")[0].as_py()).astype("<u4")
            sizes = batch.column("doc_sizes").flatten().to_numpy()
            ends = np.cumsum(sizes)
            data = memoryview(ids.tobytes())
            crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
            yield pa.record_batch(
                [batch.column("doc_ids").flatten(), pa.array([part] * len(sizes), pa.int32()), pa.array(first + ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
            )

    segments = read_segments(spark, path).select("part", "first", "doc_ids", "doc_sizes", "payload")
    placed = arrow_map(segments, decode, DOCUMENTS).join(F.broadcast(part_offsets(spark, path)), "part")
    return placed.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
