"""Regression forests over sparse rows, with the settings and the trees of Spark ML's.

Spark ML's forest adds every row to the statistics of all slots of a node's choice, for each tree and level. Of thousands of hashed
text slots a row fills few. Here only the filled ones are added up, and what a slot's other rows hold is the node's total
less their sum. Bins, bootstrap weights, a node's choice of slots, gains and the rules for leaves are those of Spark ML; only the random draws differ.

Rows are binned where they lie and dealt by key to blocks of a bounded number of filled slots, which are written packed and by slot. Trees grow level by level: a task reads
a block for some of the trees, finds where its rows lie, and adds up the open nodes' bins. If all rows are one block, it goes on
to the last level, where only the smaller of two children is added up and the other is their parent's rest. Several blocks send their sums by node, where they are added and the split is
chosen, once for each level, while a node's rows are more than a task should hold. From there on its rows are sent instead, those of a few nodes to one task, which grows what is below them as if they were one block: so deep levels,
which have as many sums as cells, send none. Trees are dealt to lots, of which as many grow at a time as bounds what is sent. The driver holds the trees.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ..functions.sampling import in_sample
from ..session import bound_batches, discard, reach_workers, release, scratch_dir, stored

#: Filled slots that a block holds, sixteen bytes each while it is sorted and eight later, and those of one of its pieces.
BLOCK_CELLS, PIECE_CELLS = 8_000_000, 1_000_000
#: Filled slots of the rows that a task holds to grow what is below a few nodes, and those of all trees that grow at a time (some two bytes each are sent).
GROUP_CELLS, LOT_CELLS = 12_000_000, 4_000_000_000
#: Blocks from which shuffle files are released after each level.
MANY_BLOCKS = 8
#: Nodes of a tree whose bins are added up at once (an even number), and open nodes whose sums are kept for their children.
NODES, KEPT = 64, 64
#: Of all slots, the share that rows may fill to count as sparse, and slots from which it is looked at.
SPARSE_SHARE, SPARSE_SLOTS = 0.25, 256

_PIECES = "block int, first int, last int, codes int, cells int, data binary, labels binary"
_SUMS = "tree int, node int, w double, wy double, wyy double, cells double, size int, data binary"
_SPLITS = "tree int, node int, w double, wy double, wyy double, cells double, slot int, bin int, gain double"
_ROWS = "tree int, part int, block int, first int, codes int, cells int, data binary, roots binary, weights binary, labels binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)], [name for name, _ in fields])


def _planes(x: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers byte by byte of their values, to be compressed."""
    return x.astype(kind).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _numbers(body: bytes, size: int, at: int = 0) -> np.ndarray:
    return np.frombuffer(body, np.uint8, 4 * size, at).reshape(4, size).T.copy().view("<i4").reshape(size)


def shrink(codes: np.ndarray, rows: np.ndarray) -> tuple[int, int, bytes]:
    """Cells in order of their bins' codes: how many codes, how many cells, and both packed."""
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    body = _planes(np.diff(codes[starts], prepend=0)) + _planes(np.diff(starts, append=len(codes))) + _planes(np.diff(rows, prepend=0))
    return len(starts), len(codes), pa.compress(body, codec="zstd", asbytes=True)


def stretch(codes: int, cells: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The codes and rows of packed cells."""
    body = pa.decompress(data, 8 * codes + 4 * cells, codec="zstd", asbytes=True)
    found = np.repeat(np.cumsum(_numbers(body, codes), dtype=np.int32), _numbers(body, codes, 4 * codes))
    return found, np.cumsum(_numbers(body, cells, 8 * codes), dtype=np.int32)


def filled(vector: str) -> tuple[Column, Column]:
    """A vector's filled slots and their values."""
    inner = F.unwrap_udt(F.col(vector))
    slots = F.when(inner["type"] == 0, inner["indices"]).otherwise(F.sequence(F.lit(0), F.size(inner["values"]) - 1))
    return slots, inner["values"]


def suits(forest: RandomForestRegressor) -> bool:
    """Whether a forest has the settings that are followed here."""
    return (
        isinstance(forest, RandomForestRegressor) and forest.getFeatureSubsetStrategy() == "auto" and forest.getNumTrees() > 1
        and forest.getBootstrap() and forest.getMinInfoGain() == 0 and forest.getMinWeightFractionPerNode() == 0 and not forest.isSet("weightCol")
    )


def slot_thresholds(values: np.ndarray, counts: np.ndarray, sampled: float, splits: int) -> np.ndarray:
    """Thresholds of a slot from its filled values and their counts among ``sampled`` rows, as Spark ML finds them."""
    zeros = sampled - counts.sum()
    if zeros > 1e-9 * sampled:
        zeros += counts[values == 0].sum()
        values, counts = np.append(values[values != 0], 0.0), np.append(counts[values != 0], zeros)
    order = np.argsort(values)
    values, counts = values[order], counts[order]
    middles = (values[1:] + values[:-1]) / 2
    if len(middles) <= splits:
        return middles
    found, stride, total = [], sampled / (splits + 1), np.cumsum(counts)
    target = stride
    for middle, before, now in zip(middles, total[:-1], total[1:]):
        if abs(before - target) < abs(now - target):
            found.append(middle)
            target += stride
    return np.array(found[:splits])


def thresholds(rows: DataFrame, key: str, vector: str, count: int, slots: int, bins: int, seed: int) -> list[np.ndarray]:
    """Thresholds of every slot. Spark ML looks at this many rows for them, too."""
    wanted = max(bins * bins, 10_000)
    some = rows.where(in_sample(F.col(key), wanted / count, seed)) if wanted < count else rows
    at, values = filled(vector)
    some = some.select(F.arrays_zip(at.alias("slot"), values.alias("value")).alias("cells"))
    n = some.count()
    cells = some.select(F.explode("cells").alias("cell")).select("cell.slot", "cell.value").repartition(rows.sparkSession.sparkContext.defaultParallelism, "slot")
    cells = cells.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"))
    splits = min(bins, count) - 1

    def find(group: pa.Table) -> pa.Table:
        found = slot_thresholds(group["value"].to_numpy(), group["n"].to_numpy(), n, splits)
        return pa.table({"slot": pa.array([group["slot"][0].as_py()], pa.int32()), "found": pa.array([found.tolist()], pa.list_(pa.float64()))})

    out = [np.zeros(0)] * slots
    for slot, found in cells.groupBy("slot").applyInArrow(find, "slot int, found array<double>").collect():
        out[slot] = np.array(found)
    return out


class Bins:
    """Places of all slots' bins in one line: the first of each slot, and that of zero."""

    def __init__(self, found: list[np.ndarray]):
        self.firsts = np.concatenate([[0], np.cumsum([len(f) + 1 for f in found])]).astype(np.int64)
        self.zeros = self.firsts[:-1] + np.array([np.searchsorted(f, 0.0) for f in found], np.int64)

    def best(self, n: np.ndarray, y: np.ndarray, first: int, last: int, w: np.ndarray, wy: np.ndarray, chosen: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best slot, bin and gain of each node (a column of weights ``n`` and sums ``y``, a row a bin) among ``chosen`` slots of a range."""
        starts = self.firsts[first:last] - self.firsts[first]
        widths = np.diff(self.firsts[first : last + 1])
        zeros = self.zeros[first:last] - self.firsts[first]
        for sums, total in ((n, w), (y, wy)):
            sums[zeros] += total - np.add.reduceat(sums, starts, axis=0)
            np.cumsum(sums, axis=0, out=sums)
            before = np.concatenate([np.zeros((1, sums.shape[1])), sums[starts[1:] - 1]])
            sums -= np.repeat(before, widths, axis=0)
        right, right_y = w - n, wy - y
        fair = (n > least - 0.5) & (right > least - 0.5) & np.repeat(chosen, widths, axis=0)
        fair[starts + widths - 1] = False
        at, node = np.nonzero(fair)
        score = np.full(n.shape, -np.inf)
        score[at, node] = y[at, node] ** 2 / n[at, node] + right_y[at, node] ** 2 / right[at, node]
        top = np.argmax(score, axis=0)
        gain = (score[top, np.arange(len(w))] - wy**2 / w) / w
        slot = np.searchsorted(starts, top, "right") - 1
        return slot + first, top - starts[slot], gain


class Tree:
    """Nodes by number, children after their parents."""

    def __init__(self, levels: tuple[int, ...] = (0,)):
        """``levels`` are those of the roots: a tree has one, what is below some nodes of a tree has several."""
        none = [-1] * len(levels)
        self.slot, self.bin, self.left, self.level, self.stats, self.gain = none[:], none[:], none[:], list(levels), [None] * len(levels), [-1.0] * len(levels)

    def extend(self, splits: list[tuple], depth: int) -> list[int]:
        """Take the sums and best splits of nodes in their order, and open the children."""
        opened = []
        for node, w, wy, wyy, _, slot, cut, gain in splits:
            self.stats[node] = (w, wy, wyy)
            spread = wyy / w - (wy / w) ** 2 if w else 0.0
            if self.level[node] < depth and gain > 1e-12 * spread > 0:
                self.split(node, slot, cut, gain)
                opened += [self.left[node], self.left[node] + 1]
        return opened

    def split(self, node: int, slot: int, bin: int, gain: float) -> None:
        self.slot[node], self.bin[node], self.gain[node], self.left[node] = slot, bin, gain, len(self.slot)
        for _ in range(2):
            for values, start in ((self.slot, -1), (self.bin, -1), (self.left, -1), (self.level, self.level[node] + 1), (self.stats, None), (self.gain, -1.0)):
                values.append(start)


    def graft(self, below: Tree, roots: list[int]) -> None:
        """Take over what has grown below ``roots``."""
        place = dict(enumerate(roots))
        for node, left in enumerate(below.left):
            here = place[node]
            self.stats[here] = below.stats[node]
            if left >= 0:
                self.split(here, below.slot[node], below.bin[node], below.gain[node])
                place[left], place[left + 1] = self.left[here], self.left[here] + 1


class Block:
    """Rows' labels and filled slots, by slot, in pieces of whole slots: first and last slot, bounds of slots, rows, codes of bins."""

    def __init__(self, number: int, y: np.ndarray, bins: Bins):
        self.number, self.y, self.bins = number, y, bins
        self.pieces: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        self.of = np.full(len(bins.zeros), -1, np.int32)

    def add(self, first: int, last: int, codes: np.ndarray, rows: np.ndarray) -> None:
        self.of[first:last] = len(self.pieces)
        self.pieces.append((first, last, np.searchsorted(codes, self.bins.firsts[first : last + 1]), rows, codes))

    @staticmethod
    def read(batches: Iterator[pa.RecordBatch], bins: Bins) -> Iterator[Block]:
        """Blocks of ``_PIECES``. A block's rows stand together, its labels first."""
        block = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["labels"]:
                    if block is not None:
                        yield block
                    block = Block(row["block"], np.frombuffer(row["labels"]), bins)
                else:
                    block.add(row["first"], row["last"], *stretch(row["codes"], row["cells"], row["data"]))
        if block is not None:
            yield block

    @staticmethod
    def cuts(codes: np.ndarray, bins: Bins, size: int = PIECE_CELLS) -> Iterator[tuple[int, int, slice]]:
        """Pieces of sorted codes: slots and places of whole slots with ``size`` cells or more."""
        starts, first, slots = np.searchsorted(codes, bins.firsts), 0, len(bins.zeros)
        while first < slots:
            last = min(slots, max(first + 1, int(np.searchsorted(starts, starts[first] + size))))
            yield first, last, slice(starts[first], starts[last])
            first = last

    def cells(self) -> np.ndarray:
        """Filled slots of each row."""
        return sum((np.bincount(rows, minlength=len(self.y)) for _, _, _, rows, _ in self.pieces), np.zeros(len(self.y), np.int64))

    def column(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        first, _, starts, rows, codes = self.pieces[self.of[slot]]
        part = slice(starts[slot - first], starts[slot - first + 1])
        return rows[part], codes[part]

    def moved(self, at: np.ndarray, tree: Tree, nodes: list[int]) -> np.ndarray:
        """The nodes of rows, where those in ``nodes`` go on to these' children."""
        inner = [(n, tree.slot[n], int(self.bins.firsts[tree.slot[n]]) + tree.bin[n], tree.left[n]) for n in nodes if tree.slot[n] >= 0]
        if not inner:
            return at
        default = np.arange(len(tree.slot), dtype=np.int32)
        for node, slot, cut, left in inner:
            default[node] = left + (self.bins.zeros[slot] > cut)
        new = default[at]
        for node, slot, cut, left in inner:
            rows, codes = self.column(slot)
            here = at[rows] == node
            new[rows[here]] = left + (codes[here] > cut)
        return new

    def places(self, tree: Tree) -> np.ndarray:
        """The node in which each row lies."""
        at, level = np.zeros(len(self.y), np.int32), np.array(tree.level)
        for depth in range(level.max()):
            at = self.moved(at, tree, np.flatnonzero(level == depth).tolist())
        return at


def binned(rows: DataFrame, key: str, vector: str, label: str, found: list[np.ndarray], blocks: int) -> DataFrame:
    """Blocks of rows, a partition each: ``_PIECES``. Filled slots in the bin of zero are left out."""
    at, values = filled(vector)
    cells = rows.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"), at.alias("at"), values.alias("values"))
    bins = Bins(found)
    sent = rows.sparkSession.sparkContext.broadcast((found, bins))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are binned before they are dealt: a filled slot is one number then."""
        found, bins = sent.value
        for batch in batches:
            lengths = batch.column("at").value_lengths().to_numpy()
            slot, value = batch.column("at").flatten().to_numpy(), batch.column("values").flatten().to_numpy()
            order = np.argsort(slot, kind="stable")
            here, starts = np.unique(slot[order], return_index=True)
            codes = np.zeros(len(slot), np.int32)
            for s, own in zip(here.tolist(), np.split(order, starts[1:])):
                codes[own] = bins.firsts[s] + np.searchsorted(found[s], value[own])
            other = codes != bins.zeros[slot]
            edges = np.append(0, np.cumsum(np.bincount(np.repeat(np.arange(len(lengths)), lengths)[other], minlength=len(lengths))))
            codes = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(codes[other], pa.int32()))
            yield pa.record_batch([batch.column("key"), batch.column("y"), codes], ["key", "y", "codes"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = sent.value[1]
        block, labels, kept, n = TaskContext.get().partitionId(), [], [], 0
        for batch in batches:
            lengths = batch.column("codes").value_lengths().to_numpy()
            kept.append((batch.column("codes").flatten().to_numpy().astype(np.int64) << 32) | np.repeat(np.arange(n, n + len(lengths)), lengths))
            labels.append(batch.column("y").to_numpy())
            n += len(lengths)
        if not n:
            return
        codes, row = _sorted_cells(kept)
        yield _batch([(block, 0, 0, 0, 0, b"", np.concatenate(labels).tobytes())], _PIECES)
        for first, last, part in Block.cuts(codes, bins):
            yield _batch([(block, first, last, *shrink(codes[part], row[part]), b"")], _PIECES)

    kind = StructType([StructField("key", rows.schema[key].dataType), StructField("y", DoubleType()), StructField("codes", ArrayType(IntegerType()))])
    return cells.mapInArrow(code, kind).repartition(blocks, "key").sortWithinPartitions("key").mapInArrow(build, _PIECES)


def _sorted_cells(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and rows of cells, sorted; ``parts`` have the code above the row and are emptied, so that little is held twice."""
    cells = np.concatenate(parts)
    parts.clear()
    cells.sort()
    row = cells.astype(np.int32)  # the lower half
    cells >>= 32
    return cells.astype(np.int32), row


def fit_sparse(
    forest: RandomForestRegressor, rows: DataFrame, key: str, count: int, cells: int, cells_per_block: int = BLOCK_CELLS,
    cells_per_group: int = GROUP_CELLS, spent: Callable[[], object] = lambda: None,
) -> RandomForestRegressionModel:
    """Fit a regression forest on ``count`` rows with ``cells`` filled slots. The draws depend on the seed, the tree, the node and the block, so a fit repeats.

    ``spent`` is called when the rows are read for the last time.
    """
    spark = rows.sparkSession
    reach_workers(spark)
    bound_batches(spark)
    vector, label, seed, total = forest.getFeaturesCol(), forest.getLabelCol(), forest.getSeed(), forest.getNumTrees()
    slots = rows.schema[vector].metadata["ml_attr"]["num_attrs"]
    depth, least, rate = forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSubsamplingRate()
    asked, start = -(-slots // 3), seed % (1 << 63)
    blocks = max(1, -(-cells // cells_per_block))
    found = thresholds(rows, key, vector, count, slots, forest.getMaxBins(), seed + 1)  # another draw than that of the test rows
    # Written, so that nothing before the blocks is held for them.
    pieces = stored(binned(rows, key, vector, label, found, blocks), "blocks")
    spent()
    together = total if blocks == 1 else max(1, min(total, LOT_CELLS // cells))
    groups = min(together, max(1, -(-3 * spark.sparkContext.defaultParallelism // blocks)))
    lots = groups if blocks == 1 else -(-total // (together // groups))
    places = spark.sparkContext.broadcast(Bins(found))
    kind = _SUMS if blocks > 1 else _SPLITS

    def choice(tree: int, nodes: list[int], below: int | None = None) -> np.ndarray:
        """Which slots each node may split on. ``below`` is the first of the nodes below which these are numbered anew."""
        out = np.zeros((slots, len(nodes)), bool)
        for i, node in enumerate(nodes):
            own = [start, tree, node] if below is None else [start, tree, (1 << 33) + below, node]
            out[np.random.default_rng(own).choice(slots, asked, replace=False, shuffle=False), i] = True
        return out

    def bag(t: int, block: Block) -> np.ndarray:
        """How often a tree takes each row."""
        return np.random.default_rng([start, t, 1 << 32, block.number]).poisson(rate, len(block.y)).astype(float)

    def add(trees: dict[int, Tree], opened: dict[int, list[int]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in Block.read(batches, places.value):
                own = block.cells().astype(float)
                for t, nodes in opened.items():
                    w, at = bag(t, block), block.places(trees[t])
                    if blocks == 1:
                        yield from whole(t, trees[t], nodes, at, w, block, own)
                        continue
                    for lot in range(0, len(nodes), NODES):
                        yield _batch(sums(t, trees[t], nodes[lot : lot + NODES], at, w, block, own, {}, {}, False), kind)

        return run

    def whole(t: int, tree: Tree, nodes: list[int], at: np.ndarray, w: np.ndarray, block: Block, own: np.ndarray, below: int | None = None) -> Iterator[pa.RecordBatch]:
        """Grow what is below ``nodes``, all of whose rows are at hand: ``_SPLITS``."""
        kept: dict[int, tuple] = {}
        while nodes:
            done, parents, kept = [], {tree.left[p]: x for p, x in kept.items()}, {}
            for lot in range(0, len(nodes), NODES):
                found = sums(t, tree, nodes[lot : lot + NODES], at, w, block, own, parents, kept, True, below)
                done += [row[1:] for row in found]
                yield _batch(found, _SPLITS)
            opened = tree.extend(done, depth)
            at = block.moved(at, tree, nodes)
            nodes = opened

    def deal(trees: dict[int, Tree], parts: dict[int, list[list[int]]]):
        """Send the rows of nodes: ``_ROWS`` for each part, a list of nodes, of a tree."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in Block.read(batches, places.value):
                for t, lists in parts.items():
                    w = bag(t, block)
                    part, root = np.full((2, len(trees[t].slot)), -1, np.int32)
                    for i, nodes in enumerate(lists):
                        part[nodes], root[nodes] = i, np.arange(len(nodes))
                    at = block.places(trees[t])
                    mine = np.where(w > 0, part[at], -1).astype(np.int16 if len(lists) < 1 << 15 else np.int32)
                    order = np.argsort(mine, kind="stable")
                    edges = np.searchsorted(mine[order], np.arange(len(lists) + 1))
                    new = np.zeros(len(mine), np.int32)  # a row's place among those of its part
                    new[order] = np.arange(len(mine)) - np.append(edges[:1], edges)[mine[order] + 1] if len(mine) else 0
                    for i in range(len(lists)):
                        if edges[i] < edges[i + 1]:
                            some = order[edges[i] : edges[i + 1]]
                            rest = (root[at[some]].astype("<i4").tobytes(), w[some].astype("<u2").tobytes(), block.y[some].tobytes())
                            yield _batch([(t, i, block.number, -1, 0, 0, b"", *rest)], _ROWS)
                    for first, _, _, rows, codes in block.pieces:
                        own = mine[rows]
                        keep = np.flatnonzero(own >= 0)
                        keep = keep[np.argsort(own[keep], kind="stable")]
                        cuts = np.searchsorted(own[keep], np.arange(len(lists) + 1))
                        for i in range(len(lists)):
                            if len(some := keep[cuts[i] : cuts[i + 1]]):
                                yield _batch([(t, i, block.number, first, *shrink(codes[some], new[rows[some]]), b"", b"", b"")], _ROWS)

        return run

    def below(levels: dict[tuple[int, int], tuple[int, tuple[int, ...]]]):
        """Grow parts of trees from their rows, which stand together by part. ``levels``: a part's first node and the levels of its nodes."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bins, now, cells, rows, n = places.value, None, [], [], 0

            def done() -> Iterator[pa.RecordBatch]:
                roots, w, y = (np.concatenate(x) for x in zip(*rows))
                rows.clear()
                codes, row = _sorted_cells(cells) if cells else np.zeros((2, 0), np.int32)
                block = Block(0, y, bins)
                for first, last, part in Block.cuts(codes, bins):
                    block.add(first, last, codes[part], row[part])
                first, own = levels[now]
                for batch in whole(now[0], Tree(own), list(range(len(own))), roots, w, block, block.cells().astype(float), first):
                    yield pa.record_batch([pa.array([now[1]] * batch.num_rows, pa.int32()), *batch.columns], ["part", *batch.schema.names])

            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    if now != (row["tree"], row["part"]):
                        if now:
                            yield from done()
                        now, n = (row["tree"], row["part"]), 0
                    if row["first"] < 0:
                        n += len(rows[-1][0]) if rows else 0  # rows of the blocks before
                        rows.append(tuple(np.frombuffer(row[c], k).astype(to) for c, k, to in (("roots", "<i4", np.int32), ("weights", "<u2", float), ("labels", "<f8", float))))
                    else:
                        codes, of = stretch(row["codes"], row["cells"], row["data"])
                        cells.append((codes.astype(np.int64) << 32) | (of.astype(np.int64) + n))
            if now:
                yield from done()

        return run

    def sums(
        t: int, tree: Tree, nodes: list[int], at: np.ndarray, w: np.ndarray, block: Block, own: np.ndarray,
        parents: dict[int, tuple], kept: dict[int, tuple], every: bool, below: int | None = None,
    ) -> list[tuple]:
        """Rows of ``_SPLITS`` for some nodes of a tree from all rows (``every``), or of ``_SUMS`` from a block of them. ``parents`` are the bins of left children's parents."""
        bins = block.bins
        lookup = np.full(len(tree.slot), -1, np.int16)
        lookup[nodes] = np.arange(len(nodes))
        mine, wy = lookup[at], w * block.y
        mine[w == 0] = -1
        some = mine >= 0
        stats = [np.bincount(mine[some], x[some], len(nodes)) for x in (w, wy, wy * block.y, own)]
        # All rows at hand, small nodes are known to be leaves.
        wide = np.array([tree.level[n] < depth and (not every or stats[0][i] >= 2 * least) for i, n in enumerate(nodes)])
        chosen = choice(t, [n for n, x in zip(nodes, wide) if x], below)
        added, rest = [], {}
        for j in range(0, len(nodes), 2):
            pair = [i for i in (j, j + 1) if i < len(nodes)]
            if every and nodes[j] in parents and wide[pair].any():
                small, big = sorted(pair, key=lambda i: stats[0][i])
                added.append(small)
                rest[big] = (small, parents[nodes[j]])
            else:
                added += [i for i in pair if wide[i]]
        line = {j: i for i, j in enumerate(added)}
        k = len(added)
        back = np.full(len(nodes) + 1, -1, np.int16)
        back[added] = np.arange(k)
        mine = back[mine]
        n, y = np.zeros((2, bins.firsts[-1], k))
        for first, last, _, rows, codes in block.pieces if k else []:
            part = slice(bins.firsts[first], bins.firsts[last])
            node = mine[rows]
            keep = np.flatnonzero(node >= 0)
            node, r = node[keep], rows[keep]
            code = (codes[keep] - part.start) * k + node
            for out, x in ((n, w), (y, wy)):
                out[part] = np.bincount(code, x[r], (part.stop - part.start) * k).reshape(-1, k)
        if not every:
            n[~np.repeat(chosen, np.diff(bins.firsts), axis=0)] = 0
            out = []
            for j, node in enumerate(nodes):
                here = np.flatnonzero(n[:, line[j]]) if wide[j] else np.zeros(0, np.int64)
                body = _planes(np.diff(here, prepend=0)) + _planes(n[here, line[j]]) + y[here, line[j]].tobytes() if len(here) else b""
                out.append((t, node, *(x[j].item() for x in stats), len(here), pa.compress(body, codec="zstd", asbytes=True) if body else b""))
            return out
        wanted = np.flatnonzero(wide).tolist()
        both = []
        for x, which in ((n, 0), (y, 1)):
            of = [x[:, line[j]] if j in line else rest[j][1][which] - x[:, line[rest[j][0]]] for j in wanted]
            both.append(np.stack(of, axis=1) if of else x)
        for i in sorted(range(len(wanted)), key=lambda i: -stats[0][wanted[i]])[: max(0, KEPT - len(kept))]:
            kept[nodes[wanted[i]]] = tuple(x[:, i].copy() for x in both)
        best = bins.best(*both, 0, slots, stats[0][wanted], stats[1][wanted], chosen, least) if wanted else ()
        place = {j: i for i, j in enumerate(wanted)}
        return [
            (t, node, *(x[j].item() for x in stats), *((x[place[j]].item() for x in best) if j in place else (-1, -1, -np.inf)))
            for j, node in enumerate(nodes)
        ]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the blocks, which stand together by node, are added and the best split is found."""
        bins, now, n, y, stats = places.value, None, None, None, None

        def done() -> pa.RecordBatch:
            slot, cut, gain = -1, -1, -np.inf
            if stats[0] >= 2 * least and n.any():
                slot, cut, gain = (x[0] for x in bins.best(n[:, None], y[:, None], 0, slots, *(stats[i : i + 1] for i in (0, 1)), choice(now[0], [now[1]]), least))
            return _batch([(*now, *stats, int(slot), int(cut), float(gain))], _SPLITS)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if now != (row["tree"], row["node"]):
                    if now:
                        yield done()
                    now, stats = (row["tree"], row["node"]), np.zeros(4)
                    n, y = np.zeros(bins.firsts[-1]), np.zeros(bins.firsts[-1])
                stats += (row["w"], row["wy"], row["wyy"], row["cells"])
                if size := row["size"]:
                    body = pa.decompress(row["data"], 16 * size, codec="zstd", asbytes=True)
                    codes = np.cumsum(_numbers(body, size))
                    n[codes] += _numbers(body, size, 4 * size)
                    y[codes] += np.frombuffer(body, "<f8", size, 8 * size)
        if now:
            yield done()

    def grow(group: int) -> dict[int, Tree]:
        trees = {t: Tree() for t in range(group, total, lots)}
        opened, small = {t: [0] for t in trees}, {t: [] for t in trees}
        while opened:
            splits = pieces.mapInArrow(add(trees, opened), kind)
            if blocks > 1:
                splits = splits.repartition("tree", "node").sortWithinPartitions("tree", "node").mapInArrow(choose, _SPLITS)
            found: dict[int, list] = {t: [] for t in opened}
            for t, *split in sorted(splits.collect()):
                found[t].append(split)
            opened = {t: new for t, rows in found.items() if (new := trees[t].extend(rows, depth)) and blocks > 1}
            for t, nodes in list(opened.items()):
                # Both children's cells are known: their parent's.
                held = {trees[t].left[node]: cells for node, _, _, _, cells, *_ in found[t] if cells <= cells_per_group and trees[t].left[node] >= 0}
                small[t] += [(left, cells) for left, cells in held.items()]
                if not (rest := [n for n in nodes if n not in held and n - 1 not in held]):
                    del opened[t]
                else:
                    opened[t] = rest
            del splits
            if blocks >= MANY_BLOCKS:
                release(spark)
        parts = {t: packed(pairs) for t, pairs in small.items() if pairs}
        if parts:
            levels = {(t, i): (nodes[0], tuple(trees[t].level[n] for n in nodes)) for t, lists in parts.items() for i, nodes in enumerate(lists)}
            sent = pieces.mapInArrow(deal(trees, parts), _ROWS)
            # Labels come before cells, block by block.
            sent = sent.repartition(len(levels), "tree", "part").sortWithinPartitions("tree", "part", "block", "first")
            splits = sorted(sent.mapInArrow(below(levels), f"part int, {_SPLITS}").collect(), key=lambda r: (r.tree, r.part, r.node))
            for (t, i), nodes in ((k, parts[k[0]][k[1]]) for k in levels):
                tree = Tree(levels[t, i][1])
                tree.extend([tuple(r)[2:] for r in splits if (r.tree, r.part) == (t, i)], depth)
                trees[t].graft(tree, nodes)
            del sent
            if blocks >= MANY_BLOCKS:
                release(spark)
        return trees

    def packed(pairs: list[tuple[int, float]]) -> list[list[int]]:
        """Pairs of children, by the first and their cells, in lists of so many cells as a task should hold."""
        lists, held = [], float("inf")
        for left, cells in sorted(pairs):
            if held + cells > cells_per_group:
                lists.append([])
                held = 0
            lists[-1] += [left, left + 1]
            held += cells
        return lists

    try:
        with ThreadPoolExecutor(groups) as pool:
            grown = list(pool.map(inheritable_thread_target(spark)(grow), range(lots)))
    finally:
        discard(pieces)
    trees = {t: grown[t % lots][t] for t in range(total)}
    return as_model(spark, forest, trees, found, slots)


def as_model(spark: SparkSession, forest: RandomForestRegressor, trees: dict[int, Tree], found: list[np.ndarray], slots: int) -> RandomForestRegressionModel:
    """Trees as a model of Spark ML, by way of the files in which it keeps models."""
    path = scratch_dir(spark, "forest")
    columns: dict[str, list] = {c: [] for c in ("tree", "id", "prediction", "impurity", "stats", "n", "gain", "left", "right", "slot", "cut")}
    for t, tree in trees.items():
        for node, (w, wy, wyy) in enumerate(tree.stats):
            slot, left = tree.slot[node], tree.left[node]
            mean = wy / w if w else 0.0
            values = (
                t, node, mean, max(0.0, wyy / w - mean * mean) if w else 0.0, [w, wy, wyy], int(w), tree.gain[node], left, left + 1 if left >= 0 else -1,
                slot, [float(found[slot][tree.bin[node]])] if slot >= 0 else [],
            )
            for column, value in zip(columns.values(), values):
                column.append(value)
    kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()))
    nodes = spark.createDataFrame(pa.table([pa.array(v, k) for v, k in zip(columns.values(), kinds)], list(columns)))
    split = F.struct(F.col("slot").alias("featureIndex"), F.col("cut").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    data = F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("n").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
    )
    nodes.select(F.col("tree").alias("treeID"), data.alias("nodeData")).write.parquet(f"{path}/data")

    def metadata(kind: str, uid: str, **more) -> str:
        return json.dumps({
            "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
            "paramMap": {}, "defaultParamMap": {"impurity": "variance"}, **more,
        })

    each = [(t, metadata("DecisionTreeRegressionModel", f"{forest.uid}_{t}"), 1.0) for t in trees]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    whole = metadata("RandomForestRegressionModel", forest.uid, numFeatures=slots, numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    model = forest._copyValues(RandomForestRegressionModel.load(path))
    model._transfer_params_to_java()
    return model

