"""Hard negatives by inner product, through packed trees of bounding boxes.

Components become integers, so scores are exact. Rows are tiled by sort-tile-recursive packing: sorted
by one coordinate and cut into slabs of equal size, each of which is sorted by the next one, and so on,
down to leaves of ``LEAF`` rows. The label is the first coordinate, then come components by their
variance. Upper tiles are cut where a bounded sample says, and give the shards that tasks pack; a
shard with too many rows, as where many are alike, is dealt by a hash of the ids. The index is a written
table of leaves, each with the box around its rows; a task packs boxes of boxes on top of some hundreds of them.

A box gives each coordinate's interval of products with a query's component, and their sum an interval that
holds the scores of all rows inside. A query asks for the best ``k`` rows of its own label, or of others,
with scores in a window. It always opens its best box next, and never one without a fitting label, outside its
window, or strictly below its ``k``-th best row so far; boxes of equal score are opened, as their ids may
be smaller. Queries of a block go through a task's trees together, so that all that open a leaf now are scored by
one product of matrices. Bounds are rounded outwards; scores never are.

Anchors go to the tasks in blocks of ``ANCHORS``, each in one scan for their positives and one for the
negatives in the positives' windows. No row is left out for being in a large or a dense part.

Defined cases: rows without id or label take no part, nor do those whose vector is null or holds null or non-finite
components, has another length than most have (of equally many, the shorter), or is so long (a squared
length of 2^62 or more after scaling) that scores may not fit in 64 bits; rows of one ``vec_id``
are candidates of their own, but together one anchor, with the least of their labels and vectors, and never
its candidates; equal scores rank by the smaller ``vec_id``; a negative positive score has an empty window;
other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_dir
from .common import arrow_map, reach_workers, release, slices, stored

LEAF, FANOUT = 256, 16
#: Leaves that a task has on hand as one tree.
TREE_LEAVES = 256
#: Rows of a shard, rows that say where shards are cut, and of those the least for each shard.
SHARD_ROWS, SAMPLE, LEAST_SAMPLE = 1 << 15, 1 << 14, 16
#: Anchors that are sent to the tasks at once, and queries that go through a tree together.
ANCHORS, TOGETHER = 1 << 14, 1 << 12
#: Component unit: a component is multiplied by this and rounded down.
UNIT = 256

_LEAVES = "shard bigint, ids array<bigint>, labels array<bigint>, vectors array<bigint>"
_FOUND = "query int, id bigint, score bigint"
RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, label, v)`` of the rows that take part, but for their length; ``v`` in units."""
    x = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).cast("bigint").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = F.aggregate("x", F.lit(0.0), lambda s, c: s + F.pow(F.abs(c) * UNIT + 1, 2)) < 2.0**62
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & finite & fits)
    return rows.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * UNIT)).alias("v"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(rows, len(flat) // rows if rows else 0)


def slabs(size: int, tiles: int, coordinates: int) -> int:
    """Rows of a slab where ``size`` rows are to become ``tiles`` tiles by so many coordinates."""
    return -(-size // max(2, int(np.ceil(tiles ** (1 / max(coordinates, 1)))))) if tiles > 1 else size


@dataclass
class Cut:
    """Slabs of one coordinate: ``bounds`` between them, and what each is cut into; a tile's number if nothing."""

    coordinate: int
    bounds: np.ndarray
    parts: list[Cut | int]

    def tiles(self, rows: np.ndarray) -> np.ndarray:
        out, of = np.empty(len(rows), np.int64), np.searchsorted(self.bounds, rows[:, self.coordinate], "right")
        for n, part in enumerate(self.parts):
            own = of == n
            if own.any():
                out[own] = part if isinstance(part, int) else part.tiles(rows[own])
        return out


def cuts(sample: np.ndarray, order: list[int], tiles: int) -> Cut | int:
    """Where sort-tile-recursive packing of a sample into tiles cuts; coordinates in the given order, again and again."""
    numbers = iter(range(1 << 62))

    def cut(rows: np.ndarray, depth: int, tiles: int) -> Cut | int:
        if tiles <= 1 or len(rows) < 2:
            return next(numbers)
        c = order[depth % len(order)]
        rows = rows[np.argsort(rows[:, c], kind="stable")]
        step = slabs(len(rows), tiles, len(order) - depth % len(order))
        starts = list(range(0, len(rows), step))
        parts = [cut(rows[s : s + step], depth + 1, -(-tiles // len(starts))) for s in starts]
        return Cut(c, rows[starts[1:], c], parts)

    return cut(sample, 0, tiles)


def packed(rows: np.ndarray, order: list[int], leaf: int = LEAF) -> Iterator[np.ndarray]:
    """Places of rows, leaf by leaf, so that leaves in a row lie next to each other."""

    def tile(places: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        if len(places) <= leaf:
            yield places
            return
        places = places[np.argsort(rows[places, order[depth % len(order)]], kind="stable")]
        tiles = -(-len(places) // leaf)
        step = -(-slabs(len(places), tiles, len(order) - depth % len(order)) // leaf) * leaf
        for start in range(0, len(places), step):
            yield from tile(places[start : start + step], depth + 1)

    if len(rows):
        yield from tile(np.arange(len(rows)), 0)


@dataclass
class Index:
    leaves: DataFrame
    anchors: DataFrame  # (id, label, v), one row an id
    size: int  # components


def build_index(rows: DataFrame, divisor: int, shard_rows: int = SHARD_ROWS, leaf: int = LEAF) -> Index:
    """Leaves of all usable rows, written."""
    spark = rows.sparkSession
    rows = stored(rows, "rows")
    counted = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size, count = (counted["n"], counted["count"]) if counted else (0, 0)
    rows = rows.where(F.size("v") == size)
    sample = rows.orderBy(F.xxhash64("vec_id", "label", "v")).limit(SAMPLE).select("label", "v").collect()
    points = np.array([[r["label"], *r["v"]] for r in sample], np.int64).reshape(len(sample), size + 1)
    spread = points[:, 1:].astype(float).var(axis=0) if len(points) else np.zeros(size)
    order = [0, *(1 + np.argsort(-spread, kind="stable")).tolist()]
    tree = cuts(points, order, min(-(-count // shard_rows), len(points) // LEAST_SAMPLE))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(1).to_numpy(), _matrix(batch.column(2), batch.num_rows)])
            tiles = np.full(len(x), tree) if isinstance(tree, int) else tree.tiles(x)
            yield pa.record_batch([*batch.columns, pa.array(tiles, pa.int64())], ["vec_id", "label", "v", "tile"])

    tiled = stored(arrow_map(rows, assign, "vec_id bigint, label bigint, v array<bigint>, tile bigint"), "tiles")
    # One row for each shard's worth of rows of the sample's tiles, which are at most SAMPLE / LEAST_SAMPLE.
    pieces = tiled.groupBy("tile").count().select("tile", F.ceil(F.col("count") / shard_rows).alias("pieces"))
    shard = F.col("tile") * (1 << 32) + F.pmod(F.xxhash64("vec_id", "v"), "pieces")
    sharded = tiled.join(F.broadcast(pieces), "tile").select(shard.alias("shard"), "vec_id", "label", "v")

    def pack(table: pa.Table) -> pa.Table:
        ids, labels = table.column("vec_id").to_numpy(), table.column("label").to_numpy()
        x = _matrix(table.column("v").combine_chunks(), len(ids))
        found = [places[np.argsort(ids[places], kind="stable")] for places in packed(np.column_stack([labels, x]), order, leaf)]
        columns = [[a[p].ravel() for p in found] for a in (ids, labels, x)]
        kind = pa.list_(pa.int64())
        return pa.table([pa.array([table.column("shard")[0].as_py()] * len(found)), *(pa.array(c, kind) for c in columns)], ["shard", "ids", "labels", "vectors"])

    reach_workers(spark)
    leaves = stored(sharded.groupBy("shard").applyInArrow(pack, _LEAVES), "leaves")
    anchors = rows.where(F.col("vec_id") % divisor == 0).groupBy(F.col("vec_id").alias("id")).agg(F.min(F.struct("label", "v")).alias("row"))
    return Index(leaves, anchors.select("id", "row.label", "row.v"), size)


@dataclass
class Queries:
    """What is asked for: the best ``k`` rows of the label (``same``) or of others, with scores from ``low`` to ``high``."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool
    k: int

    def part(self, at: slice) -> Queries:
        return Queries(self.ids[at], self.labels[at], self.vectors[at], self.low[at], self.high[at], self.same, self.k)


class Tree:
    """Leaves, and boxes of ``FANOUT`` boxes above them, up to one root; nodes are numbered leaves first, the root last."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]], fanout: int = FANOUT):
        self.leaves = leaves
        lows, highs = ([np.array([[f(l), *f(x, axis=0)] for _, l, x in leaves], np.int64)] for f in (np.min, np.max))
        self.children: list[range] = [range(0)] * len(leaves)
        first = 0
        while len(lows[-1]) > 1:
            starts = np.arange(0, len(lows[-1]), fanout)
            self.children += [range(first + s, first + min(s + fanout, len(lows[-1]))) for s in starts.tolist()]
            first += len(lows[-1])
            lows.append(np.minimum.reduceat(lows[-1], starts))
            highs.append(np.maximum.reduceat(highs[-1], starts))
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.largest = max(float(np.sqrt((x.astype(float) ** 2).sum(axis=1).max())) for _, _, x in leaves)

    def bounds(self, q: Queries, nodes: list[int]) -> np.ndarray:
        """The best score that each query may find below each node, rounded up; -inf where it finds none."""
        v = q.vectors.astype(float)
        up, down = np.maximum(v, 0), np.minimum(v, 0)
        low, high = self.low[nodes, 1:].astype(float), self.high[nodes, 1:].astype(float)
        slack = (np.abs(v) @ np.maximum(np.abs(low), np.abs(high)).T) * (v.shape[1] + 4) * 2.0**-51
        most, least = up @ high.T + down @ low.T + slack, up @ low.T + down @ high.T - slack
        ends = [np.nextafter(e.astype(float), way)[:, None] for e, way in ((q.low, -np.inf), (q.high, np.inf))]
        first, last = self.low[nodes, 0], self.high[nodes, 0]
        own = q.labels[:, None]
        fits = (first <= own) & (own <= last) if q.same else (first != own) | (last != own)
        return np.where(fits & (most >= ends[0]) & (least <= ends[1]), np.minimum(most, ends[1]), -np.inf)


def _scores(vectors: np.ndarray, rows: np.ndarray, largest: float) -> np.ndarray:
    """Inner products, exactly: in doubles where no sum of products can leave 53 bits."""
    if len(vectors) and largest * float(np.sqrt((vectors.astype(float) ** 2).sum(axis=1).max())) < 2.0**52:
        return (vectors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return vectors @ rows.T


def search(tree: Tree, q: Queries, ids: np.ndarray, best: np.ndarray) -> None:
    """Take the tree's rows into the best ones so far: ``ids`` and ``best`` (scores), k a query, ``NONE`` where there are fewer."""
    live = np.arange(len(q.ids))
    open_ = np.full((len(live), len(tree.children)), -np.inf)
    open_[:, -1] = tree.bounds(q, [len(tree.children) - 1])[:, 0]
    while len(live):
        node = open_[live].argmax(axis=1)
        top = open_[live, node]
        going = (top > -np.inf) & (top >= best[live, -1])
        live, node = live[going], node[going]
        open_[live, node] = -np.inf
        order = np.argsort(node, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(node[order])) + 1) if len(order) else []:
            n, rows = int(node[at[0]]), live[at]
            if tree.children[n]:
                inner = list(tree.children[n])
                open_[np.ix_(rows, inner)] = tree.bounds(q.part(rows), inner)
            else:
                _take(tree, n, q, rows, ids, best)


def _take(tree: Tree, leaf: int, q: Queries, rows: np.ndarray, ids: np.ndarray, best: np.ndarray) -> None:
    """Score a leaf for the queries ``rows`` and keep the first k of old and new ones."""
    own, labels, x = tree.leaves[leaf]
    vectors, of = np.unique(q.vectors[rows], axis=0, return_inverse=True) if len(rows) > 1 else (q.vectors[rows], np.zeros(1, int))
    scores = _scores(vectors, x, tree.largest)[of.ravel()]
    fits = ((labels == q.labels[rows, None]) == q.same) & (own != q.ids[rows, None]) & (scores >= q.low[rows, None]) & (scores <= q.high[rows, None])
    scores = np.where(fits, scores, NONE)
    floor = best[rows, -1]
    if len(own) > q.k:
        floor = np.maximum(floor, np.partition(scores, len(own) - q.k, axis=1)[:, -q.k])
    which, place = np.nonzero((scores >= floor[:, None]) & (scores > NONE))
    if not len(which):
        return
    touched, which = np.unique(which, return_inverse=True)
    at = rows[touched]
    query = np.concatenate([np.repeat(np.arange(len(at)), q.k), which])
    score = np.concatenate([best[at].ravel(), scores[touched[which], place]])
    key = np.concatenate([ids[at].ravel(), own[place]])
    order = np.lexsort((key, ~score, query))  # ~ turns the order of scores around, of the least one, too
    starts = np.searchsorted(query[order], np.arange(len(at)))
    first = order[(starts[:, None] + np.arange(q.k)).ravel()]
    ids[at], best[at] = key[first].reshape(-1, q.k), score[first].reshape(-1, q.k)


def find(index: Index, q: Queries) -> DataFrame:
    """``(query, id, score)``: each query's best rows of every task; queries by their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, best = np.zeros((len(q.ids), q.k), np.int64), np.full((len(q.ids), q.k), NONE)
        rows = (row for batch in batches for row in slices(iter([batch]), 1))
        while some := list(islice(rows, TREE_LEAVES)):
            parts = [tuple(row.column(c).flatten().to_numpy() for c in ("ids", "labels", "vectors")) for row in some]
            tree = Tree([(i, l, x.reshape(len(i), index_size)) for i, l, x in parts])
            for start in range(0, len(q.ids), TOGETHER):
                at = slice(start, start + TOGETHER)
                search(tree, q.part(at), ids[at], best[at])
        there = best > NONE
        query = np.repeat(np.arange(len(ids), dtype=np.int32), there.sum(axis=1))
        yield pa.record_batch([pa.array(query), pa.array(ids[there]), pa.array(best[there])], ["query", "id", "score"])

    index_size = index.size
    return arrow_map(index.leaves.select("ids", "labels", "vectors"), run, _FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def windows(positive: int, least: int, most: int) -> tuple[int, int]:
    """Scores from ``least`` to ``most`` percent of the positive's, as whole numbers."""
    return -(-least * positive // 100), most * positive // 100


def mine(
    vectors: DataFrame, divisor: int = 100, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    anchors: int = ANCHORS, shard_rows: int = SHARD_ROWS, leaf: int = LEAF,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of rows whose id the divisor divides."""
    spark: SparkSession = vectors.sparkSession
    index = build_index(usable(vectors), divisor, shard_rows, leaf)
    blocks = max(1, -(-index.anchors.count() // anchors))
    paths = {kind: scratch_dir(spark, kind) for kind in ("positives", "negatives")}
    kinds = {"positives": "anchor_id bigint, positive_id bigint, positive_score bigint", "negatives": "anchor_id bigint, positive_score bigint, rank int, negative_id bigint, negative_score bigint"}

    wrote: set[str] = set()

    def write(found: DataFrame, asked: list[tuple], names: str, kind: str) -> None:
        """Found rows with the queries that asked for them; these are bounded by the block."""
        known = spark.createDataFrame([(n, *a) for n, a in enumerate(asked)], f"query int, {names}")
        found.join(F.broadcast(known), "query").select(*[f.split()[0] for f in kinds[kind].split(", ")]).write.mode("append").parquet(paths[kind])
        wrote.add(kind)
        release(spark)

    for nth in range(blocks):
        # A hash deals anchors to blocks of about equal size.
        own = index.anchors.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == nth).collect()
        if not own:
            continue
        ids, labels = (np.array([r[c] for r in own], np.int64) for c in ("id", "label"))
        x = np.array([r["v"] for r in own], np.int64).reshape(len(own), index.size)
        every = np.full(len(own), -MOST), np.full(len(own), MOST)
        top = stored(_first(find(index, Queries(ids, labels, x, *every, True, positives)), positives), "top")
        renamed = top.select("query", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        write(renamed, [(int(i),) for i in ids], "anchor_id bigint", "positives")
        # Positives of one score share a window.
        asked = sorted({(r["query"], r["score"]) for r in top.select("query", "score").where("score >= 0").collect()})
        if not asked:
            continue
        at = np.array([a for a, _ in asked])
        low, high = (np.array(e, np.int64) for e in zip(*(windows(p, least, most) for _, p in asked)))
        hard = _first(find(index, Queries(ids[at], labels[at], x[at], low, high, False, negatives)), negatives)
        renamed = hard.select("query", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        write(renamed, [(int(ids[a]), p) for a, p in asked], "anchor_id bigint, positive_score bigint", "negatives")

    found, hard = (spark.read.schema(kinds[k]).parquet(paths[k]) if k in wrote else spark.createDataFrame([], kinds[k]) for k in kinds)
    return found.join(hard, ["anchor_id", "positive_score"]).select(*RESULT)
