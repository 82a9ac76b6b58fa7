"""Hard-negative mining by best-first search in STR-packed R-trees.

Each component x of a vector becomes floor(256 * x); scores are integer inner
products.  An anchor's positives are the ``top`` other rows of its label that
score highest; the hard negatives of an anchor and a positive are the ``top``
rows of other labels that score highest among those from 80 % of the
positive's score up to it.  Ties go to the smaller id.

Index.  Rows are sorted by label and first component and cut into strips (a
range partition, the first step of sort-tile-recursive packing); within a strip
the rows of each label are sorted and cut again by one component after the other, the most
spread out first, until ``LEAF`` rows fill a leaf.  ``FAN`` neighbouring nodes make a
node of the next level.  Every node has a minimum bounding box; a box and an
anchor give an interval for the inner product, coordinate by coordinate.

Search.  A queue hands out the nodes of a strip's trees, that with the highest
possible score first.  A node is left out if its interval lies outside all
score windows that are still open, or strictly below what the ``top``-th found so far scores;
equals are searched, since a smaller id may be among them.  Every row is
indexed and the search is exact.

Scale.  The queries are a stated set (anchors, 1 % of the rows); blocks of them
meet strips, first only strips that hold their label, then all.  A task holds the trees of
one strip and streams blocks by; what it sends on is at most ``top`` rows per query and window.  A
label or a vector that a third of all rows share is cut into strips like any
other, since the row number breaks ties.  On vectors without structure boxes of
many dimensions overlap, hardly a node is left out and the work is that of
comparing all anchors with all rows.

Defined cases: rows with a NULL label, a NULL vector or a NULL or non-finite component take no part;
missing components of shorter vectors are zero; components beyond +-2^20
count as that (scores stay exact); rows without an id take part, come last among ties
and are no anchors; rows with one id are rows of their own; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import io
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.session import shared_dir

SCALE, LARGEST = 256, 1 << 20
TOP, LEAST_PERCENT = 5, 80
LEAF, FAN, STRIP, BLOCK = 128, 8, 4096, 256
_NO_ID = np.iinfo(np.int64).max


# --------------------------------------------------------------------- R-tree

def str_order(x: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Row numbers of each leaf: sort by a component, cut into slabs, go on in each slab with the next."""
    dims = np.argsort(-(x.max(axis=0) - x.min(axis=0)), kind="stable") if len(x) and x.shape[1] else np.empty(0, int)

    def tile(rows: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1:
            yield rows
            return
        left = len(dims) - depth
        slabs = pages if left <= 1 else int(np.ceil(round(pages ** (1 / left), 9)))
        size = leaf * -(-pages // slabs)
        if left:
            rows = rows[np.argsort(x[rows, dims[depth]], kind="stable")]
        for a in range(0, len(rows), size):
            part = rows[a:a + size]
            yield from tile(part, depth + 1) if left > 1 else [part[b:b + leaf] for b in range(0, len(part), leaf)]

    return list(tile(np.arange(len(x)), 0)) if len(x) else []


class Tree:
    """Packed R-tree over rows of one label.  Nodes are numbered level by level from the leaves, the root is last."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.label = int(arrays["label"][0])
        self.rows, self.ids = arrays["rows"], arrays["ids"]
        self.x = arrays["x"].astype(np.float64)
        self.lo, self.hi = arrays["lo"].astype(np.float64), arrays["hi"].astype(np.float64)
        self.first, self.last, self.leaves = arrays["first"].tolist(), arrays["last"].tolist(), int(arrays["leaves"][0])

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible score of each query (row) in each node (column)."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.lo.T + down @ self.hi.T, up @ self.hi.T + down @ self.lo.T


def pack(label: int, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> bytes:
    """A tree as bytes; ``rows`` are row numbers, x the integer vectors (n x d)."""
    tiles = str_order(x, leaf)
    order = np.concatenate(tiles)
    sizes = np.array([len(t) for t in tiles])
    x = x[order]
    starts = np.cumsum(sizes) - sizes
    lo, hi = [np.minimum.reduceat(x, starts)], [np.maximum.reduceat(x, starts)]
    first, last, level = [starts], [starts + sizes], np.arange(len(tiles))
    while len(level) > 1:
        heads = np.arange(0, len(level), fan)
        lo.append(np.minimum.reduceat(lo[-1], heads))
        hi.append(np.maximum.reduceat(hi[-1], heads))
        first.append(level[heads])
        last.append(level[np.minimum(heads + fan, len(level)) - 1] + 1)
        level = level[-1] + 1 + np.arange(len(heads))
    return _save(label=np.array([label]), rows=rows[order], ids=ids[order], x=x.astype(np.int32),
                 lo=np.concatenate(lo).astype(np.int32), hi=np.concatenate(hi).astype(np.int32),
                 first=np.concatenate(first), last=np.concatenate(last), leaves=np.array([len(tiles)]))


def _save(**arrays: np.ndarray) -> bytes:
    sink = io.BytesIO()
    np.savez(sink, **arrays)
    return sink.getvalue()


def _load(data: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(data)))


class _Best:
    """The ``top`` rows with the highest scores from ``least`` up to ``most``, ties by id, then by row number."""

    def __init__(self, least: float, most: float, top: int):
        self.least, self.most, self.top = least, most, top
        self.found: list[tuple] = []

    def kth(self) -> float:
        """What a row must score to get in, at least as an equal."""
        return -self.found[-1][0] if len(self.found) == self.top else self.least

    def offer(self, score: float, at: int, tree: Tree) -> None:
        if self.kth() <= score <= self.most:
            insort(self.found, (-score, int(tree.ids[at]), int(tree.rows[at])))
            del self.found[self.top:]


def search(trees: list[tuple[Tree, list[float], list[float]]], query: np.ndarray, windows: list[_Best],
           skip_row: int = -1) -> None:
    """Fill ``windows`` from ``trees`` (with the query's bounds in each node), best node first."""
    heap = [(-high[-1], t, len(high) - 1) for t, (_, _, high) in enumerate(trees)]
    heapq.heapify(heap)
    while heap:
        high, t, node = heapq.heappop(heap)
        high = -high
        if high < min(w.kth() for w in windows):
            break       # no node that is left can score more
        tree, lows, highs = trees[t]
        low = lows[node]
        if not any(low <= w.most and high >= w.kth() for w in windows):
            continue
        a, b = tree.first[node], tree.last[node]
        if node >= tree.leaves:
            for child in range(a, b):
                heapq.heappush(heap, (-highs[child], t, child))
            continue
        scores = tree.x[a:b] @ query
        wanted = np.flatnonzero((scores >= min(w.kth() for w in windows)) & (scores <= max(w.most for w in windows)))
        if len(wanted) > windows[0].top:    # highest first: later ones mostly fall below the k-th
            wanted = wanted[np.argsort(-scores[wanted], kind="stable")]
        for k in wanted.tolist():
            if tree.rows[a + k] != skip_row:
                for w in windows:
                    w.offer(float(scores[k]), a + k, tree)


# ----------------------------------------------------------------- Spark jobs

def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of one matrix; missing components are zero."""
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _runs(labels: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _build(width: int):
    """Trees of one strip: at most STRIP rows of one label in each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, held = TaskContext.get().partitionId(), []

        def trees(batch: pa.RecordBatch) -> Iterator[tuple]:
            labels, x = batch.column(2).to_numpy(), _matrix(batch.column(3), width)
            rows, ids = batch.column(0).to_numpy(), _ids(batch.column(1))
            for a, b in _runs(labels):
                yield strip, int(labels[a]), pack(int(labels[a]), rows[a:b], ids[a:b], x[a:b])

        for batch in batches:
            for a in range(0, batch.num_rows, STRIP):
                held = list(zip(*trees(batch.slice(a, STRIP))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held[0], pa.int32()), pa.array(held[1], pa.int64()), pa.array(held[2], pa.binary())],
                    names=["strip", "label", "data"])
    return run


def _block(width: int, by_label: bool):
    """Blocks of queries; (row, label, v, windows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy()
            x, scores = _matrix(batch.column(2), width), batch.column(3)
            counts, flat = scores.value_lengths().to_numpy(), scores.flatten().to_numpy()
            out = [(int(labels[a]), _save(rows=batch.column(0).to_numpy()[a:b], labels=labels[a:b], x=x[a:b],
                                          counts=counts[a:b], scores=flat[counts[:a].sum():counts[:b].sum()]))
                   for u, v in (_runs(labels) if by_label else [(0, len(labels))])
                   for a in range(u, v, BLOCK) for b in [min(a + BLOCK, v)]]
            if out:
                labels, data = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int64()), pa.array(data, pa.binary())],
                                                 names=["label", "data"])
    return run


def _search(positives: bool, top: int, percent: int):
    """Streams (strip, kind, data): the trees of a strip (kind 0), then the blocks of queries (kind 1) that meet it."""
    def answers(trees: list[Tree], block: dict[str, np.ndarray]) -> Iterator[tuple]:
        queries = block["x"].astype(np.float64)
        bounds = [tree.bounds(queries) for tree in trees]
        ends = np.cumsum(block["counts"])
        for q, (row, label, end, count) in enumerate(zip(
                block["rows"].tolist(), block["labels"].tolist(), ends.tolist(), block["counts"].tolist())):
            if positives:
                windows = [_Best(-np.inf, np.inf, top)]
            else:
                windows = [_Best(-(-percent * p // 100), p, top) for p in block["scores"][end - count:end].tolist()]
            mine = [(tree, low[q].tolist(), high[q].tolist()) for tree, (low, high) in zip(trees, bounds)
                    if (tree.label == label) == positives]
            if windows and mine:
                search(mine, queries[q], windows, row if positives else -1)
                for w in windows:
                    for score, found_id, found_row in w.found:
                        yield (row, None if positives else int(w.most), int(-score),
                               None if found_id == _NO_ID else found_id, found_row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, trees = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                now, kind = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                if now != strip:
                    strip, trees = now, []
                data = _load(batch.column(2)[k].as_py())
                if kind == 0:
                    trees.append(Tree(data))
                elif out := list(answers(trees, data)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                     names=["row", "positive_score", "score", "found_id", "found_row"])
    return run


def _answers(trees: DataFrame, blocks: DataFrame, strips: int, positives: bool, top: int, percent: int) -> DataFrame:
    """The ``top`` answers of each query and window over all strips that its blocks are dealt to."""
    met = (trees.select("strip", F.lit(0).alias("kind"), "data")
           .unionByName(blocks.select("strip", F.lit(1).alias("kind"), "data")))
    found = (met.repartition(strips, "strip").sortWithinPartitions("strip", "kind")
             .mapInArrow(_search(positives, top, percent),
                         "row long, positive_score long, score long, found_id long, found_row long"))
    order = Window.partitionBy("row", "positive_score").orderBy(
        F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mine(spark: SparkSession, rows: DataFrame, anchors, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", top: int = TOP, percent: int = LEAST_PERCENT) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; ``anchors`` is a condition on ``id``."""
    folder = shared_dir(spark, "negatives")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.greatest(F.lit(-LARGEST), F.least(
        F.lit(LARGEST), F.floor(x * SCALE))).cast("int"))
    (rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                 F.col(vector_col).cast("array<double>").alias("v"))
     .where(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
     .select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("v"))
     .write.parquet(f"{folder}/points"))
    points = spark.read.parquet(f"{folder}/points")
    n, width = points.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    strips = max(1, -(-n // STRIP))
    first = F.coalesce(F.get("v", F.lit(0)), F.lit(0))
    (points.withColumn("c", first).repartitionByRange(strips, "label", "c", "row")
     .sortWithinPartitions("label", "c", "row").select("row", "id", "label", "v")
     .mapInArrow(_build(width), "strip int, label long, data binary").write.parquet(f"{folder}/trees"))
    trees = spark.read.parquet(f"{folder}/trees")
    strips = (trees.agg(F.max("strip")).first()[0] or 0) + 1

    asked = points.where(anchors)
    none = F.array().cast("array<long>").alias("scores")
    (asked.select("row", "label", "v", none).repartitionByRange("label", "row").sortWithinPartitions("label", "row")
     .mapInArrow(_block(width, True), "label long, data binary").write.parquet(f"{folder}/anchors"))
    blocks = spark.read.parquet(f"{folder}/anchors").join(trees.select("strip", "label").distinct(), "label")
    (_answers(trees, blocks, strips, True, top, percent)
     .select("row", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"), "found_row")
     .write.parquet(f"{folder}/positives"))
    positives = spark.read.parquet(f"{folder}/positives")

    # a negative positive score has an empty window
    scores = (positives.where("positive_score >= 0").groupBy("row")
              .agg(F.sort_array(F.collect_set("positive_score")).alias("scores")))
    (asked.join(scores, "row").select("row", "label", "v", "scores")
     .mapInArrow(_block(width, False), "label long, data binary").write.parquet(f"{folder}/windows"))
    blocks = spark.read.parquet(f"{folder}/windows").withColumn(
        "strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    negatives = _answers(trees, blocks, strips, False, top, percent).select(
        "row", "positive_score", "rank", F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (negatives.join(positives, ["row", "positive_score"])
            .join(asked.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
