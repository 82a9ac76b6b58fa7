"""SimHash near-duplicates by a binary trie self-join.

Fingerprint.  A-Z are lower-cased, words are runs of anything but white space
(0x20, 0x09-0x0D), shingles are ``shingle`` consecutive words, repeats
included (fewer words: the whole sequence).  Bit b of the fingerprint is 1 if
it is set in over half of the shingles' XXH64 values (UTF-8, seed 42).  A text
without words (NULL, empty, white space) has fingerprint 0.

Join.  Distinct fingerprints within ``max_bits`` differing bits are linked.
Fingerprints are cut into max_bits + 1 blocks and what is left of them once
more: two that differ in at most ``max_bits`` bits agree on one outer block
and, in the rest, on one inner block, so each pair meets under one of
(max_bits + 1)^2 keys.  The fingerprints under a key form a binary trie,
held as a sorted array.  Node pairs are traversed together from (root, root),
differing bits add up, and a pair beyond the budget is dropped.  Keys fix 28
of 64 bits at three differing bits, so work is dealt out in small groups that
do not grow with groups of exact copies: copies share one fingerprint and
enter once.  A key of more than ``GROUP_ROWS`` fingerprints (documents that
share long boilerplate) is dealt out again under max_bits + 1 keys that fix
9 more bits, and those once more, by the same argument; 44 fixed bits leave
2^20 fingerprints at most.

A task sends on the edges of a spanning forest of what it linked, never all
pairs; ``components.connected_components`` joins the forests.

Defined cases: NULL, empty and blank texts have fingerprint 0 and are linked
like any other; repeated rows (same doc_id) each get a row; a row with NULL
doc_id takes part through the other rows with its fingerprint and its
component_id is NULL where there are none; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common
from hitlens.llm.components import connected_components
from hitlens.session import shared_dir

SHINGLE = 3
MAX_BITS = 3
BITS = 64
#: Shingles whose bits are counted at once, and node pairs that are held at once.
VOTE_BLOCK, PAIR_BLOCK = 1 << 16, 1 << 18
#: A key of more fingerprints is split by further bits, up to LEVELS blocks.
GROUP_ROWS, LEVELS = 500_000, 4
#: A node pair of at most so many fingerprint pairs is compared directly.
LEAF_PAIRS = 64


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text (UTF-8)."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - span + 1
    votes = np.zeros(BITS, np.int64)
    for at in range(0, n, VOTE_BLOCK):
        a, b = starts[at:min(at + VOTE_BLOCK, n)].tolist(), ends[span - 1:][at:at + VOTE_BLOCK].tolist()
        values = np.fromiter((digest(joined[i:j], 42) for i, j in zip(a, b)), np.uint64, len(a))
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    on = np.flatnonzero(votes * 2 > n)
    return int(sum(1 << int(b) for b in on))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id_col, fp): one row per input row; fp is the fingerprint's 64 bits as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, texts in common.text_chunks(batch.column(1)):
                values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(values.view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fp long")


# ------------------------------------------------------------------- trie join

def _blocks(bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``parts`` nearly equal blocks."""
    cuts = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _field(x: np.ndarray, at: int, width: int) -> np.ndarray:
    return (x >> np.uint64(at)) & np.uint64((1 << width) - 1)


def _without(x: np.ndarray, at: int, width: int) -> np.ndarray:
    low = x & np.uint64((1 << at) - 1)
    high = x >> np.uint64(at + width) if at + width < BITS else np.zeros_like(x)
    return low | (high << np.uint64(at))


def join_keys(fps: np.ndarray, max_bits: int, levels: int = 2) -> np.ndarray:
    """(max_bits + 1)^levels keys per fingerprint: the blocks chosen level by level, then their values.

    Column c of one level comes from column c // (max_bits + 1) of the level before.
    """
    parts = max_bits + 1
    tables = [(0, np.zeros(len(fps), np.uint64), fps, 0)]  # choice, fixed bits, the rest, number of fixed bits
    for _ in range(levels):
        tables = [(choice * parts + i, (value << np.uint64(width)) | _field(rest, at, width),
                   _without(rest, at, width), fixed + width)
                  for choice, value, rest, fixed in tables
                  for i, (at, width) in enumerate(_blocks(BITS - fixed, parts))]
    return np.stack([(np.uint64(choice) << np.uint64(fixed)) | value for choice, value, _, fixed in tables], axis=1)


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int) -> np.ndarray:
    """Where the 1 branch of each node [lo, hi) at ``depth`` begins: a binary search on that bit."""
    bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
    a, b = lo.copy(), hi.copy()
    while True:
        open_ = a < b
        if not open_.any():
            return a
        mid = (a + b) >> 1
        one = (values[np.minimum(mid, len(values) - 1)] & bit) != 0
        b = np.where(open_ & one, mid, b)
        a = np.where(open_ & ~one, mid + 1, a)


def _expand(alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) of [alo, ahi) x [blo, bhi) for every node pair."""
    na, nb = ahi - alo, bhi - blo
    count = na * nb
    which = np.repeat(np.arange(len(count)), count)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return alo[which] + k // nb[which], blo[which] + k % nb[which]


def trie_pairs(values: np.ndarray, groups: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of one group whose values differ in at most ``max_bits`` bits.

    ``values`` (distinct within a group) are sorted within ``groups``, which is
    sorted.  A trie node is a range of rows with a common prefix; the stack holds
    blocks of node pairs of one depth, so memory stays bounded.
    """
    if not len(values):
        return
    first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
    last = np.append(first[1:], len(values))
    roots = last - first > 1
    lo, hi = first[roots], last[roots]
    stack = [(0, lo[i:i + PAIR_BLOCK], hi[i:i + PAIR_BLOCK], lo[i:i + PAIR_BLOCK], hi[i:i + PAIR_BLOCK],
              np.zeros(len(lo[i:i + PAIR_BLOCK]), np.int8)) for i in range(0, len(lo), PAIR_BLOCK)]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        small = ((ahi - alo) * (bhi - blo) <= LEAF_PAIRS) | (depth >= BITS)
        if small.any():
            s = [x[small] for x in (alo, ahi, blo, bhi)]
            i, j = _expand(*s)
            i, j = i[i < j], j[i < j]
            near = np.bitwise_count(values[i] ^ values[j]) <= max_bits
            yield i[near], j[near]
            alo, ahi, blo, bhi, diff = (x[~small] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        amid, bmid = _split(values, alo, ahi, depth), _split(values, blo, bhi, depth)
        same = alo == blo  # a node with itself: the crossed pair is needed once
        parts = [(alo, amid, blo, bmid, diff), (amid, ahi, bmid, bhi, diff), (alo, amid, bmid, bhi, diff + 1)]
        parts.append(tuple(x[~same] for x in (amid, ahi, blo, bmid, diff + 1)))
        merged = [np.concatenate(x) for x in zip(*parts)]
        live = (merged[0] < merged[1]) & (merged[2] < merged[3]) & (merged[4] <= max_bits)
        live &= ~((merged[0] == merged[2]) & (merged[1] - merged[0] == 1))  # a leaf with itself
        merged = [x[live] for x in merged]
        for at in range(0, len(merged[0]), PAIR_BLOCK):
            stack.append((depth + 1, *(x[at:at + PAIR_BLOCK] for x in merged)))


def local_roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index reachable from each of n indices, block of links by block."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    return root


def _emit_keys(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = (max_bits + 1) ** 2
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            keys = join_keys(fps.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(fps, tables)),
                 batch.column(1).take(pa.array(np.repeat(np.arange(len(fps)), tables)))],
                names=["key", "fp", "node"])
    return run


def _split_keys(max_bits: int, level: int):
    """Rows under a key of ``level`` blocks -> rows under its keys of one block more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = max_bits + 1
        most = max(1_000_000 // parts ** (level + 1), 1)
        for whole in batches:
            for at in range(0, len(whole), most):
                batch = whole.slice(at, most)
                key, fps = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in (0, 1))
                table = (join_keys(fps, max_bits, level) == key[:, None]).argmax(axis=1)
                finer = join_keys(fps, max_bits, level + 1).reshape(len(fps), -1, parts)[np.arange(len(fps)), table]
                again = pa.array(np.repeat(np.arange(len(fps)), parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(finer.reshape(-1).view(np.int64)), batch.column(1).take(again), batch.column(2).take(again)],
                    names=["key", "fp", "node"])
    return run


def keyed_groups(spark: SparkSession, nodes: DataFrame, max_bits: int, path: str) -> list[DataFrame]:
    """``nodes`` (fp, node) as rows (key, fp, node), level by level; a pair within ``max_bits`` shares a key of one."""
    kind = nodes.schema["node"].dataType.simpleString()
    schema = f"key long, fp long, node {kind}"
    rows = nodes.select("fp", "node").mapInArrow(_emit_keys(max_bits), schema)
    out = []
    for level in range(2, LEVELS):
        place = f"{path}/large-{level}"
        rows.groupBy("key").count().where(F.col("count") > GROUP_ROWS).select("key").write.parquet(place)
        large = spark.read.parquet(place)  # Spark broadcasts it while its files are small
        if not large.limit(1).count():
            break
        out.append(rows.join(large, "key", "left_anti").select("key", "fp", "node"))
        rows = (rows.join(large, "key", "left_semi").select("key", "fp", "node")
                .mapInArrow(_split_keys(max_bits, level), schema))
    return [*out, rows]


def _link(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partition is sorted by key: whole groups are cut off and joined, the open one is kept."""
        held: list[pa.RecordBatch] = []
        rows = 0

        def join(table: pa.Table) -> pa.RecordBatch:
            key, fp = (table.column(c).to_numpy() for c in ("key", "fp"))
            fp = fp.view(np.uint64)
            order = np.lexsort((fp, key))
            root = order[local_roots(len(order), trie_pairs(fp[order], key[order], max_bits))]
            moved = order != root
            node = table.column("node").combine_chunks()
            return pa.RecordBatch.from_arrays(
                [node.take(pa.array(order[moved])), node.take(pa.array(root[moved]))], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= 500_000:
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1]))
                if cut:
                    yield join(table.slice(0, cut))
                    held = table.slice(cut).combine_chunks().to_batches()
                    rows = sum(map(len, held))
        if rows:
            yield join(pa.Table.from_batches(held))
    return run


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id_col, fp, component_id) per input row; component_id is the smallest id reachable over links."""
    path = shared_dir(spark, "simhash")
    fingerprints(docs, id_col, text_col, shingle).write.parquet(f"{path}/fp")
    fps = spark.read.parquet(f"{path}/fp")
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("node"))
    kind = docs.schema[id_col].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = reduce(DataFrame.unionAll, [
        keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_link(max_bits), f"u {kind}, v {kind}")
        for keyed in keyed_groups(spark, nodes.where(F.col("node").isNotNull()), max_bits, path)])
    groups = connected_components(spark, links)
    named = (nodes.join(groups, "node", "left")
             .select("fp", F.coalesce("component", "node").alias("component_id")))
    return fps.join(named, "fp", "left").select(id_col, "fp", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of linked documents: that of the smallest id.

    Of repeated rows one stays.  A row without an id goes if a document with an id has its fingerprint;
    of those left, one stays for each fingerprint.
    """
    links = near_duplicates(spark, docs.select(id_col, text_col), id_col, text_col, shingle, max_bits)
    rows, row, key = common.fresh([*docs.columns, "fp", "component_id"], "rows", "row", "key")
    first = links.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.count("*").alias(rows))
    nameless = links.where(F.col(id_col).isNull())
    # the ids are hashed and the texts stream past them: a merge join would sort whole texts in memory
    kept = docs.join(first.select(id_col).hint("shuffle_hash"), id_col, "left_semi").select(*docs.columns)
    if first.where(F.col(rows) > 1).limit(1).count():
        kept = kept.dropDuplicates([id_col])
    if nameless.limit(1).count():
        alone = docs.where(F.col(id_col).isNull()).withColumn(row, F.struct(*docs.columns)).withColumn(key, F.to_json(row))
        prints = fingerprints(alone.select(key, text_col), key, text_col, shingle)
        lone = nameless.where("component_id IS NULL").select("fp").distinct()
        one = prints.join(lone, "fp", "left_semi").groupBy("fp").agg(F.min(key).alias(key))
        rest = alone.join(one, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
        kept = kept.unionByName(rest)
    return kept
