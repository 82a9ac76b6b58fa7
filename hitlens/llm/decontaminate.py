"""Benchmark decontamination with one FM-index per training shard.

Words are the runs of 0-9, a-z and everything above 0x7F of the text with A-Z
lower-cased.  A test phrase is a window of ``window`` consecutive words of a
benchmark item; an item with fewer words, but not none, is one phrase.

Spark cuts the benchmark into distinct (phrase, item) pairs, a table in the
shared folder in blocks of about ``PHRASE_BLOCK`` pairs and ``PHRASE_BYTES`` of
text.  Blocks pass through the driver one by one and are broadcast one by one;
a worker reads a block, searches it and drops it before the next, so nobody
holds more than one block and its vocabulary in memory.  (Where there is one
block only, a worker keeps it.)

A task reads its documents shard by shard (about ``SHARD_BYTES`` of text; a
longer document is a shard of its own).  For each block a shard is turned into
word numbers over the block's vocabulary; a word that no phrase has ends a run,
and runs shorter than the shortest phrase hold no occurrence and are left out
of the index.  Backward search through wavelet-tree ranks gives the row range
of every phrase, sampled suffix positions give the places, and the places of
all blocks are merged to spans of words.  Everything about a document happens
in one task, no document is shuffled.

Defined cases: NULL, empty and wordless texts have 0 words and no hits; NULL
or wordless items have no phrase; an item_id that stands in several rows is
one item; NULL item_ids are the item "" ; repeated documents get a row each;
other columns are ignored (report) or passed through (remove).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common
from hitlens.llm.fmindex import FMIndex
from hitlens.session import remove_dir, shared_dir

WINDOW = 10
SHARD_BYTES = 8_000_000
PHRASE_BLOCK, PHRASE_BYTES = 200_000, 32_000_000
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(common.LETTERS_DIGITS).split() if text else []


# -------------------------------------------------------------------- phrases

class PhraseBlock:
    """Phrases as rows of word numbers, the items (numbers) that have each, and the block's own numbering."""

    def __init__(self, phrases: list[bytes], items: list[str], window: int):
        self.vocabulary: dict[bytes, int] = {}
        names: dict[str, int] = {}
        holders: dict[tuple[int, ...], set[int]] = {}
        for phrase, name in zip(phrases, items):
            numbers = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in phrase.split())
            holders.setdefault(numbers, set()).add(names.setdefault(name, len(names)))
        self.names = list(names)
        self.lengths = np.fromiter(map(len, holders), np.int64, len(holders))
        self.shortest = int(self.lengths.min())
        self.rows = np.zeros((len(holders), window), np.int64)
        for k, p in enumerate(holders):
            self.rows[k, :len(p)] = p
        self.item_counts = np.fromiter(map(len, holders.values()), np.int64, len(holders))
        self.items = np.fromiter((i for s in holders.values() for i in sorted(s)), np.int64)
        self.item_starts = np.cumsum(self.item_counts) - self.item_counts


def _phrases(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0), common.text_bytes(batch.column(1))):
                words = words_of(text)
                size = min(window, len(words))
                last = len(words) - size + 1 if words else 0
                for a in range(0, last, 20_000):
                    found = [b" ".join(words[i:i + size]) for i in range(a, min(a + 20_000, last))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.binary()), pa.array([name.as_py()] * len(found), pa.string())],
                        names=["phrase", "item"])
    return run


class Phrases:
    """The benchmark's phrase blocks, as broadcasts."""

    def __init__(self, spark: SparkSession, benchmark: DataFrame, window: int, id_col: str, text_col: str):
        self.blocks = []
        items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                                 F.col(text_col).alias("text"))
        folder = shared_dir(spark, "phrases")
        try:
            pairs = items.mapInArrow(_phrases(window), "phrase binary, item string").distinct()
            pairs.write.parquet(f"{folder}/pairs")
            pairs = spark.read.parquet(f"{folder}/pairs")
            size = pairs.agg(F.count("*").alias("rows"),
                             F.sum(F.length("phrase") + F.length("item")).alias("bytes")).first()
            count = max(-(-size.rows // PHRASE_BLOCK), -(-(size["bytes"] or 0) // PHRASE_BYTES))
            if count > 1:
                block = F.pmod(F.xxhash64("phrase", "item"), F.lit(count))
                (pairs.withColumn("block", block).repartition("block").write.partitionBy("block")
                 .parquet(f"{folder}/blocks"))
                pairs = spark.read.parquet(f"{folder}/blocks")
            for k in range(count):
                table = (pairs.where(F.col("block") == k) if count > 1 else pairs).select("phrase", "item").toArrow()
                if len(table):
                    self.blocks.append(spark.sparkContext.broadcast(PhraseBlock(
                        table.column("phrase").to_pylist(), table.column("item").to_pylist(), window)))
        finally:
            remove_dir(spark, folder)

    def __iter__(self) -> Iterator[PhraseBlock]:
        for sent in self.blocks:
            yield sent.value
            if len(self.blocks) > 1 and sent._path is not None:
                sent.__dict__.pop("_value", None)  # the worker's copy; read again from Spark's file when asked


# --------------------------------------------------------------------- shards

class _Numbers(dict):
    """word -> number in order of first use, from 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def scan_shard(texts: list[bytes | None], phrases: Phrases):
    """(words per document, covered word flags, document starts, names of the items found in each document)."""
    own = _Numbers()
    counts, parts = [], []
    end = np.full(1, own[b""], np.int32)  # no word is empty: no occurrence reaches into the next document
    for t in texts:
        words = words_of(t)
        counts.append(len(words))
        parts += np.fromiter(map(own.__getitem__, words), np.int32, len(words)), end
    counts = np.array(counts, np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    local = np.concatenate(parts)
    del parts
    step = np.zeros(len(local) + 1, np.int32)
    items: dict[int, set[str]] = {}
    for block in phrases:
        _search(block, np.fromiter((block.vocabulary.get(w, 0) for w in own), np.int32, len(own))[local],
                starts, step, items)
    return counts, np.cumsum(step[:-1]) > 0, starts, items


def _search(block: PhraseBlock, ids: np.ndarray, starts: np.ndarray, step: np.ndarray,
            items: dict[int, set[str]]) -> None:
    """Add one block's occurrences in a shard to ``step`` (begin +1, end -1) and ``items``."""
    text, place = _runs(ids, block.shortest)
    if not len(text):
        return
    index = FMIndex(text, len(block.vocabulary))
    lo, hi = index.search(block.rows, block.lengths)
    found = np.flatnonzero(hi > lo)
    times = (hi - lo)[found]
    rows = np.repeat(lo[found], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    phrase = np.repeat(found, times)
    at = place[index.locate(rows)]
    np.add.at(step, at, 1)
    np.add.at(step, at + block.lengths[phrase], -1)
    doc = np.searchsorted(starts, at, "right") - 1
    hit = np.unique(np.stack((doc, phrase), axis=1), axis=0)
    n = block.item_counts[hit[:, 1]]
    which = np.repeat(block.item_starts[hit[:, 1]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    pairs = np.unique(np.stack((np.repeat(hit[:, 0], n), block.items[which]), axis=1), axis=0)
    for d, item in pairs.tolist():
        items.setdefault(d, set()).add(block.names[item])


def _runs(ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of at least ``shortest`` known words, each followed by a 0, and every symbol's place in ``ids``."""
    known = ids > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    keep = end - begin >= shortest
    size = end[keep] - begin[keep] + 1  # with the 0 behind it
    place = np.repeat(begin[keep], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return ids[place].astype(np.int64), place


def _spans(covered: np.ndarray) -> np.ndarray:
    """(start, end) of each run of covered words."""
    return np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))).reshape(-1, 2)


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
           id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(id_col, n_words, n_hit, items, spans): items sorted as strings, spans as [start, end) word numbers."""
    phrases = Phrases(spark, benchmark, window, item_id, item_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.text_bytes(batch.column(1))
            for a, b in common.chunks(texts, SHARD_BYTES):
                counts, covered, starts, items = scan_shard(texts[a:b], phrases)
                spans: list[list[dict]] = [[] for _ in counts]
                hits = np.zeros(len(counts), np.int64)
                for doc in items:
                    own = covered[starts[doc]:starts[doc] + counts[doc]]
                    hits[doc] = own.sum()
                    spans[doc] = [{"start": s, "end": e} for s, e in _spans(own).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts), pa.array(hits),
                     pa.array([sorted(items.get(k, ())) for k in range(len(counts))], pa.list_(pa.string())),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=[id_col, "n_words", "n_hit", "items", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, n_hit long, items array<string>, "
             "spans array<struct<start: long, end: long>>")


def _cut(text: bytes, covered: np.ndarray) -> str:
    """The text without its covered words; what stood between two kept words becomes one space."""
    ends = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for s, e in _spans(covered).tolist():
        out.append(text[at:ends[s][0]].rstrip())
        at = ends[e - 1][1]
    out.append(text[at:].lstrip())
    return b" ".join(x for x in out if x).decode()


def remove(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
           text_col: str = "text", length_col: str | None = "n_chars", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """``docs`` with every covered word cut out of ``text_col`` and ``length_col`` (code points) set anew.

    Documents without a hit pass unchanged; one whose words are all covered goes.
    """
    phrases = Phrases(spark, benchmark, window, item_id, item_text)
    at = docs.columns.index(text_col)
    count = docs.columns.index(length_col) if length_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.text_bytes(batch.column(at))
            new: dict[int, str] = {}
            gone = np.zeros(len(texts), bool)
            for a, b in common.chunks(texts, SHARD_BYTES):
                counts, covered, starts, items = scan_shard(texts[a:b], phrases)
                for doc in items:
                    own = covered[starts[doc]:starts[doc] + counts[doc]]
                    gone[a + doc] = own.all()
                    new[a + doc] = _cut(texts[a + doc], own)
            if new:
                columns = list(batch.columns)
                values = columns[at].to_pylist()
                for k, t in new.items():
                    values[k] = t
                columns[at] = pa.array(values, columns[at].type)
                if count is not None:
                    sizes = columns[count].to_pylist()
                    for k, t in new.items():
                        sizes[k] = len(t)
                    columns[count] = pa.array(sizes, columns[count].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(~gone))
            yield batch

    return docs.mapInArrow(run, docs.schema)
