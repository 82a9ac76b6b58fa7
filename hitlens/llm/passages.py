"""Substring dedup with repeated-phrase automata.

Words are runs of anything but white space (0x20, 0x09-0x0D), unchanged.  A
window is ``WINDOW`` consecutive words of one document.  A word goes if a
window that covers it also starts earlier (smaller id, or same document and
earlier start), judged on the input.

1. Seeds.  Each window's seed is the least hash of its ``SEED``-word phrases,
   so equal windows have equal seeds.  Seed occurrences are counted over all
   documents; those that occur twice or more set bits of a filter of bounded
   size.  The filter only ever lets too much through.
2. Candidates.  Documents without a window whose seed is in the filter are
   done.  The others are written once, with the number of the shard (about
   ``SHARD_BYTES`` of input text) they belong to.
3. Passages are confirmed.  Windows with a candidate seed are grouped by a
   64-bit key, after each shard has folded its own equal ones to one row; keys
   that occur twice or more have a first occurrence.  Consecutive first
   occurrences form a passage, whose words come from the document itself.
   Each distinct recurring window lies in exactly one passage.
4. Automata.  A shard gets the passages that any of its windows belongs to
   and compiles their phrases (``PHRASE`` words at every ``STRIDE``-th word,
   so that every window holds a whole one) into an Aho-Corasick automaton over
   word numbers.  The shard's documents stream through it; each hit is
   compared word by word with the passage on both sides, which settles the
   windows around it exactly.

Skew: a passage that stands in a third of all documents is one row per shard
in every shuffle, and reaches each shard once.

Defined cases: NULL, empty and blank texts have no words; repeated rows (same
id and words) are one document, so equal starts in them do not remove each
other; rows with a NULL id count as later than all others; rows of one id, or
without one, whose words differ are documents of their own, in the order of the
words' hash; an empty table gives no rows; other columns are ignored.  Ids are
integers.

Only where such rows are found is the hash (``own``) carried along with the id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain, compress, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common
from hitlens.session import shared_dir

WINDOW, SEED, PHRASE = 20, 8, 10
STRIDE = WINDOW - PHRASE + 1
SHARD_BYTES = 4_000_000
#: The filter has 32 to 64 bits for each recurring seed, 2^28 (32 MB) at most, and sets ``PROBES`` of them.
LEAST_BITS, MOST_BITS, PROBES = 16, 28, 4
#: Stands for a NULL id: after every other.
NO_ID = (1 << 63) - 1
#: Shards named in one row.
SHARDS_A_ROW = 4096
#: Values of one symbol of a word.
DIGIT = 96

#: Words of more bytes (a multiple of 8) are hashed one by one.
LONG_WORD, HASH_SEED = 64, 20
#: Windows whose least seeds are found at once: with the last one's words under 2^24 places.
LEAST_BLOCK = 1 << 23
#: Distinct rows are found by one number a row if there are at most so many.
MOST_CODES = 1 << 62

_U64 = np.uint64
#: White space to blanks.
_BLANKS = bytes(32 if b in b" \t\n\v\f\r" else b for b in range(256))
#: The first 0 to 8 bytes of eight.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], _U64)


# ------------------------------------------------------------ words and seeds

class Shard:
    """Some texts, one after the other: their words, word hashes, and where windows may start."""

    def __init__(self, texts: list[bytes | None]):
        raw = b" ".join([*(t or b"" for t in texts), b""]).translate(_BLANKS)
        text = np.frombuffer(raw, np.uint8)
        blank = text == 32
        inner = ~blank
        keep = inner.copy()
        keep[1:] |= inner[:-1]
        #: The words, each with one blank behind it.
        self.text = text[keep]
        #: Place in ``raw`` behind each word.
        ends = np.flatnonzero(keep & blank)
        sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        #: Words before the end of each text.
        upto = np.searchsorted(ends, np.cumsum(sizes + 1) - 1, "right")
        self.counts = np.diff(upto, prepend=0)
        self.starts = upto - self.counts
        #: Where words begin in ``text``, and where a next one would.
        self.begins = np.concatenate(([0], np.flatnonzero(self.text == 32) + 1))
        doc = np.repeat(np.arange(len(texts)), self.counts)
        ids = _word_hashes(self.text, self.begins)
        n = max(0, len(ids) - WINDOW + 1)
        #: First word, among all, of each window.
        self.windows = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
        self.doc = doc
        self.ids = ids
        seeds = common.mix(common.rolling(ids, SEED))
        #: Place of each window's least seed (the first of equals).
        self.at = _least(seeds, WINDOW - SEED + 1)[self.windows] if n else np.empty(0, np.int64)
        #: Windows that have another place than the one before.
        self.new = np.concatenate(([True], self.at[1:] != self.at[:-1]))[:len(self.at)]
        self.seeds = seeds[self.at[self.new]]

    def keys(self) -> np.ndarray:
        return common.mix(common.rolling(self.ids, WINDOW))[self.windows]

    def hits(self, recurring: SeedFilter) -> np.ndarray:
        """Windows whose seed the filter has."""
        return recurring.has(self.seeds)[np.cumsum(self.new) - 1]

    def joined(self, k: int) -> bytes:
        """The words of a text, with one blank between them."""
        a, n = self.starts[k], self.counts[k]
        return self.text[self.begins[a]:self.begins[a + n] - 1].tobytes() if n else b""


def _word_hashes(text: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: eight bytes at a time, all words at once; long words go to a library."""
    starts, sizes = begins[:-1], np.diff(begins) - 1
    eight = np.ndarray(len(text), "<u8", np.concatenate((text, np.zeros(7, np.uint8))), strides=(1,))
    out = common.mix(sizes.astype(_U64) + _U64(HASH_SEED))
    live = np.arange(len(starts))
    for at in range(0, LONG_WORD, 8):
        if at:
            live = live[sizes[live] > at]
        if not len(live):
            break
        left = np.minimum(sizes[live] - at, 8)
        out[live] = common.mix((out[live] ^ (eight[starts[live] + at] & _MASKS[left])) * _U64(0xD6E8FEB86659FD93))
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[k] = xxhash.xxh64_intdigest(text[starts[k]:starts[k] + sizes[k]].tobytes(), seed=HASH_SEED)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first least value, by its upper 40 bits, in every ``width`` consecutive ones, by doubling."""
    low, out = _U64((1 << 24) - 1), []
    for at in range(0, len(values) - width + 1, LEAST_BLOCK):
        part = values[at:at + LEAST_BLOCK + width - 1]
        best, size = (part & ~low) | np.arange(len(part), dtype=_U64), 1
        while size < width:
            step = min(size, width - size)
            best = np.minimum(best[:len(best) - step], best[step:])
            size += step
        out.append((best & low).astype(np.int64) + at)
    return np.concatenate(out)


def _seed_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, texts in common.text_chunks(batch.column(0), SHARD_BYTES):
            value, n = np.unique(Shard(texts).seeds, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(np.minimum(n, 2))], names=["seed", "n"])


class SeedFilter:
    """``PROBES`` bits for each seed."""

    def __init__(self, words: np.ndarray, log2: int):
        self.words, self.log2 = words, log2

    @staticmethod
    def places(seeds: np.ndarray, log2: int) -> list[np.ndarray]:
        spread = common.mix(seeds * _U64(0xD6E8FEB86659FD93))
        step = common.mix(spread) | _U64(1)
        return [(spread + _U64(k) * step) & _U64((1 << log2) - 1) for k in range(PROBES)]

    def has(self, seeds: np.ndarray) -> np.ndarray:
        out = np.ones(len(seeds), bool)
        for p in self.places(seeds, self.log2):
            out &= (self.words[p >> _U64(6)] >> (p & _U64(63)) & _U64(1)).astype(bool)
        return out


def seed_filter(spark: SparkSession, docs: DataFrame, text_col: str) -> SeedFilter:
    """The filter of all seeds that occur twice or more; the driver gets its bits alone."""
    path = shared_dir(spark, "seeds")
    (docs.select(text_col).mapInArrow(_seed_counts, "seed long, n long")
     .groupBy("seed").agg(F.sum("n").alias("n")).where("n > 1").select("seed").write.parquet(path))
    seeds = spark.read.parquet(path)
    log2 = min(MOST_BITS, max(LEAST_BITS, (32 * seeds.count()).bit_length()))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.concatenate(SeedFilter.places(batch.column(0).to_numpy().view(_U64), log2))
            yield pa.RecordBatch.from_arrays(
                [pa.array((places >> _U64(6)).view(np.int64)),
                 pa.array((_U64(1) << (places & _U64(63))).view(np.int64))], names=["word", "bits"])

    rows = seeds.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (log2 - 6), _U64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(_U64)
    return SeedFilter(words, log2)


# ----------------------------------------------------------------- candidates

def _candidates(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts with a candidate window keep their words; the others get their digest."""
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for a, b, texts in common.text_chunks(batch.column(1), SHARD_BYTES):
                shard = Shard(texts)
                words = [shard.joined(k) for k in range(len(texts))]
                open_ = np.zeros(len(words), bool)
                open_[shard.doc[shard.windows[shard.hits(sent.value)]]] = True
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([number] * len(words), pa.int64()),
                     pa.array(shard.counts),
                     pa.array([None if o else hashlib.sha256(w).hexdigest() for w, o in zip(words, open_)], pa.string()),
                     pa.array([w if o else None for w, o in zip(words, open_)], pa.binary()).cast(pa.string())],
                    names=["id", "shard", "n_words", "kept_sha256", "words"])
                number += 1
    return run


# ------------------------------------------------------------------- passages

def _own(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    """What tells documents of one id apart; all alike where no id needs it."""
    return batch.column("own").to_numpy() if "own" in batch.schema.names else np.zeros(len(batch), np.int64)


def _with_own(columns: list, names: list[str], like: pa.RecordBatch | pa.Table, own) -> pa.RecordBatch:
    """A batch that has a column ``own`` if ``like`` has."""
    if "own" in like.schema.names:
        columns, names = [*columns, pa.array(own, pa.int64())], [*names, "own"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _windows(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each distinct candidate window of a shard's batch: its first place, and if it occurs again."""
        for batch in batches:
            ids, shards, owns = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _own(batch)
            for a, b, texts in common.text_chunks(batch.column(2), SHARD_BYTES):
                part = Shard(texts)
                hit = part.hits(sent.value)
                key, first = part.keys()[hit], part.windows[hit]
                doc = part.doc[first]
                rank = np.empty(b - a, np.int64)
                rank[np.lexsort((owns[a:b], ids[a:b], shards[a:b]))] = np.arange(b - a)
                # by document, then by key: starts stay in order
                order = np.argsort(rank[doc], kind="stable")
                order = order[np.argsort(key[order], kind="stable")]
                key, doc = key[order], doc[order]
                start, shard, doc_id, own = first[order] - part.starts[doc], shards[a:b][doc], ids[a:b][doc], owns[a:b][doc]
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])))[:len(key)]
                # repeated rows of one id are one place
                other = np.concatenate(([False], (doc_id[1:] != doc_id[:-1]) | (own[1:] != own[:-1])
                                        | (start[1:] != start[:-1])))[:len(key)] & ~new
                group = np.cumsum(new) - 1
                again = np.bincount(group[other], minlength=int(new.sum())) > 0
                yield _with_own(
                    [pa.array(key[new].view(np.int64)), pa.array(doc_id[new]),
                     pa.array(start[new] * 2 + again), pa.array(shard[new])], ["key", "id", "place", "shard"],
                    batch, own[new])
    return run


def _groups(batches: Iterator[pa.RecordBatch], column: int | str) -> Iterator[pa.Table]:
    """Tables of whole groups of a sorted column."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= 200_000:
            table = pa.Table.from_batches(held)
            value = table.column(column).to_numpy()
            cut = int(np.searchsorted(value, value[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).combine_chunks().to_batches()
                rows = sum(map(len, held))
    if rows:
        yield pa.Table.from_batches(held)


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of the columns."""
    values = [np.unique(c) for c in columns]
    if math.prod(map(len, values)) > MOST_CODES:
        return list(np.unique(np.stack(columns, axis=1), axis=0).T)
    code, out = np.zeros(len(columns[0]), np.int64), []
    for value, column in zip(values, columns):
        code = code * len(value) + np.searchsorted(value, column)
    code = np.unique(code)
    for value in reversed(values):
        out.append(value[code % max(1, len(value))] if len(code) else value)
        code = code // max(1, len(value))
    return out[::-1]


def _first_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key, id, own, place: (id, start, -1) of each recurring window's first place, and
    (id, -1, shard) for every shard that has one of them."""
    for table in _groups(batches, 0):
        key, doc_id, place, shard = (c.to_numpy() for c in table.columns[:4])
        own = _own(table)
        start, again = place >> 1, (place & 1).astype(bool)
        new = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        elsewhere = (doc_id != doc_id[begin][group]) | (own != own[begin][group]) | (start != start[begin][group])
        recurs = np.bincount(group[again | elsewhere], minlength=len(begin)) > 0
        first = begin[recurs]
        needs = np.flatnonzero(recurs[group])
        at = begin[group[needs]]
        pairs = _distinct(doc_id[at], shard[needs], own[at])
        none = np.full(len(first), -1)
        yield _with_own(
            [pa.array(np.concatenate((doc_id[first], pairs[0]))),
             pa.array(np.concatenate((start[first], np.full(len(pairs[0]), -1)))),
             pa.array(np.concatenate((none, pairs[1])))], ["id", "start", "shard"],
            table, np.concatenate((own[first], pairs[2])))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by id (own, id): runs of consecutive first places, flat as start, end, and the shards that
    need them."""
    first = next(batches, None)
    if first is None:
        return
    # documents without an id are as many groups as they have texts
    for table in _groups(chain([first], batches), "own" if "own" in first.schema.names else "id"):
        doc_id, start, shard = (c.to_numpy() for c in table.columns[:3])
        own = _own(table)
        edge = np.append(np.flatnonzero(np.concatenate(
            ([True], (doc_id[1:] != doc_id[:-1]) | (own[1:] != own[:-1])))), len(doc_id))
        ids, runs, shards, owns = [], [], [], []
        for a, b in zip(edge.tolist(), edge[1:].tolist()):
            places, need = start[a:b], np.unique(shard[a:b])
            places, need = np.unique(places[places >= 0]), need[need >= 0]
            cut = np.flatnonzero(np.diff(places) != 1)
            begin, end = np.concatenate((places[:1], places[cut + 1])), np.concatenate((places[cut], places[-1:]))
            flat = np.stack((begin, end + WINDOW), axis=1).reshape(-1)
            for at in range(0, len(need), SHARDS_A_ROW):
                ids.append(doc_id[a])
                runs.append(flat)
                shards.append(need[at:at + SHARDS_A_ROW])
                owns.append(own[a])
        yield _with_own(
            [pa.array(ids, pa.int64()), pa.array(runs, pa.list_(pa.int64())), pa.array(shards, pa.list_(pa.int64()))],
            ["id", "runs", "shards"], table, owns)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, runs, shards, words) to one row for each passage: its first place, its words, the shards."""
    for batch in batches:
        out: tuple[list, list, list, list, list] = ([], [], [], [], [])
        for doc_id, runs, shards, words, own in zip(*(c.to_pylist() for c in batch.columns[:4]), _own(batch).tolist()):
            words = words.split(" ")
            for a, b in zip(runs[::2], runs[1::2]):
                for column, value in zip(out, (doc_id, a, " ".join(words[a:b]), shards, own)):
                    column.append(value)
        yield _with_own(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
             pa.array(out[3], pa.list_(pa.int64()))], ["id", "start", "words", "shards"], batch, out[4])


def one_id_many_texts(candidates: DataFrame) -> tuple[bool, bool]:
    """Whether an id (or none) has more than one row, and whether those differ in their words."""
    if not candidates.groupBy("id").count().where("count > 1").limit(1).count():
        return False, False
    texts = candidates.groupBy("id").agg(F.min(F.xxhash64("words")).alias("a"), F.max(F.xxhash64("words")).alias("b"))
    return True, bool(texts.where("a < b").limit(1).count())


def passages(spark: SparkSession, candidates: DataFrame, sent, repeated: bool) -> DataFrame:
    """(id, start, words, shards): first place and words of each recurring passage, and the shards that have it."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = [c for c in candidates.columns if c == "own"]
    more = ", own long" if own else ""
    firsts = (candidates.select("id", "shard", "words", *own)
              .mapInArrow(_windows(sent), f"key long, id long, place long, shard long{more}")
              .repartition(parts, "key").sortWithinPartitions("key", "id", *own, "place")
              .mapInArrow(_first_places, f"id long, start long, shard long{more}"))
    runs = (firsts.repartition(parts, *own, "id").sortWithinPartitions(*own, "id")
            .mapInArrow(_runs, f"id long, runs array<long>, shards array<long>{more}"))
    texts = candidates.select("id", "words", *own)
    if repeated:  # their text is needed once
        texts = texts.dropDuplicates(["id", *own])
    return (runs.join(texts, ["id", *own]).select("id", "runs", "shards", "words", *own)
            .mapInArrow(_texts, f"id long, start long, words string, shards array<long>{more}"))


# ------------------------------------------------------------------- automata

class Automaton:
    """Phrases of passages: hits are places where a whole phrase stands.

    A word is a few symbols of ``DIGIT`` values, since a node's edges are searched one by one; each place in
    the word has symbols of its own, so a hit cannot begin within a word.  Words that no passage has are all
    alike.
    """

    def __init__(self, rows: list[tuple[int, int, int, bytes]]):
        self.ids, self.owns, self.first = (np.array([r[k] for r in rows], np.int64) for k in range(3))
        words = [r[3].split(b" ") for r in rows]
        self.codes = {w: k + 1 for k, w in enumerate(dict.fromkeys(chain.from_iterable(words)))}
        self.width = 1
        while DIGIT ** self.width <= len(self.codes):
            self.width += 1
        # passages lie one after the other with a gap between them: comparisons stop there
        self.flat, self.offsets, text = self._flat(words)
        self.flat[self.flat == 0] = -1
        self.tree = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        times = (np.fromiter(map(len, words), np.int64, len(words)) - PHRASE) // STRIDE + 1
        passage = np.repeat(np.arange(len(words)), times)
        place = self.offsets[passage] + STRIDE * (np.arange(len(passage)) - np.repeat(np.cumsum(times) - times, times))
        phrases: dict[str, int] = {}
        number = np.fromiter((phrases.setdefault(text[o:o + PHRASE * self.width], len(phrases))
                              for o in (place * self.width).tolist()), np.int64, len(place))
        for phrase, k in phrases.items():
            self.tree.add_word(phrase, k)
        if phrases:
            self.tree.make_automaton()
        order = np.argsort(number, kind="stable")
        self.passage, self.place = passage[order], place[order]
        self.times = np.bincount(number, minlength=len(phrases))
        self.begin = np.cumsum(self.times) - self.times

    def _flat(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, str]:
        """Word numbers of all texts with gaps of zeros before, between and after; where each text begins;
        the same as symbols."""
        counts = np.fromiter(map(len, words), np.int64, len(words))
        offsets = PHRASE + np.cumsum(counts + PHRASE) - counts - PHRASE
        numbers = np.zeros(PHRASE + int((counts + PHRASE).sum()), np.int64)
        inside = np.repeat(offsets - np.cumsum(counts) + counts, counts) + np.arange(int(counts.sum()))
        numbers[inside] = np.fromiter(map(self.codes.get, chain.from_iterable(words), repeat(0)), np.int64, len(inside))
        symbols, rest = np.empty((len(numbers), self.width), "<u2"), numbers
        for j in range(self.width):
            symbols[:, j] = 1 + j * DIGIT + rest % DIGIT
            rest = rest // DIGIT
        return numbers, offsets, symbols.tobytes().decode("utf-16-le")

    def covered(self, doc_ids: np.ndarray, owns: np.ndarray, docs: list[list[bytes]]) -> list[np.ndarray]:
        """For each document, which words a window covers that starts earlier elsewhere."""
        if not len(self.times):
            return [np.zeros(len(w), bool) for w in docs]
        numbers, starts, text = self._flat(docs)
        found = np.fromiter(chain.from_iterable(self.tree.iter(text)), np.int64).reshape(-1, 2)
        hits, phrase = (found[:, 0] + 1) // self.width - PHRASE, found[:, 1]
        step = np.zeros(len(numbers) + 1, np.int64)
        for at in range(0, len(hits), 20_000):
            self._compare(numbers, starts, doc_ids, owns, hits[at:at + 20_000], phrase[at:at + 20_000], step)
        cover = np.cumsum(step[:-1]) > 0
        return [cover[s:s + len(w)] for s, w in zip(starts.tolist(), docs)]

    def _compare(self, text, starts, doc_ids, owns, hits, phrase, step) -> None:
        """Compare both sides of each hit with each passage that has the phrase there, in blocks."""
        times = self.times[phrase]
        edges = np.searchsorted(np.cumsum(times), np.arange(0, int(times.sum()), 100_000))
        reach = np.arange(1, PHRASE + 1)
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(hits)]):
            n = times[a:b]
            q = np.repeat(hits[a:b], n)
            row = (np.repeat(self.begin[phrase[a:b]], n) + np.arange(int(n.sum()))
                   - np.repeat(np.cumsum(n) - n, n))
            place, passage = self.place[row], self.passage[row]
            left = _run(text[q[:, None] - reach] == self.flat[place[:, None] - reach])
            right = _run(text[q[:, None] + PHRASE - 1 + reach] == self.flat[place[:, None] + PHRASE - 1 + reach])
            doc = np.searchsorted(starts, q, "right") - 1
            offset = self.offsets[passage]
            itself = ((doc_ids[doc] == self.ids[passage]) & (owns[doc] == self.owns[passage])
                      & (q - starts[doc] == self.first[passage] + place - offset))
            ok = (left + PHRASE + right >= WINDOW) & ~itself
            np.add.at(step, (q - left)[ok], 1)
            np.add.at(step, (q + PHRASE + right)[ok], -1)


def _run(equal: np.ndarray) -> np.ndarray:
    """Length of the leading run of True in each row."""
    return np.where(equal.all(axis=1), equal.shape[1], (~equal).argmax(axis=1))


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, passages before documents: stream each shard's documents through its automaton."""
    now, rows, automaton = None, [], None
    for batch in batches:
        shards, ids, owns = batch.column(0).to_numpy(), batch.column(2).to_numpy(), _own(batch)
        starts, words = batch.column(3).to_numpy(zero_copy_only=False), common.text_bytes(batch.column(4))
        is_doc = batch.column(1).to_numpy(zero_copy_only=False)
        edge = np.flatnonzero((shards[1:] != shards[:-1]) | (is_doc[1:] != is_doc[:-1])) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(shards)]):
            if a == b:
                continue
            if shards[a] != now:
                now, rows, automaton = shards[a], [], None
            if not is_doc[a]:
                rows += list(zip(ids[a:b].tolist(), owns[a:b].tolist(), starts[a:b].tolist(), words[a:b]))
                continue
            automaton = automaton or Automaton(rows)
            rows = []
            for c, d in common.chunks(words[a:b], 2_000_000):
                docs = [w.split(b" ") for w in words[a + c:a + d]]
                cover = automaton.covered(ids[a + c:a + d], owns[a + c:a + d], docs)
                kept = [list(compress(ws, (~g).tolist())) if g.any() else ws for ws, g in zip(docs, cover)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + c:a + d]), pa.array([len(w) for w in docs], pa.int64()),
                     pa.array([int(g.sum()) for g in cover], pa.int64()),
                     pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string())],
                    names=["id", "n_words", "n_removed", "kept"])


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_removed, kept, kept_sha256) per input row.

    ``kept`` has the kept words joined by one blank where words of the document may have gone; it is NULL
    for documents that share no seed with any text, whose words are all kept; the digest is always there.
    """
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id")
    source = docs.select(ids, F.col(text_col).alias("text"))
    sent = spark.sparkContext.broadcast(seed_filter(spark, source, "text"))
    path = shared_dir(spark, "passages")
    source.mapInArrow(_candidates(sent), "id long, shard long, n_words long, kept_sha256 string, words string") \
        .write.parquet(f"{path}/documents")
    table = spark.read.parquet(f"{path}/documents")
    candidates = table.where("words IS NOT NULL")
    repeated, differ = one_id_many_texts(candidates)
    if differ:
        candidates = candidates.withColumn("own", F.xxhash64("words"))
    own = [c for c in candidates.columns if c == "own"]
    passages(spark, candidates, sent, repeated).write.parquet(f"{path}/passages")
    found = spark.read.parquet(f"{path}/passages")
    rows = (found.select(F.explode("shards").alias("shard"), F.lit(False).alias("is_doc"), "id", "start", "words", *own)
            .unionByName(candidates.select("shard", F.lit(True).alias("is_doc"), "id",
                                           F.lit(0).cast("long").alias("start"), "words", *own)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    located = (rows.repartition(parts, "shard").sortWithinPartitions("shard", "is_doc")
               .mapInArrow(_locate, "id long, n_words long, n_removed long, kept string")
               .withColumn("kept_sha256", F.sha2("kept", 256)))
    whole = table.where("words IS NULL").select(
        "id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept"), "kept_sha256")
    kind = docs.schema[id_col].dataType
    return whole.unionByName(located).select(
        F.when(F.col("id") != NO_ID, F.col("id")).cast(kind).alias(id_col),
        "n_words", "n_removed", "kept", "kept_sha256")
