"""BPE encoding and decoding with a transducer lexicon for frequent words.

The vocabulary file (a public tokenizer's JSON: NFC, white space collapsed,
lower case; words by its pattern; byte-level BPE with word ends) is a
parameter and is read on the driver.  Words of all documents are counted
(pre-aggregated in each task, then summed by Spark); the most frequent ones
of at most ``LEXICON_BYTES`` bytes, ``LEXICON`` at most, are merged once and
compiled with their ids into a minimal acyclic transducer.  Tasks memory-map
it.  A word that the lexicon lacks is merged exactly, many words at once, so the
result does not depend on the lexicon.

Words never hold white space, so a text is cut at ASCII white space into pieces
and every distinct piece is normalised, split and encoded once per worker
(``ragged.PieceTable``, with its decoded text); a text's ids are a gather by piece
number.

``decode`` joins the tokens of the ids with blanks, which is what the file's
missing decoder means.

Defined cases: NULL is the empty text, which has no ids and decodes to "";
the file's special tokens in a text become their ids; repeated rows each get
a row; an empty table gives no rows and an empty lexicon; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common
from hitlens.llm.lexicon import Lexicon, mapped, pack
from hitlens.llm.ragged import PieceTable, gathered, per_text
from hitlens.session import shared_dir

LEXICON, LEXICON_BYTES = 40_000, 64
#: Pieces a task counts or remembers at most before it sends them on or forgets those used least.
COUNT_MOST, CACHE_MOST = 300_000, 300_000
#: Bytes of text at once, and words merged at once.
TEXT_STEP, MERGE_STEP = 2_000_000, 50_000
#: Words from this many symbols on are merged with a heap.
LONG_WORD = 48
#: Stands for a pair that is never merged: after every rank.
_NONE, _NEVER = (1 << 60, -1), np.int32(2**31 - 1)


# What Unicode 16 and 17 added after the tables of this Python (15.1) and the public
# tokenizers' library knows.  First and last code point of each range; (first, last, distance to lower case).
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
NEW_LOWER = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B)]
_LOWER = {c: c + step for first, last, step in NEW_LOWER for c in range(first, last + 1)} | {ord("Σ"): ord("σ")}
_NEEDS_LOWER = re.compile("[" + "".join(map(chr, _LOWER)) + "]")


def byte_symbols() -> dict[int, str]:
    """byte -> the printable character that byte-level vocabularies write for it."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + k) for k, b in enumerate(rest)}


class Vocabulary:
    """What encoding needs of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = byte_symbols()
        self.first = [vocab[symbols[b]] for b in range(256)]
        self.last = [vocab[symbols[b] + end] for b in range(256)]
        #: pair of ids -> (rank, id of the merged token)
        self.merges = {vocab[a] << 16 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])}
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        ranks, merged = np.array(list(self.merges.values()), np.int32).reshape(-1, 2).T
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        #: by rank
        self.merged = np.zeros(len(keys), np.int32)
        self.merged[ranks] = merged
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, number in chain(vocab.items(), self.special.items()):
            self.tokens[number] = token

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of the lowest rank is merged first, the leftmost of equals."""
        ids = [self.first[b] for b in word[:-1]]
        ids.append(self.last[word[-1]])
        if len(ids) >= LONG_WORD:
            return self._merge_long(ids)
        find = self.merges.get
        found = [find(a << 16 | b, _NONE) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is _NONE:
                break
            at = found.index(best)
            ids[at:at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = find(ids[at - 1] << 16 | ids[at], _NONE)
            if at < len(found):
                found[at] = find(ids[at] << 16 | ids[at + 1], _NONE)
        return ids

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``_NEVER`` if there is none."""
        keys = left.astype(np.int64) << 16 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (right >= 0), self.ranks[at], _NEVER)

    def merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words: all ids, and how many each word has.  Words of like length take their next merge
        together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sizes, starts, parts, held = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0
        for least, most in ((1, 7), (7, 13), (13, 21), (21, LONG_WORD)):
            at = np.flatnonzero((lengths >= least) & (lengths < most))
            for some in np.split(at, range(MERGE_STEP, len(at), MERGE_STEP)):
                if len(some):
                    ids = self._merge_group([words[k] for k in some.tolist()], lengths[some])
                    inside = ids >= 0
                    sizes[some] = inside.sum(axis=1)
                    starts[some] = held + np.cumsum(sizes[some]) - sizes[some]
                    parts.append(ids[inside])
                    held += len(parts[-1])
        for k in np.flatnonzero(lengths >= LONG_WORD).tolist():
            parts.append(np.array(self.merge(words[k]), np.int32))
            sizes[k], starts[k] = len(parts[-1]), held
            held += len(parts[-1])
        return gathered(np.concatenate([np.empty(0, np.int32), *parts]), starts, sizes), sizes

    def _merge_group(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Ids of each word, then -1."""
        n, width = len(words), int(sizes.max())
        columns = np.arange(width, dtype=np.int32)
        flat = np.frombuffer(b"".join(words), np.uint8)
        ids = np.full((n, width), -1, np.int32)
        ids[columns < sizes[:, None]] = np.array(self.first, np.int32)[flat]
        rows = np.arange(n)
        ids[rows, sizes - 1] = np.array(self.last, np.int32)[flat[np.cumsum(sizes) - 1]]
        done = np.full((n, width), -1, np.int32)
        # ranks[r, c]: of the merge of ids c and c + 1
        ranks = np.full((n, width), _NEVER, np.int32)
        ranks[:, :-1] = self._rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            each = np.arange(len(rows))
            best = np.argmin(ranks, axis=1)         # of equal ranks the leftmost
            rank = ranks[each, best]
            over = rank == _NEVER
            if over.any():
                done[rows[over]] = ids[over]
                rows, ids, ranks, best, rank = (x[~over] for x in (rows, ids, ranks, best, rank))
                each = np.arange(len(rows))
            ids[each, best] = self.merged[rank]
            # what follows the id that was taken in moves up by one
            behind = columns[:-1] > best[:, None]
            ids[:, :-1] = np.where(behind, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(behind, ranks[:, 1:], ranks[:, :-1])
            ids[:, -1], ranks[:, -1] = -1, _NEVER
            ranks[each, best] = self._rank(ids[each, best], ids[each, np.minimum(best + 1, width - 1)])
            has = np.flatnonzero(best > 0)
            ranks[has, best[has] - 1] = self._rank(ids[has, best[has] - 1], ids[has, best[has]])
        return done

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with linked neighbours and a heap: n log n for words of any length."""
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges, heap = self.merges, []

        def offer(i: int) -> None:
            j = after[i]
            if j >= 0 and (m := merges.get(ids[i] << 16 | ids[j])):
                heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


def _ranges(belongs, end: int) -> str:
    """The inside of a character class: the ranges of code points below ``end`` that belong."""
    edges, inside = [], False
    for c in range(end + 1):
        now = c < end and belongs(chr(c))
        if now != inside:
            edges.append(c - inside)
            inside = now
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(edges[::2], edges[1::2]))


def _category(name: str, new: list[tuple[int, int]]):
    return lambda c: unicodedata.category(c)[0] == name or any(a <= ord(c) <= b for a, b in new)


@lru_cache(maxsize=8)
def _splitter(pattern: str, end: int):
    """The file's pattern for ``re``, its Unicode classes spelled out for code points below ``end``.

    Classes within the first 65,536 code points are looked up in a table, longer ones range by range.
    """
    classes = {r"\p{L}": _ranges(_category("L", NEW_LETTERS), end),
               r"\p{N}": _ranges(_category("N", NEW_NUMBERS), end),
               r"\s": _ranges(lambda c: c.isspace() and not "\x1c" <= c <= "\x1f", end)}
    # no other branch starts with a letter or a number, so theirs may be tried first
    branches = sorted(pattern.split("|"), key=lambda b: not b.startswith(("[\\p{L}]", "[\\p{N}]")))
    pattern = "|".join(branches)
    for name, inside in classes.items():
        pattern = pattern.replace(name, inside)
    return re.compile(pattern).findall


def _split(text: str, pattern: str) -> list[str]:
    if text.isascii():
        return _splitter(pattern, 0x80)(text)
    short = len(text.encode("utf-16-le")) == 2 * len(text)
    return _splitter(pattern, 0x10000 if short else 0x110000)(text)


def _normal(text: str) -> str:
    """NFC, then each character's own lower case (no final-sigma rule); white space is dropped later."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFC", text)
    return (text.translate(_LOWER) if _NEEDS_LOWER.search(text) else text).lower()


def pieces(text: str, vocabulary: Vocabulary) -> list[str]:
    """Normalised words of a text; special tokens stand as themselves, marked by a leading NUL."""
    if not any(s in text for s in vocabulary.special):
        return _split(_normal(text), vocabulary.pattern)
    out: list[str] = []
    for part in _splitter_special(tuple(vocabulary.special)).split(text):
        out += ["\0" + part] if part in vocabulary.special else _split(_normal(part), vocabulary.pattern)
    return out


@lru_cache(maxsize=4)
def _splitter_special(tokens: tuple[str, ...]):
    return re.compile("(" + "|".join(map(re.escape, tokens)) + ")")


#: Marks that may follow the letters of a piece: a run of them is a word.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(found: list[bytes], vocabulary: Vocabulary) -> list[list[str]]:
    """The words of each piece, as ``pieces`` gives them; letters and a run of marks need no pattern."""
    texts = b" ".join(found).decode().split(" ")
    letters = [t.rstrip(_MARKS) for t in texts]
    return [([_normal(w), t[len(w):]] if len(w) < len(t) else [_normal(w)])
            # not if normalising makes a mark of a letter's part (U+0130, U+0958): it would join the marks
            if w.isalpha() and (w.isascii() or unicodedata.is_normalized("NFC", w) and _normal(w).isalpha())
            else pieces(t, vocabulary) for t, w in zip(texts, letters)]


def word_counts(docs: DataFrame, vocabulary, text_col: str = "text") -> DataFrame:
    """(word, n) over all words of all texts; ``vocabulary`` is a broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc, held = vocabulary.value, Counter()

        def out() -> pa.RecordBatch:
            counts: dict[str, int] = {}
            for words, n in zip(words_of(list(held), voc), held.values()):
                for w in words:
                    counts[w] = counts.get(w, 0) + n
            return pa.RecordBatch.from_arrays(
                [pa.array([w.encode() for w in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])

        for batch in batches:
            for _, _, texts in common.text_chunks(batch.column(0), TEXT_STEP):
                for text in texts:
                    if text:
                        held.update(text.split())
                if len(held) > COUNT_MOST:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return (docs.select(text_col).mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def compile_lexicon(spark: SparkSession, docs: DataFrame, vocabulary, text_col: str = "text",
                    size: int = LEXICON) -> bytes:
    """Packed transducer of the most frequent words, ``size`` at most (words of like counts go in together)."""
    path = shared_dir(spark, "words")
    (word_counts(docs, vocabulary, text_col).where(F.length("word") <= LEXICON_BYTES)
     .where("substring(word, 1, 1) <> X'00'").write.parquet(path))
    # 64 buckets per doubling of the count: the driver gets a few thousand rows, then the words above the cut
    counts = spark.read.parquet(path).withColumn("bucket", F.floor(F.log2("n") * 64))
    held, cut = 0, None
    for r in counts.groupBy("bucket").count().orderBy(F.desc("bucket")).collect():
        held += r["count"]
        if held > size:
            break
        cut = r.bucket
    rows = counts.where(F.col("bucket") >= cut).select("word").collect() if cut is not None else []
    words = [bytes(r.word) for r in rows]
    ids, sizes = vocabulary.value.merge_many(words)
    ends = np.cumsum(sizes).tolist()
    return pack({w: tuple(ids[a:b].tolist()) for w, a, b in zip(words, [0, *ends], ends)})


class Encoder:
    """Ids and decoded text of pieces: words by the lexicon, those that it lacks by exact merging."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.special = {"\0" + t: i for t, i in vocabulary.special.items()}
        self.words = PieceTable(self._words, CACHE_MOST)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        raw = [w.encode() for w in words]
        numbers = self.lexicon.numbers(raw)
        special = [k for k, w in enumerate(words) if w in self.special]
        numbers[special] = 0
        lacking = np.flatnonzero(numbers < 0)
        merged, merged_sizes = self.vocabulary.merge_many([raw[k] for k in lacking.tolist()])
        marks = np.array([self.special[words[k]] for k in special], np.int32)
        # ids of the lexicon, then the merged ones, then the special tokens
        outputs = self.lexicon.ids
        starts, sizes = np.zeros((2, len(words)), np.int64)
        known = np.flatnonzero(numbers >= 0)
        if len(self.lexicon.starts) > 1:
            starts[known] = self.lexicon.starts[numbers[known]]
            sizes[known] = self.lexicon.starts[numbers[known] + 1] - starts[known]
        starts[lacking], sizes[lacking] = len(outputs) + np.cumsum(merged_sizes) - merged_sizes, merged_sizes
        starts[special], sizes[special] = len(outputs) + len(merged) + np.arange(len(special)), 1
        flat = gathered(np.concatenate((outputs, merged, marks)), starts, sizes)
        named = list(map(self.vocabulary.tokens.__getitem__, flat.tolist()))
        ends = np.cumsum(sizes).tolist()
        return flat, sizes, [" ".join(named[a:b]) for a, b in zip([0, *ends], ends)]

    def __call__(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        words = words_of(found, self.vocabulary)
        numbers = self.words.numbers(list(chain.from_iterable(words)))
        ids, sizes = self.words.gather(numbers)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        parts = list(map(self.words.extra.__getitem__, numbers.tolist()))
        ends = np.cumsum(counts).tolist()
        return ids, per_text(sizes, counts), [
            parts[a] if b - a == 1 else " ".join(parts[a:b]) for a, b in zip([0, *ends], ends)]


_TABLES: dict[str, PieceTable] = {}


def _table(vocabulary: Vocabulary, data: bytes, name: str) -> PieceTable:
    """This worker's pieces under a lexicon; a worker lives on from task to task."""
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = PieceTable(Encoder(vocabulary, Lexicon(mapped(data))), CACHE_MOST)
    return _TABLES[name]


def decode(ids: list[int], tokens: list[str]) -> str:
    return " ".join(map(tokens.__getitem__, ids))


def encode_texts(texts: list[bytes | None], table: PieceTable) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """All ids of the texts, how many each text has, each text decoded."""
    found = [t.split() if t else [] for t in texts]
    numbers = table.numbers(list(chain.from_iterable(found)))
    ids, sizes = table.gather(numbers)
    counts = np.fromiter(map(len, found), np.int64, len(found))
    parts = list(map(table.extra.__getitem__, numbers[sizes > 0].tolist()))
    ends = np.cumsum(per_text(sizes > 0, counts)).tolist()
    return ids, per_text(sizes, counts), [" ".join(parts[a:b]) for a, b in zip([0, *ends], ends)]


def encode(spark: SparkSession, docs: DataFrame, vocabulary_path: str, text_col: str = "text",
           keep: tuple[str, ...] = ("doc_id",), lexicon_size: int = LEXICON) -> DataFrame:
    """``keep`` columns, ids array<int>, decoded string: one row per input row."""
    vocabulary = spark.sparkContext.broadcast(Vocabulary(vocabulary_path))
    packed = compile_lexicon(spark, docs, vocabulary, text_col, lexicon_size)
    name = hashlib.sha256(packed).hexdigest()[:32]
    sent = spark.sparkContext.broadcast(packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(vocabulary.value, sent.value, name)
        for batch in batches:
            for a, b, texts in common.text_chunks(batch.column(batch.num_columns - 1), TEXT_STEP):
                ids, sizes, decoded = encode_texts(texts, table)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in range(len(keep))),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())),
                     pa.array(decoded, pa.string())],
                    names=[*keep, "ids", "decoded"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    columns = [F.col(c) for c in keep]
    return docs.select(*columns, F.col(text_col).alias("__text")).mapInArrow(
        run, f"{kept}, ids array<int>, decoded string")
