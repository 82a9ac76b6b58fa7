"""Token ids in files of bit-plane shuffled chunks.

Format of a file (numbers little-endian).  ``MAGIC``; then chunks: ``chunk_ids``
consecutive ids each (the last one fewer), transposed into planes, byte k of all
ids (``byte``) or bit k of all ids, eight to a byte (``bit``), from the lowest
on.  Every plane is compressed with zstandard on its own; a plane of zeros takes
no bytes.  Then blocks of documents: an Arrow stream of (id, n_tokens),
compressed.  Then the index: of each chunk its place, its number of ids, the
crc32 of its ids and the length of each plane; of each block of documents its
place, its length, its documents and its first id.  Last the place of the index and
``MAGIC``.  So a reader seeks to the end, reads the index and then only the
chunks it wants.

Corpus.  Documents are range-partitioned by id, then by a hash of the text, then by
row, so that neither a group of rows with one id nor of equal rows meets in one task; each
task tokenises its rows in that order and writes one file, a chunk at a time.
A file's name is unique to the attempt that wrote it; the manifest, a table
that Spark commits, names the files that count, so a task that is run again after
a lost executor leaves nothing that a reader could see twice.

Defined cases: NULL is the empty text, which has the end id alone; rows without
an id come first; rows of one id follow each other in the order of their texts'
hashes, equal rows each get a place; an empty table gives an empty manifest;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import io
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.llm import common
from hitlens.llm.ragged import PieceTable, flattened, gathered, per_text

MAGIC = b"HLPLANE1"
CHUNK_IDS, DOCS_PER_BLOCK, LEVEL = 1 << 16, 1 << 16, 3
PLANES = {"byte": 4, "bit": 32}
#: Bytes of text tokenised at once, and of ids in one batch that is read back.
TEXT_STEP, READ_STEP = 2_000_000, 4_000_000


# ------------------------------------------------------------------- planes

def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of ``ids`` (uint32), the lowest first; a plane of zeros is empty."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        rows = np.ascontiguousarray(octets.T)
    else:
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little")
    return [row.tobytes() if row.any() else b"" for row in rows]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    width = n if kind == "byte" else -(-n // 8)
    rows = np.zeros((PLANES[kind], width), np.uint8)
    for row, plane in zip(rows, planes):
        if plane:
            row[:] = np.frombuffer(plane, np.uint8)
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        rows = np.packbits(bits.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file to ``out``, an open binary stream; holds one chunk and one block of documents."""

    def __init__(self, out, kind: str = "byte", chunk_ids: int = CHUNK_IDS):
        self.out, self.kind, self.chunk_ids = out, kind, chunk_ids
        self.zip = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.held, self.n_ids, self.n_docs, self.at = 0, 0, 0, 0
        self.docs: list[pa.RecordBatch] = []
        self.chunks: list[list[int]] = []
        self.blocks: list[list[int]] = []
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with ``sizes`` ids each, which follow each other in ``ids``."""
        self.docs.append(pa.RecordBatch.from_arrays([doc_ids, pa.array(sizes, pa.int64())], names=["id", "n_tokens"]))
        if sum(b.num_rows for b in self.docs) >= DOCS_PER_BLOCK:
            self._docs()
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.chunk_ids:
            ids = np.concatenate(self.waiting)
            full = len(ids) - len(ids) % self.chunk_ids
            for a in range(0, full, self.chunk_ids):
                self._chunk(ids[a:a + self.chunk_ids])
            self.waiting, self.held = [ids[full:].copy()], len(ids) - full

    def _chunk(self, ids: np.ndarray) -> None:
        data = np.ascontiguousarray(ids, "<u4")
        packed = [self.zip.compress(p) if p else b"" for p in to_planes(data, self.kind)]
        self.chunks.append([self.at, len(ids), zlib.crc32(data.tobytes()), *map(len, packed)])
        self._write(b"".join(packed))
        self.n_ids += len(ids)

    def _docs(self) -> None:
        table = pa.Table.from_batches(self.docs)
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        data = self.zip.compress(sink.getvalue())
        first = self.blocks[-1][3] + self.blocks[-1][4] if self.blocks else 0
        held = int(np.sum(table.column("n_tokens").to_numpy()))
        self.blocks.append([self.at, len(data), len(table), first, held])
        self._write(data)
        self.n_docs += len(table)
        self.docs = []

    def close(self) -> None:
        if self.held:
            self._chunk(np.concatenate(self.waiting))
        if self.docs:
            self._docs()
        at = self.at
        self._write(json.dumps({"planes": self.kind, "chunk_ids": self.chunk_ids, "n_ids": self.n_ids,
                                "n_docs": self.n_docs, "chunks": self.chunks, "documents": self.blocks}).encode())
        self._write(np.array([at], "<u8").tobytes() + MAGIC)


class PlaneReader:
    """Random access to one file through its chunk index."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        tail = self._read(size - 16, 16) if size >= 24 else b""
        if tail[8:] != MAGIC:
            raise ValueError("not a complete file of token planes")
        at = int(np.frombuffer(tail[:8], "<u8")[0])
        index = json.loads(self._read(at, size - 16 - at))
        self.kind, self.chunk_ids, self.n_ids, self.n_docs = (
            index["planes"], index["chunk_ids"], index["n_ids"], index["n_docs"])
        self.chunks, self.blocks = index["chunks"], index["documents"]
        self.unzip = zstandard.ZstdDecompressor()
        self.last = -1, np.empty(0, "<u4")

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def chunk(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            at, n, crc, *lengths = self.chunks[k]
            data, planes, width = self._read(at, sum(lengths)), [], n if self.kind == "byte" else -(-n // 8)
            for length in lengths:
                planes.append(self.unzip.decompress(data[:length], max_output_size=width) if length else b"")
                data = data[length:]
            ids = from_planes(planes, n, self.kind)
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError(f"chunk {k} is damaged")
            self.last = k, ids
        return self.last[1]

    def ids(self, first: int, n: int) -> np.ndarray:
        """Ids ``first`` to ``first + n`` of the file."""
        if not 0 <= first <= first + n <= self.n_ids:
            raise IndexError(f"{first} + {n} of {self.n_ids} ids")
        parts, end = [], first + n
        while first < end:
            k, a = divmod(first, self.chunk_ids)
            part = self.chunk(k)[a:a + end - first]
            parts.append(part)
            first += len(part)
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def documents(self) -> Iterator[tuple[int, pa.Table]]:
        """(first id, documents) block by block."""
        for at, n, _, first, _ in self.blocks:
            yield first, pa.ipc.open_stream(self.unzip.decompress(self._read(at, n))).read_all()


# ----------------------------------------------------------------- tokenising

#: Marks that may end a piece: a run of them after letters is a word of its own.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class LibraryEncoder:
    """Ids by the tokenizers library, which sees every distinct word once.

    ``by_pieces`` says whether white space parts words and is dropped, so that a text has the ids of its pieces.  A piece
    of letters and maybe one run of marks is two words.  Words of letters go to the library together and are cut apart
    where a word ends, since the last token of a word is of its own kind; if the number of ends is not as expected
    they go one by one, as all other pieces do.  Of these words, those that normalising leaves as they are need no
    normaliser and no pattern.
    """

    TOGETHER = 64

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = self._tokenizer(spec)
        described = json.loads(spec)
        suffix = described["model"].get("end_of_word_suffix")
        split, *rest = (described.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_pieces = bool(suffix) and split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
        if self.by_pieces:
            vocabulary = self.library.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
            described["normalizer"] = None
            described["pre_tokenizer"]["pretokenizers"] = [{"type": "WhitespaceSplit"}, *rest]
            self.plain = self._tokenizer(json.dumps(described))

    @staticmethod
    def _tokenizer(spec: str):
        from tokenizers import Tokenizer
        library = Tokenizer.from_str(spec)
        library.no_truncation()
        library.no_padding()
        return library

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flattened([e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)])

    def _together(self, library, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        groups = [" ".join(words[a:a + self.TOGETHER]) for a in range(0, len(words), self.TOGETHER)]
        flat, _ = flattened([e.ids for e in library.encode_batch_fast(groups, add_special_tokens=False)])
        cuts = np.flatnonzero(self.ends[flat]) + 1
        return (flat, np.diff(cuts, prepend=0)) if len(cuts) == len(words) else self.each(words)

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, None]:
        texts = b" ".join(pieces).decode().split(" ")
        words = [t.rstrip(_MARKS) for t in texts]
        # letters that normalising makes letters and marks (U+0130, U+0958) would join the marks that follow
        simple = [w.isalpha() and (w.isascii() or is_normalized("NFC", w) and w.lower().isalpha()) for w in words]
        marks = [t[len(w):] if ok else "" for t, w, ok in zip(texts, words, simple)]
        words = [(w.lower() if w.isascii() else w) if ok else t for t, w, ok in zip(texts, words, simple)]
        kinds: tuple[dict, dict, dict] = {}, {}, {}     # other pieces, words to normalise, words that stay as they are
        for w, ok in dict(zip(words, simple)).items():
            kinds[0 if not ok else 2 if w.isascii() or w == w.lower() else 1][w] = None
        kinds[0].update(dict.fromkeys(marks))
        parts = [self.each(list(kinds[0])), self._together(self.library, list(kinds[1])),
                 self._together(self.plain, list(kinds[2]))]
        flat, sizes = (np.concatenate(p) for p in zip(*parts))
        starts = np.cumsum(sizes) - sizes
        place = {w: k for k, w in enumerate(chain(*kinds))}
        # each piece is a word and a run of marks, which may be empty
        both = np.empty((len(texts), 2), np.int64)
        both[:, 0] = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        both[:, 1] = np.fromiter(map(place.__getitem__, marks), np.int64, len(marks))
        return gathered(flat, starts[both].ravel(), sizes[both].ravel()), sizes[both].sum(axis=1), None


_TABLES: dict[int, PieceTable] = {}


def _table(spec: str) -> PieceTable:
    """This worker's pieces for a vocabulary; a worker lives on from task to task."""
    key = zlib.crc32(spec.encode())
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = PieceTable(LibraryEncoder(spec))
    return _TABLES[key]


def _encode(table: PieceTable, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, and how many each text has."""
    if not table.encode.by_pieces:
        return table.encode.each([(t or b"").decode() for t in texts])
    pieces = [t.split() if t else [] for t in texts]
    ids, sizes = table.gather(table.numbers(list(chain.from_iterable(pieces))))
    return ids, per_text(sizes, np.fromiter(map(len, pieces), np.int64, len(pieces)))


# --------------------------------------------------------------------- corpus

def _filesystem(path: str):
    """Arrow file system and the path in it: local or any store that Arrow knows."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if re.match(r"[a-z0-9]+://", path):
        return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
    return fs.LocalFileSystem(), path


def write_corpus(spark: SparkSession, docs: DataFrame, folder: str, vocabulary_path: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 1, planes: str = "byte", chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Write all documents below ``folder``; returns the manifest: shard, path, n_docs, n_ids, first_id."""
    if planes not in PLANES or chunk_ids < 1:
        raise ValueError(f"{planes!r} planes, chunks of {chunk_ids} ids")
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    target = f"{folder.rstrip('/')}/ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, writer, out, path = _table(spec.value), None, None, ""
        for batch in batches:
            for a, b, texts in common.text_chunks(batch.column(1), TEXT_STEP):
                if writer is None:
                    store, inside = _filesystem(target)
                    store.create_dir(inside, recursive=True)
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.planes"
                    path, out = f"{target}/{name}", store.open_output_stream(f"{inside}/{name}")
                    writer = PlaneWriter(out, planes, chunk_ids)
                ids, held = _encode(table, texts)
                # the end id after each document
                ids = np.insert(ids, np.cumsum(held), end_id)
                writer.add(batch.column(0).slice(a, b - a), held + 1, ids)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([path]),
                 pa.array([writer.n_docs], pa.int64()), pa.array([writer.n_ids], pa.int64())],
                names=["shard", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col(c).asc_nulls_first() for c in ("id", "h", "row")]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
     .mapInArrow(run, "shard int, path string, n_docs long, n_ids long").write.parquet(f"{folder.rstrip('/')}/manifest"))
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files that count, in order, with the number of ids before each (one row per file, so one window)."""
    files = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"))


def read_corpus(spark: SparkSession, folder: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids): of each document the ids before it in the corpus, its ids as little-endian
    unsigned 32-bit numbers in one binary value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, inside = _filesystem(path)
                with store.open_input_file(inside) as source:
                    reader = PlaneReader(source)
                    for first, docs in reader.documents():
                        yield from _documents(reader, base, first, docs.combine_chunks(), id_col)

    manifest = read_manifest(spark, folder)
    parts = max(1, manifest.count())
    return manifest.select("path", "first_id").repartition(parts).mapInArrow(
        run, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")


def _documents(reader: PlaneReader, base: int, first: int, docs: pa.Table, id_col: str) -> Iterator[pa.RecordBatch]:
    sizes = docs.column("n_tokens").to_numpy()
    starts = first + np.cumsum(sizes) - sizes
    at = 0
    while at < len(sizes):
        # as many documents as fit in one step, at least one
        upto = max(at + 1, int(np.searchsorted(starts + sizes, starts[at] + READ_STEP // 4, "right")))
        ids = reader.ids(int(starts[at]), int(sizes[at:upto].sum())).tobytes()
        cuts = ((starts[at:upto] - starts[at]) * 4).tolist()
        ends = [*cuts[1:], len(ids)]
        yield pa.RecordBatch.from_arrays(
            [docs.column("id").slice(at, upto - at).combine_chunks(), pa.array(base + starts[at:upto], pa.int64()),
             pa.array(sizes[at:upto], pa.int64()), pa.array([ids[a:b] for a, b in zip(cuts, ends)], pa.binary())],
            names=[id_col, "start", "n_tokens", "ids"])
        at = upto
