"""Plane files: exact round trips, random access, and the query against the tokenizers library."""

import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from hitlens.llm import planes, registry
from hitlens.llm.ragged import PieceTable, flattened
from hitlens.session import shared_dir

PATH = registry.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
SPEC = open(PATH, encoding="utf-8").read()
ENCODER = planes.LibraryEncoder(SPEC)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.sampled_from(["byte", "bit"]))
def test_planes_round_trip(ids, kind):
    ids = np.array(ids, "<u4")
    assert planes.from_planes(planes.to_planes(ids, kind), len(ids), kind).tolist() == ids.tolist()


def test_planes_of_small_ids_are_absent():
    ids = np.arange(1000, dtype="<u4") % 50_000
    assert [bool(p) for p in planes.to_planes(ids, "byte")] == [True, True, False, False]
    assert sum(map(bool, planes.to_planes(ids, "bit"))) == 10


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_random_access(kind):
    r = np.random.default_rng(5)
    sizes = [r.integers(0, 40, 17), r.integers(0, 3, 5), np.array([500])]
    texts = [r.integers(0, 50_000, s.sum()).astype(np.int32) for s in sizes]
    sink = io.BytesIO()
    writer = planes.PlaneWriter(sink, kind, chunk_ids=64)
    for n, (s, ids) in enumerate(zip(sizes, texts)):
        writer.add(pa.array(range(100 * n, 100 * n + len(s))), s, ids)
    writer.close()
    every = np.concatenate(texts)
    reader = planes.PlaneReader(io.BytesIO(sink.getvalue()))
    assert reader.n_ids == len(every) and reader.n_docs == 23
    assert all(c[1] == 64 for c in reader.chunks[:-1])
    for first, n in [(0, 0), (0, len(every)), (63, 2), (64, 64), (len(every) - 1, 1), (130, 300)]:
        assert reader.ids(first, n).tolist() == every[first:first + n].tolist()
    with pytest.raises(IndexError):
        reader.ids(len(every), 1)
    firsts, tables = zip(*reader.documents())
    assert firsts[0] == 0 and sum(map(len, tables)) == 23


def test_a_damaged_or_cut_file_is_refused():
    sink = io.BytesIO()
    writer = planes.PlaneWriter(sink, "byte", 64)
    writer.add(pa.array([1]), np.array([100]), np.arange(100, dtype=np.int32))
    writer.close()
    data = bytearray(sink.getvalue())
    with pytest.raises(ValueError):
        planes.PlaneReader(io.BytesIO(bytes(data[:-20])))
    reader = planes.PlaneReader(io.BytesIO(bytes(data)))
    reader.chunks[0][2] ^= 1
    with pytest.raises(ValueError):
        reader.chunk(0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n.,;'!?aé́ İΣ1½<|endoftext|>\x1c\x85 한"), st.characters(codec="utf-8")),
                        max_size=25), min_size=1, max_size=5))
def test_pieces_encode_as_the_library_does(texts):
    table = PieceTable(ENCODER, most=20)
    for _ in range(2):
        ids, held = planes._encode(table, [t.encode() for t in texts])
        parts = np.split(ids, np.cumsum(held)[:-1])
        assert [p.tolist() for p in parts] == [library(t) for t in texts]


def test_letters_of_all_scripts():
    """Letters that normalising changes, and what follows them."""
    chars = [chr(c) for c in [*range(0x3400), *range(0x3400, 0x110000, 97)] if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}b {c} {c}. x{c}" for c in chars[a:a + 256]) for a in range(0, len(chars), 256)]
    table = PieceTable(ENCODER)
    ids, held = planes._encode(table, [t.encode() for t in texts])
    parts = np.split(ids, np.cumsum(held)[:-1])
    wrong = [k for k, (p, t) in enumerate(zip(parts, texts)) if p.tolist() != library(t)]
    assert not wrong, [hex(256 * k) for k in wrong]


def test_a_vocabulary_that_keeps_white_space_gets_whole_texts():
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    table = PieceTable(planes.LibraryEncoder(open(path, encoding="utf-8").read()))
    texts = ["two  blanks and\na line", "", " one"]
    ids, held = planes._encode(table, [t.encode() or None for t in texts])
    assert [p.tolist() for p in np.split(ids, np.cumsum(held)[:-1])] == [
        own.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_full_table_keeps_what_is_used_most():
    seen = []

    def encode(pieces):
        seen.extend(pieces)
        return (*flattened([[len(p)] * len(p) for p in pieces]), None)

    table = PieceTable(encode, most=10)
    for k in range(40):
        ids, sizes = table.gather(table.numbers([b"often", b"x" * (k + 1), b"often"]))
        assert ids.tolist() == [5] * 5 + [k + 1] * (k + 1) + [5] * 5 and sizes.tolist() == [5, k + 1, 5]
    assert seen.count(b"often") == 1 and len(table.places) <= 12


def expected(rows):
    """(doc_id, start, n_tokens, crc) of rows in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = library(text) + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = registry.op11_token_planes(spark, SF001)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected([(r.doc_id, r.text) for r in docs])


def test_edge_rows(spark):
    rows = [(3, "b a"), (None, "none"), (2, None), (7, ""), (9, "same"), (9, "same"), (1, "long " * 30_000), (9, "other"),
            (None, "none")]
    docs = spark.createDataFrame([(t, i, i, "x") for i, t in rows], "text string, doc_id long, id long, h string").repartition(5)
    for kind in ("byte", "bit"):
        folder = shared_dir(spark, "planes-test")
        manifest = planes.write_corpus(spark, docs, folder, PATH, planes=kind, chunk_ids=1000)
        assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows)
        got = sorted(planes.read_corpus(spark, folder).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
        assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
        texts = {}
        for i, t in rows:
            texts.setdefault(i, []).append(library(t) + [1])
        for r in got:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.n_tokens
            texts[r.doc_id].remove(ids)
        assert not any(texts.values())


def test_files_of_an_attempt_that_did_not_commit_do_not_count(spark):
    folder = shared_dir(spark, "planes-test")
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(20)], "doc_id long, text string")
    manifest = planes.write_corpus(spark, docs, folder, PATH)
    store, path = planes._filesystem(manifest.first().path)
    with store.open_output_stream(path.replace("part-", "part-9")) as f:
        f.write(b"half a file")
    assert planes.read_corpus(spark, folder).count() == 20


def test_an_empty_table(spark):
    folder = shared_dir(spark, "planes-test")
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert planes.write_corpus(spark, docs, folder, PATH).count() == 0
    assert planes.read_corpus(spark, folder).collect() == []
