"""Substring dedup against its SQL and against brute force."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import xxhash

from conftest import SF001
from hitlens.llm import oracle, passages, registry


def slow(docs):
    """docs: (id, text); ids unique or repeated rows of one text."""
    first = {}
    words = [(NO if d is None else d, (t or "").encode().split()) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - 19):
            k = tuple(w[i:i + 20])
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for (d, _), (n, w) in zip(docs, words):
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] < (n, i):
                gone |= set(range(i, i + 20))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


NO = passages.NO_ID


def run(spark, docs, **more):
    df = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in docs],
                               "doc_id long, text string, shard long, words string, id long")
    rows = passages.remove_repeats(spark, df).collect()
    for r in rows:
        if r.kept is not None:
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def test_registered_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    res = con.sql(oracle.PASSAGES)
    got = {tuple(r) for r in registry.op7_passages(spark, SF001).select(*res.columns).collect()}
    assert got == set(res.fetchall()) and any(r[2] for r in got)


def test_random_copies_in_small_shards(spark, monkeypatch):
    """Few words, many partial copies, periods, tiny shards and a tiny filter."""
    monkeypatch.setattr(passages, "SHARD_BYTES", 700)
    monkeypatch.setattr(passages, "SHARDS_A_ROW", 2)
    r = random.Random(8)
    base = [[r.choice("abcdefgh") + str(r.randrange(9)) for _ in range(r.randint(15, 90))] for _ in range(12)]
    docs = []
    for d in range(70):
        w = []
        for _ in range(r.randint(0, 4)):
            b = r.choice(base)
            i = r.randrange(len(b))
            w += b[i:i + r.randint(5, 60)]
            w += [r.choice("xyz") for _ in range(r.choice([0, 0, 1, 30]))]
        docs.append((d * 7 % 71, " ".join(w)))
    docs += [(100, "a b c " * 40), (101, "q " * 50), (102, "a b c " * 15)]
    assert run(spark, docs) == slow(docs)


def test_edge_cases(spark):
    p = " ".join(f"w{i}" for i in range(30))
    docs = [(3, None), (4, ""), (5, " \n\t "), (9, f"x {p}\ny"), (2, p), (2, p), (None, f"é {p}"), (None, f"é {p}"),
            (7, "one"), (1, "long " * 25000), (6, p.replace(" ", "\n\t")), (8, p.upper())]
    assert run(spark, docs) == slow(docs)
    assert run(spark, []) == []


def slow_own(spark, docs):
    """As ``slow``; rows of one id are told apart by their words' hash."""
    words = [(t or "").encode().split() for _, t in docs]
    h = [r.h for r in spark.createDataFrame([(i, b" ".join(w).decode()) for i, w in enumerate(words)], "i long, w string")
         .selectExpr("i", "xxhash64(w) AS h").orderBy("i").collect()]
    place = [(NO if d is None else d, x) for (d, _), x in zip(docs, h)]
    first = {}
    for p, w in zip(place, words):
        for i in range(len(w) - 19):
            k = tuple(w[i:i + 20])
            first[k] = min(first.get(k, (p, i)), (p, i))
    out = []
    for (d, _), p, w in zip(docs, place, words):
        gone = {j for i in range(len(w) - 19) if first[tuple(w[i:i + 20])] < (p, i) for j in range(i, i + 20)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_rows_of_no_id_or_one_id_with_different_texts(spark, monkeypatch):
    p, q, z = (" ".join(f"{c}{i}" for i in range(30)) for c in "pqz")
    y = " ".join(f"y{i}" for i in range(7))
    docs = [(None, f"{p} tail of a"), (None, f"{y} {p}"), (None, f"{y} {p}"), (None, f"{p} other tail"), (None, f"x {q} {z}"),
            (7, f"{q} one"), (7, f"{y} {q}"), (7, f"{q} {z}"), (7, f"{q}  {z}"), (3, f"{y} {y} {z}"), (None, None), (7, "")]
    want = slow_own(spark, docs)
    assert any(d is None and n for d, _, n, _ in want) and any(d == 7 and n for d, _, n, _ in want)
    assert run(spark, docs) == want
    r = random.Random(3)
    base = [[r.choice("abcdefgh") + str(r.randrange(9)) for _ in range(r.randint(25, 90))] for _ in range(6)]
    docs = []
    for _ in range(80):
        w = [r.choice("xyz") for _ in range(r.choice([0, 3, 30]))]
        for _ in range(r.randint(1, 3)):
            b = r.choice(base)
            i = r.randrange(len(b))
            w += b[i:i + r.randint(15, 60)]
        docs.append((r.choice([None, None, 1, 2, r.randrange(50)]), " ".join(w)))
    docs += docs[:10]
    assert run(spark, docs) == slow_own(spark, docs)
    monkeypatch.setattr(passages, "SHARD_BYTES", 700)
    assert run(spark, docs) == slow_own(spark, docs)


def texts_of_odd_words(r, n):
    parts = [b"a", b"bc", b"\x00", b" ", b"  ", b"\n", b"\t\x0b", b"\r", b"\x0c", b"\x1c", "é\x85".encode(), b"12345678", b"123456789"]
    out = [None, b"", b" \n", b"\x00", b"\x00\x00"]
    for _ in range(n):
        out.append(b"".join(r.choice([*parts, b"x" * r.randint(1, 150)]) for _ in range(r.randint(0, 80))))
    return out


def test_words_are_those_of_split_and_hash_alike():
    texts = texts_of_odd_words(random.Random(5), 200)
    shard = passages.Shard(texts)
    words = [t.split() if t else [] for t in texts]
    assert [shard.joined(k) for k in range(len(texts))] == [b" ".join(w) for w in words]
    assert shard.counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    by_word = dict(zip(flat, shard.ids.tolist()))
    assert [by_word[w] for w in flat] == shard.ids.tolist()
    assert len(set(by_word.values())) == len(by_word) > 500
    alone = [passages.Shard([t]).ids.tolist() for t in texts]
    assert [h for hs in alone for h in hs] == shard.ids.tolist()


def test_no_call_for_each_word(monkeypatch):
    """Seeds are counted with one library call for each long word alone."""
    calls = []
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *a, **b: calls.append(a) or 7)
    texts = [" ".join(f"word{i}" for i in range(d, d + 300)) for d in range(50)] + ["x" * 65]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    out = pa.Table.from_batches(list(passages._seed_counts(iter([batch]))))
    assert len(out) and len(calls) <= 1


def test_places_of_least_seeds_and_distinct_rows(monkeypatch):
    r = np.random.default_rng(2)
    values = r.integers(0, 5, 4000).astype(np.uint64) << np.uint64(60)
    want = [i + int(np.argmin(values[i:i + 13])) for i in range(4000 - 12)]
    assert passages._least(values, 13).tolist() == want
    monkeypatch.setattr(passages, "LEAST_BLOCK", 100)
    assert passages._least(values, 13).tolist() == want
    columns = [r.integers(-3, 3, 500), r.integers(-(1 << 62), 1 << 62, 500)[r.integers(0, 4, 500)], np.zeros(500, np.int64)]
    rows = sorted(set(zip(*(c.tolist() for c in columns))))
    assert list(zip(*(c.tolist() for c in passages._distinct(*columns)))) == rows
    wide = [r.integers(-(1 << 62), 1 << 62, 40) for _ in range(3)]
    monkeypatch.setattr(passages, "MOST_CODES", 1000)
    assert list(zip(*(c.tolist() for c in passages._distinct(*wide)))) == sorted(zip(*(c.tolist() for c in wide)))
    assert [len(c) for c in passages._distinct(*(c[:0] for c in wide))] == [0, 0, 0]
