"""Decontamination: FM-index against naive search, query against its SQL, edge cases."""

import random

import duckdb
import numpy as np

from conftest import SF001
from hitlens.llm import decontaminate, oracle, registry
from hitlens.llm.fmindex import FMIndex

ITEM = "alpha beta gamma delta eps zeta eta theta iota kappa lam"


def test_fm_index_finds_every_place():
    r = np.random.default_rng(3)
    text = np.concatenate([np.append(r.integers(1, 5, n), 0) for n in r.integers(1, 60, 40)])
    patterns = np.zeros((300, 6), np.int64)
    lengths = r.integers(1, 7, 300)
    for k, n in enumerate(lengths):
        patterns[k, :n] = r.integers(1, 5, n)
    index = FMIndex(text, 6, sample=4)
    lo, hi = index.search(patterns, lengths)
    for k, n in enumerate(lengths):
        want = [i for i in range(len(text) - n + 1) if np.array_equal(text[i:i + n], patterns[k, :n])]
        assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == want


def test_registered_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    res = con.sql(oracle.DECONTAMINATE)
    df = registry.op2_decontaminate(spark, SF001)
    got = {tuple(r) for r in df.select(*res.columns).collect()}
    assert got == set(res.fetchall()) and any(r[2] for r in got)


def slow(words, phrases):
    hit, items = set(), set()
    for item, p in phrases:
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                hit |= set(range(i, i + len(p)))
                items.add(item)
    return len(hit), sorted(items)


def test_random_texts_in_small_shards_and_blocks(spark, monkeypatch):
    r = random.Random(1)
    items = [(str(i), " ".join(r.choice("abc") for _ in range(r.choice([2, 3, 9, 10, 12, 14])))) for i in range(25)]
    docs = [(i, " ".join(r.choice("abcd") for _ in range(r.randint(0, 90)))) for i in range(60)]
    phrases = []
    for name, t in items:
        w = t.split()
        n = min(10, len(w))
        phrases += [(name, w[i:i + n]) for i in range(len(w) - n + 1)]
    want = {d: (len(t.split()), *slow(t.split(), phrases)) for d, t in docs}
    monkeypatch.setattr(decontaminate, "PHRASE_BLOCK", 7)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 200)
    got = decontaminate.report(spark, spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id string, text string"))
    rows = got.collect()
    assert {x.doc_id: (x.n_words, x.n_hit, x["items"]) for x in rows} == want
    assert all(sum(s.end - s.start for s in x.spans) == x.n_hit for x in rows)
    monkeypatch.setattr(decontaminate, "PHRASE_BLOCK", 200_000)
    monkeypatch.setattr(decontaminate, "PHRASE_BYTES", 300)
    got = decontaminate.report(spark, spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id string, text string"))
    assert {x.doc_id: (x.n_words, x.n_hit, x["items"]) for x in got.collect()} == want


def test_a_worker_holds_one_block_at_a_time(spark, monkeypatch):
    """2,000 phrases in blocks of 50: no block is larger, and reading one drops the one before."""
    monkeypatch.setattr(decontaminate, "PHRASE_BLOCK", 50)
    r = random.Random(2)
    items = [(i, " ".join(f"w{r.randrange(500)}" for _ in range(49))) for i in range(50)]
    phrases = decontaminate.Phrases(spark, spark.createDataFrame(items, "item_id long, text string"), 10, "item_id", "text")
    assert len(phrases.blocks) == 40
    seen, most = set(), 0
    for block in phrases:
        held = [b for b in phrases.blocks if "_value" in b.__dict__]
        assert len(held) == 1 and len(block.vocabulary) <= 500
        seen |= {(tuple(row), name) for k, row in enumerate(map(tuple, _words(block))) for name in _names(block, k)}
        most = max(most, len(block.items))
    assert most <= 100  # hashing spreads pairs evenly, not exactly
    assert seen == {(tuple(t.split()[i:i + 10]), str(n)) for n, t in items for i in range(40)}
    assert not any("_value" in b.__dict__ for b in phrases.blocks)


def _words(block):
    by = {n: w.decode() for w, n in block.vocabulary.items()}
    return [[by[x] for x in row[:n].tolist()] for row, n in zip(block.rows, block.lengths)]


def _names(block, k):
    a = int(block.item_starts[k])
    return [block.names[i] for i in block.items[a:a + int(block.item_counts[k])].tolist()]


def test_edge_cases_and_removal(spark):
    docs = [(1, None, 0), (2, "", 0), (3, "...", 3), (4, f"Say: {ITEM.upper()}! End", 0), (4, f"Say: {ITEM.upper()}! End", 0),
            (5, ITEM, 0), (6, " ".join(ITEM.split()[:9]), 7), (None, f"x {ITEM}, {ITEM} y", 1),
            (7, "word " * 30000 + ITEM, 0), (8, "é tiny bit", 9)]
    df = spark.createDataFrame([(d, t, n, "e", "f") for d, t, n in docs],
                               "doc_id long, text string, n_chars long, item_id string, items string")
    bench = spark.createDataFrame([(9, ITEM), (9, ITEM), (10, None), (11, "..."), (None, "TINY bit")],
                                  "item_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, tuple(r["items"])) for r in
                  decontaminate.report(spark, df, bench).collect()))
    assert got == [(0, 24, 22, ("9",)), (1, 0, 0, ()), (2, 0, 0, ()), (3, 0, 0, ()), (4, 13, 11, ("9",)),
                   (4, 13, 11, ("9",)), (5, 11, 11, ("9",)), (6, 9, 0, ()), (7, 30011, 11, ("9",)), (8, 3, 2, ("",))]
    kept = {r.doc_id: r for r in decontaminate.remove(spark, df, bench).collect()}
    assert set(kept) == {None, 1, 2, 3, 4, 6, 7, 8}
    assert kept[4].text == "Say: ! End" and kept[4].n_chars == 10 and kept[4]["items"] == "f"
    assert kept[None].text == "x y" and kept[8].text == "é" and kept[8].n_chars == 1
    assert (kept[6].text, kept[6].n_chars) == (" ".join(ITEM.split()[:9]), 7)
    assert kept[1].text is None and kept[3].text == "..."
    empty = bench.limit(0)
    assert {r.n_hit for r in decontaminate.report(spark, df, empty).collect()} == {0}
    assert decontaminate.report(spark, df.limit(0), bench).collect() == []
