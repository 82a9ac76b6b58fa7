"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash

from conftest import SF001
from hitlens.llm import registry, simhash
from hitlens.llm.components import connected_components
from hitlens.session import shared_dir

SCHEMA = "doc_id long, text string, fp string, component_id string"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def slow_components(rows):
    """rows: (id, fingerprint)"""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        best.setdefault(find(i), []).append(d)
    return [min(best[find(i)]) for i in range(len(rows))]


def test_registered_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in docs]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(rows, slow_components(rows))}
    got = registry.op10_simhash(spark, SF001).collect()
    assert len(got) == len(docs)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == want


def test_trie_join_finds_every_pair(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 1)
    monkeypatch.setattr(simhash, "PAIR_BLOCK", 64)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(30)]
    values = {b ^ sum(1 << x for x in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(8)}
    values = np.array(sorted(values | {0, 2**64 - 1}), np.uint64)
    got = {(int(a), int(b)) for i, j in simhash.trie_pairs(values, np.zeros(len(values)), 3) for a, b in zip(i, j)}
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values))
            if (int(values[i]) ^ int(values[j])).bit_count() <= 3}
    assert got == want
    keys = simhash.join_keys(values, 3)
    assert all(np.any(keys[i] == keys[j]) for i, j in want)


def test_edge_cases(spark):
    rows = [(5, None), (9, ""), (2, " \n\t"), (7, "one"), (7, "one"), (None, "one"), (8, "ONE"),
            (None, "quite another text here"), (1, "x " * 40000 + "y"), (3, "x " * 40000 + "z")]
    df = spark.createDataFrame([(d, t, "a", "b") for d, t in rows], SCHEMA)
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(spark, df).collect()]
    assert len(got) == len(rows)
    assert {x for x in got if x[0]} == {(1, 1), (2, 2), (3, 1), (5, 2), (7, 7), (8, 7), (9, 2)}
    assert {x[1] for x in got if x[0] is None} == {7, None}
    assert simhash.near_duplicates(spark, df.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (3, 3), (None, 4), (900, 899)]
    got = connected_components(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.component) for r in got} == \
        {(i, 0) for i in range(201)} | {(500, 500), (501, 500), (899, 899), (900, 899)}
    assert len(got) == 205


def test_columns_of_the_names_in_use_pass_through(spark):
    rows = [(None, "alone here", "r", "k", 1, 2, 3), (None, "alone here", "r", "k", 1, 2, 3), (4, "a b c", "s", "l", 4, 5, 6),
            (4, "a b c", "s", "l", 4, 5, 6), (5, "A b c", "t", "m", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __row string, key string, Row long, `rows` long, fp long")
    out = simhash.keep_one(spark, df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[2]], key=str)


def test_large_key_groups_are_split_and_lose_no_link(spark, monkeypatch):
    """Fingerprints that share most of their bits: groups under a key are bounded, components are exact."""
    r = random.Random(8)
    base = r.getrandbits(64)
    low = (1 << 24) - 1  # the other 40 bits are the same, but for what is flipped
    values = {base ^ (r.getrandbits(64) & low) for _ in range(150)}
    values |= {v ^ sum(1 << x for x in r.sample(range(64), 3)) for v in list(values) for _ in range(2)}
    rows = [(i, v) for i, v in enumerate(sorted(values))]
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in rows], "fp long, node long")
    keys = [len(k.groupBy("key").count().collect()) for k in simhash.keyed_groups(spark, nodes, 3, shared_dir(spark, "t"))]
    assert len(keys) == 1
    monkeypatch.setattr(simhash, "GROUP_ROWS", 8)
    levels = simhash.keyed_groups(spark, nodes, 3, shared_dir(spark, "t"))
    assert len(levels) == 3
    for level in levels[:2]:
        assert level.groupBy("key").count().agg({"count": "max"}).first()[0] <= 8
    met = set()
    for level in levels:
        by = {}
        for k, _, n in level.collect():
            by.setdefault(k, []).append(n)
        met |= {(a, b) for g in by.values() for a in g for b in g if a < b}
    near = {(i, j) for i, a in rows for j, b in rows if i < j and (a ^ b).bit_count() <= 3}
    assert near and near <= met


def test_components_do_not_depend_on_the_size_of_groups(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    want = {tuple(r) for r in simhash.near_duplicates(spark, docs).collect()}
    monkeypatch.setattr(simhash, "GROUP_ROWS", 1)
    assert {tuple(r) for r in simhash.near_duplicates(spark, docs).collect()} == want


def test_keep_one_does_not_sort_texts(spark):
    """The ids are hashed and the texts stream past them."""
    df = spark.createDataFrame([(i, f"text number {i} of many others") for i in range(20)], "doc_id long, text string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = simhash.keep_one(spark, df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    joins = [line for line in plan.splitlines() if "LeftSemi" in line and "Join" in line]
    assert joins and all("ShuffledHashJoin" in line for line in joins)
