"""Toxicity: counts against sets, probabilities that add up, held-out accuracy, edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np

from conftest import SF01
from hitlens.llm import registry, toxicity


def test_continuation_counts_are_distinct_left_words(spark):
    rows = [("a b a b. c b", 1, 0, 1), ("a b a b. c b", 1, 0, 1), ("é b x B", 0, 1, 2), (None, 0, 0, 3), ("12", 1, 1, 4)]
    df = spark.createDataFrame(rows, "text string, toxic int, fold int, h long")
    got = {r.key & (2**64 - 1): (r.o0, r.o1, r.t0, r.t1) for r in toxicity.continuation_counts(df).collect()}
    want = {}
    for text, toxic, fold, _ in rows:
        words = toxicity.words_of(text)
        for h, w in zip(["", *words], words):
            want.setdefault(w, set()).add((toxic * 2 + fold, h))
    want = {toxicity.word_key(w): tuple(Counter(g for g, _ in s)[k] for k in range(4)) for w, s in want.items()}
    assert got == want


def test_the_models_are_distributions(spark):
    """Over all kept words, rare words of stems and rare stems, each class's probabilities sum to one."""
    r = np.random.default_rng(1)
    vocabulary = [a + b for a in ("abcd", "efgh", "ijkl", "mnop", "qrst") for b in ("", "x", "y", "z", "xy")]
    text = [" ".join(r.choice(vocabulary, 40)) for _ in range(10)]
    text[0] += " idio " * 3
    df = spark.createDataFrame([(t, int(i % 3 == 0), i % 2, i) for i, t in enumerate(text)],
                               "text string, toxic int, fold int, h long")
    counts = toxicity.Counts(spark, toxicity.continuation_counts(df), 2, 1000)
    sums = [0.0, 0.0]
    seen = np.log  # the model's own logarithms are summed below
    values = []
    try:
        np.log = lambda x: values.append(np.asarray(x)) or seen(x)
        toxicity.Model(counts, (0, 1), 2)
    finally:
        np.log = seen
    for c in (0, 1):
        sums[c] = sum(float(v.sum()) for v in values[3 * c:3 * c + 3])
    assert all(abs(s - 1) < 0.02 for s in sums), sums


def test_registered_query_on_held_out_rows(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = registry.op5_toxicity(spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(r.score, toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    high, low = ([s for s, t, _ in held if t == k] for k in (1, 0))
    assert sum((a > b) + 0.5 * (a == b) for a in high for b in low) / (len(high) * len(low)) > 0.93
    assert sum(p != t for _, t, p in held) <= 0.06 * len(held)


def test_edge_cases(spark):
    r = random.Random(1)
    words = [a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    docs = [(i, " ".join(x for w in r.sample(words, 9) for x in (w, "rotten" if i % 3 == 0 else "nice")), 9.0, "x")
            for i in range(60)]
    docs += [(100, None, 9.0, "x"), (101, "", 9.0, "x"), (102, "1 2 3", 9.0, "x"), (0, docs[0][1], 9.0, "x"),
             (None, "rotten rotten", 9.0, "x"), (103, "rotten person " * 20000, 9.0, "x")]
    labels = [(i, int(i % 3 == 0), "e") for i in range(48)] + [(100, 0, "e"), (3, 0, "e"), (5, None, "e"), (None, 1, "e"), (999, 1, "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double, toxic string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    trained = toxicity.train(spark, df, lab)
    got = [(r.doc_id, r.score) for r in toxicity.score(spark, df, trained).collect()]
    by = dict(got)
    assert len(got) == 66 and all(0 <= s <= 1 and not math.isnan(s) for _, s in got)
    assert sum(by[i] for i in range(48, 60, 3)) / 4 > 0.5 > sum(by[i] for i in range(49, 60, 3)) / 4
    assert by[100] == by[101] == by[102]
    assert toxicity.train(spark, df, lab.where("toxic = 0")) is None
    assert toxicity.train(spark, df, lab.limit(0)) is None
    assert {r.score for r in toxicity.score(spark, df, None).collect()} == {0.0}
    assert toxicity.score(spark, df.limit(0), trained).collect() == []


def test_a_small_table_of_entries_raises_the_support(spark):
    df = spark.createDataFrame([(" ".join(f"w{chr(97 + j)}" * (j % 4 + 1) for j in range(i, i + 9)), i % 2, i % 2, i)
                                for i in range(12)], "text string, toxic int, fold int, h long")
    counts = toxicity.Counts(spark, toxicity.continuation_counts(df), 1, 8)
    assert len(counts.words[0]) <= 8
    toxicity.Model(counts, (0, 1), 1)


def test_scores_do_not_depend_on_the_entries_a_slice_may_have(spark):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(3, 8))) for _ in range(400)]
    docs = [(i, " ".join(r.choice(words[:250] if i % 3 else words[150:]) for _ in range(25))) for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(75)], "doc_id long, toxic int")
    whole, sliced = (toxicity.train(spark, df, lab, most=n) for n in (1 << 21, 40))
    assert len(whole[0].parts) == 1 and len(sliced[0].parts) > 3
    assert all(len(p.value.words) <= 40 for p in sliced[0].parts)
    assert sum(len(p.value.words) for p in sliced[0].parts) == len(whole[0].parts[0].value.words)
    want, got = (dict(toxicity.score(spark, df, m).collect()) for m in (whole, sliced))
    assert all(abs(got[i] - want[i]) < 1e-9 for i, _ in docs)
