"""The pipeline's stages against brute force, each on its own input."""

import re

from conftest import SF001
from test_bpe import library
from test_decontaminate import slow as slow_hits
from test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from hitlens.llm import decontaminate, secrets, simhash


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_one_by_one(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash", "decontaminate", "secrets", "bpe"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, before = docs.columns, rows_of(docs)

    docs = corpus_pipeline.identify_language(spark, docs, SF001)
    after = rows_of(docs)
    assert docs.columns == columns and all(after[d] == before[d] for d in after)
    assert len(after) >= 0.99 * sum(any(c.isalpha() for c in r.text) for r in before.values())

    before, docs = after, corpus_pipeline.drop_near_duplicates(spark, docs, SF001)
    after = rows_of(docs)
    ids = sorted(before)
    component = dict(zip(ids, slow_components([(d, slow_fingerprint(before[d].text)) for d in ids])))
    assert docs.columns == columns and set(after) == {d for d in ids if component[d] == d} and len(after) < len(ids)

    before, docs = after, corpus_pipeline.remove_benchmark(spark, docs, SF001)
    after = rows_of(docs)
    phrases = []
    for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect():
        w = decontaminate.words_of(r.text.encode())
        phrases += [(r.item_id, w[i:i + 10]) for i in range(max(1, len(w) - 9))]
    changed = 0
    for d, r in before.items():
        words = decontaminate.words_of(r.text.encode())
        hit = slow_hits(words, phrases)[0]
        if not hit:
            assert after[d] == r
        elif hit == len(words):
            assert d not in after
        else:
            changed += 1
            left = decontaminate.words_of(after[d].text.encode())
            assert len(left) == len(words) - hit and not slow_hits(left, phrases)[0]
            assert after[d].n_chars == len(after[d].text)
    assert changed and docs.columns == columns

    before, docs = after, corpus_pipeline.mask_secrets(spark, docs, SF001)
    after = rows_of(docs)
    assert docs.columns == columns and set(after) == set(before)
    for d, r in before.items():
        if not re.search(r"(?i)token|secret|passw|api|AKIA|[0-9a-f]{24}", r.text):
            assert after[d] == r
    assert not any(x["spans"] for x in secrets.findings(spark, docs).collect())

    before, after = after, rows_of(corpus_pipeline.tokenize(spark, docs, SF001))
    assert set(after) == set(before)
    assert all((after[d].ids, after[d].decoded) == library(before[d].text) for d in after)


def test_run_ends_with_the_same_documents(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == ["doc_id", "lang", "source", "ids", "decoded"] and out.count() > 100


def test_one_of_each_group_stays_without_ids_too(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "A b c"), (None, "a b c"), (None, "other words here"),
            (None, "other words here"), (None, "Other words here"), (3, None)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    got = simhash.keep_one(spark, df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in got.collect()) == \
        [(0, "other words here"), (1, "a b c"), (3, "")]


def test_an_empty_table_runs_through(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.collect() == []
