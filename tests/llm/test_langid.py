"""Language ID: kernel values against sets, held-out accuracy, edge cases."""

import zlib

import numpy as np

from conftest import SF001
from hitlens.llm import langid, registry


def slow_grams(text, table):
    symbols = [int(table[ord(c)]) for c in text]
    word = [0]
    for s in [*symbols, 0]:
        if s or word[-1]:
            word.append(s)
    return {tuple(word[i:i + n]) for n in range(1, langid.ORDER + 1) for i in range(len(word) - n + 1)}


def test_scores_are_kernel_ridge_regression(monkeypatch):
    r = np.random.default_rng(0)
    grams = [np.unique(r.integers(0, 50, 20) + 30 * (i % 2)) for i in range(20)]
    label = np.arange(20) % 2
    model = langid.fit(["a", "b"], grams, label, landmarks=10, ridge=1e-3)
    k = np.array([[len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y)) for y in grams] for x in grams])
    full = k @ np.linalg.solve(k + 1e-3 * np.eye(20), np.eye(2)[label])  # all rows are landmarks
    for cells in (4_000_000, 200, 1):
        monkeypatch.setattr(langid, "CELLS", cells)
        assert np.abs(model.score_grams(grams) - full).max() < 0.05


def test_scores_of_texts_are_kernel_values_times_the_weights(monkeypatch):
    r = np.random.default_rng(1)
    texts = ["".join(r.choice(list("abcdé жя "), n)) + tail for n, tail in
             [(30, "a"), (300, "b"), (5, "c"), (3000, "ж"), (1, "q"), (80, "abc")] * 4]
    grams = [langid.ngrams(t) for t in texts]
    label = np.arange(len(texts)) % 3
    model = langid.fit(["x", "y", "z"], grams, label, landmarks=3, ridge=0.1)
    marks = [i for c in range(3) for i in np.flatnonzero(label == c)[:3]]
    asked = [*texts, None, "", "12 . 3", "unseen ñandú"]

    def kernel(x, y):
        return len(set(x) & set(y)) / np.sqrt(len(x) * len(y)) if len(x) else 0.0

    want = np.array([[kernel(langid.ngrams(t or ""), grams[m]) for m in marks] for t in asked]) @ model.weights
    for cells in (4_000_000, 500, 1):
        monkeypatch.setattr(langid, "CELLS", cells)
        got, ok = model.scores(asked)
        assert np.abs(got - want).max() < 1e-5
        assert ok.tolist() == [True] * len(texts) + [False, False, False, True]
    assert model.scores([])[0].shape == (0, 3)


def test_registered_query_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = registry.op1_language_id(spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en", "x") for i in range(5)] + [(i, "le chat et le chien", "fr", "x") for i in range(5, 10)]
    extra = [(20, None, "en", "x"), (21, "", "en", "x"), (22, "12 ... 3", "en", "x"), (23, "le chien", None, "x"),
             (23, "le chien", None, "x"), (None, "the dog", "fr", "x"), (24, "the dog " * 50000, None, "x"), (25, "жук", None, "x")]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, lang_pred string")
    model = langid.train(spark, df)
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict(spark, df, model).collect()]
    by = {d: p for d, p, _ in got}
    assert len(got) == 18 and by[20] == by[21] == by[22] == "und" and by[23] == "fr" and by[None] == by[24] == "en"
    assert by[25] in ("en", "fr") and all((s == 0) == (p == "und") or p != "und" for _, p, s in got)
    kept = {r.doc_id for r in langid.keep_identified(spark, df, model).collect()}
    assert set(range(10)) | {23, 24, None} <= kept and not kept & {20, 21, 22}
    assert langid.train(spark, df.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(spark, df, None).collect()} == {"und"}
    assert langid.predict(spark, df.limit(0), model).collect() == []


def test_ngrams_are_the_set_over_all_letters_in_blocks_too(monkeypatch):
    for text in ("abc", "  Ab -- cab 12 É zz", "Жук и ЖУК", "日本語 と 中文, 한국어", "𐐀𐐁 x", "абвabcαβγ" * 50, "\ud800 a"):
        symbols = {ord(c): int(langid.letters()[ord(c)]) for c in text}
        want = {sum(x + 1 << langid.BITS * k for k, x in enumerate(reversed(g))) for g in slow_grams(text, symbols)}
        for block in (1 << 20, 7, 1):
            monkeypatch.setattr(langid, "BLOCK", block)
            got = langid.ngrams(text).tolist()
            assert got == sorted(want)
    assert not len(langid.ngrams("12 ... 3"))


def test_languages_of_many_scripts_keep_their_letters(spark):
    """More letters than any small alphabet, most of them in short texts beside long ones."""
    r = np.random.default_rng(2)
    letters = {"en": range(97, 123), "ru": range(0x430, 0x450), "el": range(0x3B1, 0x3C9), "zh": range(0x4E00, 0x4F00),
               "zz": range(0x5E00, 0x5F00), "ja": range(0x3041, 0x3094), "ko": range(0xAC00, 0xAD00)}
    rows = []
    for lang, codes in letters.items():
        words = ["".join(map(chr, r.choice(list(codes), r.integers(2, 7)))) for _ in range(60)]
        size = 400 if lang in ("en", "ru", "el") else 12
        rows += [(len(rows) + k, " ".join(r.choice(words, size)), lang) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(spark, df.where("doc_id % 4 != 0"))
    lang = {d: name for d, _, name in rows}
    got = {x.doc_id: x.lang_pred for x in langid.predict(spark, df, model).collect()}
    assert got == lang
    assert langid.keep_identified(spark, df, model).count() == len(rows)


def test_more_labels_than_classes_and_clean_documents_stay(spark):
    """The labels of most rows are learned; a label with one dirty row does not stop the others."""
    rows = [(i, "the cat and the dog walk home", "en") for i in range(8)]
    rows += [(i, "le chat et le chien rentrent", "fr") for i in range(8, 14)]
    rows += [(100 + i, f"noise {i}", f"dirty-{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(spark, df, max_classes=2)
    assert model.classes == ["en", "fr"]
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark, df, model).collect()}
    assert all(got[d] == lang for d, _, lang in rows[:14])
    assert {r.doc_id for r in langid.keep_identified(spark, df, model).collect()} >= set(range(14))
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = langid.train(spark, docs)
    labelled = docs.where("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    assert langid.keep_identified(spark, labelled, model).count() == labelled.count()


def test_a_batch_of_texts_is_not_copied_whole():
    import tracemalloc

    import pyarrow as pa
    grams = [langid.ngrams(t) for t in ("aaa bbb", "ccc ddd")]
    model = langid.fit(["x", "y"], grams, np.array([0, 1]), 1, 0.1)
    column = pa.array(["aaa bbb " * 1000, "ccc ddd " * 1000, None] * 2000)  # 32 MB
    langid._labels(model, column.slice(0, 2))  # what a process makes once
    tracemalloc.start()
    try:
        names, _, kept = langid._labels(model, column)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert names.to_pylist() == ["x", "y", langid.UNKNOWN] * 2000 and kept.sum() == 4000
    assert peak < langid.CELLS * 4 + 16_000_000
