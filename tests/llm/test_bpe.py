"""BPE against the tokenizers library; the transducer against a dictionary."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from hitlens.llm import bpe, lexicon, registry

PATH = registry.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
VOCABULARY = bpe.Vocabulary(PATH)
LEXICON = lexicon.Lexicon(lexicon.pack({w: tuple(VOCABULARY.merge(w)) for w in (b"the", b"endoftext", b"a", b"!?")}))


def library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def ours(text):
    ids = [i for w in bpe.pieces(text, VOCABULARY)
           for i in ([VOCABULARY.special[w[1:]]] if w[1:] in VOCABULARY.special and w[0] == "\0"
                     else VOCABULARY.merge(w.encode()))]
    return ids, bpe.decode(ids, VOCABULARY.tokens)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ours(text) == library(text)


def test_chosen_texts():
    r = random.Random(2)
    for t in ("It's WE'LL don't 123 ½ ²", "ΣΊΣΥΦΟΣ İstanbul Straße ǅ", "a<|endoftext|>b <|startoftext|>", "é Å ﬁ 한글",
              "x" * 3000, "".join(r.choice("abcdeé") for _ in range(5000)), "\0 \x1c\x1f\x85  a", "👩‍👩‍👧 🙂!!??", "'sing 'S"):
        assert ours(t) == library(t), t


def test_every_code_point():
    """Both Unicode tables agree on all characters that both know."""
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    wrong = []
    for at in range(0, len(chars), 64):
        text = " ".join(f"a{c}b" for c in chars[at:at + 64])
        if ours(text) != library(text):
            wrong += [c for c in chars[at:at + 64] if ours(f"a{c}b") != library(f"a{c}b")]
    assert not wrong, [hex(ord(c)) for c in wrong][:40]


def test_long_words_merge_alike(monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choice("theanrolds") for _ in range(r.randint(2, 60))).encode() for _ in range(200)]
    short = [VOCABULARY.merge(w) for w in words if len(w) < bpe.LONG_WORD]
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    assert [VOCABULARY.merge(w) for w in words if len(w) < 48] == short


def test_words_merged_together_merge_alike():
    r = random.Random(5)
    words = ["".join(r.choice("theanroldséü한") for _ in range(r.randint(1, 40))).encode() for _ in range(3000)]
    words += [b"", b"a", "\u00e9".encode()[:1], b"x" * 200, b"the" * 15, b"aaaaaaaaaaaaaaaa", *words[:5]]
    ids, sizes = VOCABULARY.merge_many(words)
    cuts = [0, *sizes.cumsum().tolist()]
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [VOCABULARY.merge(w) if w else [] for w in words]
    assert [x.tolist() for x in VOCABULARY.merge_many([])] == [[], []]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n.,;'!?aeé\u0301 İΣ1½<|endoftext|>\x1c\x85 한क़"),
                                           st.characters(codec="utf-8")), max_size=25), min_size=1, max_size=5))
def test_texts_by_pieces(texts):
    table = bpe.PieceTable(bpe.Encoder(VOCABULARY, LEXICON), most=20)
    for _ in range(2):
        ids, sizes, decoded = bpe.encode_texts([t.encode() for t in texts], table)
        cuts = [0, *sizes.cumsum().tolist()]
        assert [(ids[a:b].tolist(), d) for a, b, d in zip(cuts, cuts[1:], decoded)] == [library(t) for t in texts]


def test_transducer_is_minimal_and_exact():
    r = random.Random(4)
    words = {bytes(r.choice(b"ab\xc3") for _ in range(r.randint(1, 7))) for _ in range(300)}
    entries = {w: tuple(r.randrange(9) for _ in range(r.randint(0, 3))) for w in words}
    lex = lexicon.Lexicon(lexicon.mapped(lexicon.pack(entries)))
    probe = [*words, b"", b"zzz", b"aaaaaaaaaaaa", *(w + b"a" for w in words)]
    for w, n in zip(probe, lex.numbers(probe).tolist()):
        assert (tuple(lex.output(n)) if n >= 0 else None) == entries.get(w)
    # as many states as the words have different sets of endings
    ends = {frozenset(w[len(p):] for w in words if w.startswith(p)) for x in words for p in (x[:k] for k in range(len(x) + 1))}
    assert len(lex.final) == len(ends)
    assert lexicon.Lexicon(lexicon.pack({})).numbers([b"a"]).tolist() == [-1]


def check(rows, texts):
    for r in rows:
        ids, decoded = library(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_registered_query_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = registry.op6_bpe(spark, SF001).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_edge_cases_and_a_small_lexicon(spark, monkeypatch):
    texts = [None, "", " \n", "the the cat", "the the cat", "Zyx " * 60000, "é" * 9, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)] + [(None, "x", "a", "b")],
                               "doc_id long, text string, ids string, word string")
    for size in (2, 100):
        got = {r.doc_id: (r.ids, r.decoded) for r in bpe.encode(spark, df, PATH, lexicon_size=size).collect()}
        assert got == {**{i: library(t or "") for i, t in enumerate(texts)}, None: library("x")}
    assert bpe.encode(spark, df.limit(0), PATH).collect() == []
