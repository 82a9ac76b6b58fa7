"""Language identification by string kernels.

Kernel.  A text's features are the character n-grams (n = 1 .. ``ORDER``) that
occur in it at least once, over the whole text: letters are lower-cased, a run
of anything else is one blank, and every letter of every script is a symbol of
its own.  k(x, y) = |common n-grams| / sqrt(|n-grams of x| * |n-grams of y|),
the normalised blended-spectrum presence kernel.

Training.  A bounded sample is read whole: of each language about ``per_class``
documents at most, those of the smallest hashes of doc_id, found by a histogram,
and ``SAMPLE`` of all languages together.  The ``max_classes`` languages of most
rows are learned.  Of the sample, ``landmarks`` per class are Nystroem
landmarks.  Kernel ridge regression, one-versus-rest, is solved in the span of
the landmarks: (K_nm' K_nm + ridge * K_mm) B = K_nm' Y.  Only presence lists of
the sample reach the driver, whose size is bounded by the sample.

Scoring.  The kernel values of a block of documents times B are one matrix
product: their presence matrix over the landmarks' n-grams times (landmark
matrix times B), each row divided by the root of the number of its n-grams.
The label is the largest score (ties: the first in order); its share of the
positive scores is the confidence.

Rejection.  A best score estimates how far a text belongs to its class,
whatever the number of classes.  A model of four fifths of the sample scores
the rest; half of what 99 % of these reach is the cutoff.

Defined cases: NULL texts and texts without a letter are ``und`` with score 0;
with no labelled row every document is ``und``; documents with NULL text or
lang are no training rows; an empty table gives no rows; repeated rows each get
a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm.common import text_ranges

ORDER = 3
PER_CLASS, LANDMARKS, MAX_CLASSES, RIDGE = 300, 48, 200, 0.1
#: Documents and landmarks of all classes together, at most; beyond them a class gets an equal share.
SAMPLE, ALL_LANDMARKS = 20_000, 2_000
#: One labelled document in HOLD of the sample is not fitted on, but sets the rejection cutoff.
HOLD = 5
UNKNOWN = "und"
_CODES = 0x110000
#: n-gram ids of ``ngrams``: a symbol of BITS bits (code point + 1, the blank is 1) after the other.
BITS = 21
#: Code points read at once.
BLOCK = 1 << 20
#: Cells of the presence matrix of a batch.
CELLS = 4_000_000


def _letter_table() -> np.ndarray:
    """code point -> lower-case code point for letters, 0 for anything else."""
    table = np.zeros(_CODES, np.uint32)
    for c in map(chr, range(_CODES)):
        if c.isalpha():
            low = c.lower()
            table[ord(c)] = ord(low) if len(low) == 1 else ord(c)
    return table


_LETTERS: np.ndarray | None = None


def letters() -> np.ndarray:
    """The table, made once in a process."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = _letter_table()
    return _LETTERS


def _symbols(text: str, table: np.ndarray) -> Iterator[tuple[np.ndarray, bool]]:
    """Symbols of the text in blocks, blanks folded, each block with the last symbols of the one before; and
    whether a letter has been met."""
    any_letter, tail = False, np.zeros(1, np.int64)
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at:at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = table[codes].astype(np.int64)
        any_letter |= bool(symbols.any())
        closing = np.zeros(int(at + BLOCK >= len(text)), np.int64)
        symbols = np.concatenate((tail, symbols, closing))
        symbols = symbols[np.concatenate(([True], (symbols[1:] != 0) | (symbols[:-1] != 0)))]
        yield symbols, any_letter
        tail = symbols[-(ORDER - 1):] if ORDER > 1 else symbols[:0]


def ngrams(text: str) -> np.ndarray:
    """Sorted ids of the text's distinct n-grams over all letters; empty if it has no letter."""
    any_letter, held = False, np.empty(0, np.int64)
    for symbols, any_letter in _symbols(text, letters()):
        symbols = symbols + 1
        ids, parts = symbols, [held, symbols]
        for n in range(2, ORDER + 1):
            ids = ids[:-1] << BITS | symbols[n - 1:]
            parts.append(ids)
        held = np.unique(np.concatenate(parts))
    return held if any_letter else held[:0]


@dataclass
class Model:
    classes: list[str]
    vocabulary: np.ndarray  # n-gram ids that a landmark has
    marks: list[np.ndarray]  # places in the vocabulary of each landmark's n-grams
    weights: np.ndarray     # (landmark, class)
    cutoff: float = 0.0     # best score under which a document is rejected

    def __post_init__(self):
        #: (vocabulary, class): the landmark matrix times the weights.
        self.gram_weights = np.zeros((len(self.vocabulary), len(self.classes)), np.float32)
        for places, w in zip(self.marks, self.weights):
            self.gram_weights[places] += w / np.sqrt(len(places))

    def score_grams(self, grams: Iterable[np.ndarray]) -> np.ndarray:
        """(documents, classes) ridge scores of presence lists, one matrix product for each block of documents."""
        present = np.zeros((max(CELLS // max(len(self.vocabulary), 1), 1), len(self.vocabulary)), np.float32)
        filled, parts, sizes = 0, [], []
        for g in grams:
            if filled == len(present):
                parts.append(present @ self.gram_weights)
                present[:] = 0
                filled = 0
            present[filled, _places(self.vocabulary, g)] = 1
            filled += 1
            sizes.append(max(len(g), 1))
        parts.append(present[:filled] @ self.gram_weights)
        root = np.sqrt(np.array(sizes, np.float64)).reshape(-1, 1)
        return np.round(np.concatenate(parts) / root, 6)  # single precision: the last digits depend on the block

    def scores(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, classes) ridge scores, and which documents have a letter; one text's n-grams at a time."""
        ok: list[bool] = []

        def each() -> Iterator[np.ndarray]:
            for t in texts:
                g = ngrams(t) if t else np.empty(0, np.int64)
                ok.append(len(g) > 0)
                yield g

        return self.score_grams(each()), np.array(ok, bool)


def _places(vocabulary: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Where those of ``grams`` that the vocabulary has stand in it."""
    at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
    return at[vocabulary[at] == grams]


def _rarity(id_col):
    """64 steps for each halving of the id's hash: n rows have about n / 2^(r / 64) of rarity r or more."""
    share = (F.shiftrightunsigned(F.xxhash64(id_col), 11) + 1) / float(1 << 53)
    return F.floor(F.log2(share) * -64)


def _cuts(counts: list, size: int) -> dict[str, int]:
    """label -> the least rarity in the sample, so that about ``size`` rows at most are in it."""
    held: dict[str, int] = {}
    out: dict[str, int] = {}
    for r in sorted(counts, key=lambda r: (r.label, -r.rarity)):
        held[r.label] = held.get(r.label, 0) + r["count"]
        if held[r.label] <= size or r.label not in out:
            out[r.label] = r.rarity
    return out


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_class: int = PER_CLASS, landmarks: int = LANDMARKS,
          ridge: float = RIDGE, max_classes: int = MAX_CLASSES) -> Model | None:
    """Fit on the labelled rows of ``docs``; None if there are none.

    The ``max_classes`` labels of most rows are learned (ties: the first in order).
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("label"),
                           _rarity(F.col(id_col)).alias("rarity"))
    common = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(max_classes).collect()
    if not common:
        return None
    names = [r.label for r in common]
    per_class = max(min(per_class, SAMPLE // len(names)), 2)
    landmarks = max(min(landmarks, ALL_LANDMARKS // len(names)), 1)
    rows = rows.where(F.col("label").isin(names))
    cuts = _cuts(rows.groupBy("label", "rarity").count().collect(), per_class)
    classes = sorted(cuts)
    cut = F.create_map(*(F.lit(x) for label in classes for x in (label, cuts[label])))
    picked = rows.where(F.col("rarity") >= cut[F.col("label")])
    sample = picked.select("label", "text", "id").dropDuplicates(["label", "id"]).repartition(8, "id").persist()
    try:
        def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = [ngrams(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64())),
                                                  batch.column(2)], names=["label", "grams", "id"])

        kind = sample.schema["id"].dataType.simpleString()
        table = sample.mapInArrow(lists, f"label string, grams array<long>, id {kind}").toArrow()
    finally:
        sample.unpersist()
    names, ids = table.column("label").to_pylist(), table.column("id").to_pylist()
    lists_ = [g.values.to_numpy() for g in table.column("grams")]
    order = sorted((k for k, g in enumerate(lists_) if len(g)), key=lambda k: (names[k], ids[k]))
    grams = [lists_[k] for k in order]
    if not grams:
        return None
    label = np.array([classes.index(names[k]) for k in order])
    held = np.arange(len(grams)) % HOLD == HOLD - 1  # in order of class and id: of each class alike
    probe = fit(classes, [g for g, h in zip(grams, held) if not h], label[~held], landmarks, ridge)
    model = fit(classes, grams, label, landmarks, ridge)
    model.cutoff = cutoff(probe, [g for g, h in zip(grams, held) if h])
    return model


def cutoff(model: Model, grams: list[np.ndarray]) -> float:
    """Half the best score that all but one in a hundred documents reach (0 without documents)."""
    if not grams:
        return 0.0
    best = np.sort(model.score_grams(grams).max(axis=1))
    return max(float(best[len(best) // 100]) / 2, 0.0)


def fit(classes: list[str], grams: list[np.ndarray], label: np.ndarray, landmarks: int, ridge: float) -> Model:
    """Nystroem kernel ridge regression on presence lists."""
    picks = np.concatenate([np.flatnonzero(label == c)[:landmarks] for c in range(len(classes))])
    vocabulary = np.unique(np.concatenate([grams[i] for i in picks]))

    marks = [np.searchsorted(vocabulary, grams[i]) for i in picks]
    # which landmarks have each n-gram of the vocabulary
    places = np.concatenate(marks)
    owner = np.repeat(np.arange(len(marks)), [len(m) for m in marks])[np.argsort(places, kind="stable")]
    times = np.bincount(places, minlength=len(vocabulary))
    begin = np.cumsum(times) - times
    root = np.sqrt([len(m) for m in marks])
    k_nm = np.empty((len(grams), len(picks)))
    for row, g in zip(k_nm, grams):
        at = _places(vocabulary, g)
        n = times[at]
        which = np.repeat(begin[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        row[:] = np.bincount(owner[which], minlength=len(picks)) / (root * np.sqrt(len(g)))
    k_mm = k_nm[picks]
    # rows are weighted so that every class counts the same
    size = np.maximum(np.bincount(label, minlength=len(classes)), 1)
    weight = (len(label) / len(classes) / size[label])[:, None]
    target = np.eye(len(classes))[label]
    left = k_nm.T @ (weight * k_nm) + ridge * k_mm + 1e-6 * np.eye(len(picks))
    weights = np.linalg.solve(left, k_nm.T @ (weight * target))
    return Model(classes, vocabulary, marks, weights)


def predict(spark: SparkSession, docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) per input row, from the text alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    if model is None:
        return docs.select(id_col, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_labels(sent.value, batch.column(1))[:2]],
                                             names=[id_col, "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def _labels(model: Model, column: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Label, share of the positive scores, and whether the text has a letter and a best score that reaches the cutoff."""
    raw, ok = model.scores(t for a, b in text_ranges(column) for t in column.slice(a, b - a).to_pylist())
    best = raw.argmax(axis=1)
    top = raw[np.arange(len(best)), best]
    share = np.clip(top, 0, None) / np.maximum(np.clip(raw, 0, None).sum(axis=1), 1e-12)
    names = [model.classes[b] if k else UNKNOWN for b, k in zip(best, ok)]
    return pa.array(names, pa.string()), pa.array(np.where(ok, share, 0.0)), ok & (top >= model.cutoff)


def keep_identified(spark: SparkSession, docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has no letter or whose best score is under the model's cutoff."""
    if model is None:
        return docs.limit(0)
    sent = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array(_labels(sent.value, batch.column(at))[2])
            for start, end in text_ranges(batch.column(at)):  # no copy of a whole batch's texts
                yield batch.slice(start, end - start).filter(ok.slice(start, end - start))

    return docs.mapInArrow(run, docs.schema)
