"""Toxicity by class-conditional Kneser-Ney models.

Words are lower-cased runs of letters.  Counts are Kneser-Ney's: not how often
a word occurs in a class but after how many different words, so that copied
texts do not raise them (raw bigram counts, tried first, separated far worse
for that reason).  Contexts are counted over all labelled training rows by
Spark, within two folds of the rows.

Each class model is an absolutely discounted distribution over words that
backs off to the word's stem (its first ``STEM`` letters) and from there to
counts that both classes share.  Words after fewer than ``support`` words of
the toxic class have no entry of their own: they are the stem's rare word, and
rare stems are one more, so expressions too rare to judge get the
likelihoods of the shared backoff.

A text's evidence is length-normalised: the mean of log P(word | toxic) -
log P(word | ordinary) over the whole text and over its one, three and six
strongest expressions.  Logistic regression over these and the log of the
length gives the score; it is fitted on at most ``CALIBRATION_ROWS`` training
rows, each scored by the model of the other fold, and fitted again without the
rows that the first fit contradicts almost surely (labels may be wrong).

The model has entries for all words and stems that the toxic class has.  They
are broadcast in slices by ranges of the stem's hash, of ``MOST_ENTRIES`` words
at most (more only where that many begin alike); driver and tasks hold one
slice at a time, so the number of slices grows with the input and scores do not
depend on it.  Labels are broadcast to the documents only below
``BROADCAST_LABELS`` rows, beyond that they are joined by shuffle.

Defined cases: NULL, empty and wordless texts have evidence 0 and a score; of
several labels of one id the toxic one holds; NULL labels and labels without a
document count for nothing; if either class has no training row every score is
0; repeated rows each get a row; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common

STEM, STEM_BITS = 4, 28
SUPPORT, MOST_ENTRIES = 1, 1 << 21
#: Slices begin and end with whole values of the hash's first bits.
BUCKET_BITS = 16
CALIBRATION_ROWS, BROADCAST_LABELS = 20_000, 1_000_000
CUT = 0.7
BLOCK_BYTES = 2_000_000
_WORD = re.compile(r"[^\W\d_]+")
_CLASSES = ("ordinary", "toxic")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_key(word: str) -> int:
    """The stem's hash in the upper bits, the word's in the lower."""
    stem = xxhash.xxh64_intdigest(word[:STEM].encode(), seed=5) >> (64 - STEM_BITS)
    return stem << (64 - STEM_BITS) | xxhash.xxh64_intdigest(word.encode(), seed=6) >> STEM_BITS


def _stems(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - STEM_BITS)


class _Keys(dict):
    def __missing__(self, word: str) -> int:
        self[word] = key = word_key(word)
        return key

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > 300_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# -------------------------------------------------------------------- counting

def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, toxic 0/1, fold 0/1, h) of the labelled documents."""
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")))
    if marks.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    return (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(marks, "__id")
            .select("text", (F.col("toxic") > 0).cast("int").alias("toxic"),
                    F.pmod(F.xxhash64(F.col("__id"), F.lit(1)), F.lit(2)).cast("int").alias("fold"),
                    F.xxhash64("__id").alias("h")))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (word key, class and fold with the hash of the word before) of each block of texts."""
    keys = _Keys()
    for batch in batches:
        texts = batch.column(0)
        group = batch.column(1).to_numpy() * 2 + batch.column(2).to_numpy()
        for a, b in common.chunks(common.text_bytes(texts), BLOCK_BYTES):
            parts = [words_of(t) for t in texts.slice(a, b - a).to_pylist()]
            key = [keys.of(w) for w in parts]
            before = [np.concatenate((np.zeros(1, np.uint64), k[:-1])) if len(k) else k for k in key]
            size = np.array([len(k) for k in key])
            key, before = np.concatenate([np.empty(0, np.uint64), *key]), np.concatenate([np.empty(0, np.uint64), *before])
            which = np.repeat(group[a:b], size).astype(np.uint64)
            context = which << np.uint64(62) | common.mix(before) >> np.uint64(2)
            order = np.lexsort((context, key))
            key, context = key[order], context[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (context[1:] != context[:-1])))[:len(key)]
            yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(context[new].view(np.int64))],
                                             names=["key", "context"])


def continuation_counts(rows: DataFrame) -> DataFrame:
    """(key, o0, o1, t0, t1): distinct contexts of each word by class and fold, over all rows."""
    pairs = rows.select("text", "toxic", "fold").mapInArrow(_contexts, "key long, context long").distinct()
    group = F.shiftrightunsigned("context", 62)
    return pairs.groupBy("key").agg(*(F.count_if(group == k).alias(name)
                                      for k, name in enumerate(("o0", "o1", "t0", "t1"))))


class Counts:
    """Words and stems of the toxic class, of which the driver holds one slice at a time, and totals."""

    def __init__(self, spark: SparkSession, table: DataFrame, support: int, most: int):
        stem = F.shiftrightunsigned("key", 64 - STEM_BITS)
        columns = ("o0", "o1", "t0", "t1")
        per_stem = table.groupBy(stem.alias("key")).agg(*(F.sum(c).alias(c) for c in columns))
        self.total = np.array(table.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in columns)).first(), np.int64)
        self.n_stems = per_stem.count()
        toxic = F.col("t0") + F.col("t1")
        self._tables = [rows.withColumn("bucket", F.shiftrightunsigned("key", bits - BUCKET_BITS).cast("int"))
                        for rows, bits in ((table.where(toxic >= support), 64), (per_stem.where(toxic >= 1), STEM_BITS))]
        sizes = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for size, rows in zip(sizes, self._tables):
            for r in rows.groupBy("bucket").count().collect():
                size[r.bucket] = r["count"]
        #: First bucket of each slice, and the end of the last.
        self.edges, held = [0], np.zeros(2, np.int64)
        for bucket in np.flatnonzero(sizes.any(axis=0)).tolist():
            if held.any() and (held + sizes[:, bucket]).max() > most:
                self.edges.append(bucket)
                held[:] = 0
            held += sizes[:, bucket]
        self.edges.append(1 << BUCKET_BITS)
        self._held = None
        self.load(0)

    def load(self, k: int) -> None:
        """Hold slice ``k``."""
        if k != self._held:
            self.words = self.stems = None
            self.words, self.stems = (self._sorted(rows, *self.edges[k:k + 2]) for rows in self._tables)
            self._held = k

    def slices(self) -> Iterator[int]:
        """Each slice, held while it is the current one; begins with the one that is held already."""
        for k in sorted(range(len(self.edges) - 1), key=lambda k: k != self._held):
            self.load(k)
            yield k

    @staticmethod
    def _sorted(table: DataFrame, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, counts) of the rows in buckets ``a`` to ``b``."""
        rows = (table.where((F.col("bucket") >= a) & (F.col("bucket") < b))
                .select("key", "o0", "o1", "t0", "t1").toArrow())
        key = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key)
        return key[order], np.stack([rows.column(c).to_numpy() for c in ("o0", "o1", "t0", "t1")], axis=1)[order]


# ---------------------------------------------------------------------- models

def _discounted(n: np.ndarray) -> np.ndarray:
    """Counts less their discount: 0.75 from ones, 1 from twos, 1.5 from more."""
    return n - np.select([n < 1, n < 2, n < 3], [0, 0.75, 1.0], 1.5)


class _Slice:
    """Counts by class (0, 1) of the slice that ``counts`` holds: of words, of stems' rare words, and of stems."""

    def __init__(self, counts: Counts, folds: tuple[int, ...], support: int):
        pick = lambda x, c: sum(x[..., c * 2 + f] for f in folds).astype(np.float64)
        word_keys, word_counts = counts.words
        self.stems, stem_counts = counts.stems
        own = pick(word_counts, 1) >= support
        self.words, word_counts = word_keys[own], word_counts[own]
        self.at = np.searchsorted(self.stems, _stems(self.words)) if len(self.stems) else np.zeros(0, int)
        self.known = [pick(word_counts, c) for c in (0, 1)]
        self.stem = [pick(stem_counts, c) for c in (0, 1)]
        self.total = [max(1.0, float(pick(counts.total, c))) for c in (0, 1)]
        self.rest = [np.maximum(s - np.bincount(self.at, k, len(s)), 0) for s, k in zip(self.stem, self.known)]

    def sums(self) -> np.ndarray:
        """For each class: events of words and of stems' rare words, events of stems, all of stems."""
        return np.array([[_discounted(self.known[c]).sum() + _discounted(self.rest[c]).sum(),
                          _discounted(self.stem[c]).sum(), self.stem[c].sum()] for c in (0, 1)])


def all_sums(counts: Counts, folds: tuple[int, ...], support: int) -> np.ndarray:
    return sum(_Slice(counts, folds, support).sums() for _ in counts.slices())


class Model:
    """Log-likelihood differences of words, of stems' rare words, and of rare stems' words: the slice held."""

    def __init__(self, counts: Counts, folds: tuple[int, ...], support: int, sums: np.ndarray | None = None):
        if sums is None:
            k = counts._held
            sums = all_sums(counts, folds, support)
            counts.load(k)
        part = _Slice(counts, folds, support)
        self.words, self.stems, at, known, rest, stem = part.words, part.stems, part.at, part.known, part.rest, part.stem
        total = part.total
        lost = [max(0.0, t - s) for t, s in zip(total, sums[:, 2].tolist())]  # words of rare stems
        shared_stem = stem[0] + stem[1] + 0.5
        shared_all = sum(total) + 0.5 * counts.n_stems
        shared_word, shared_rest = known[0] + known[1] + 0.5, rest[0] + rest[1] + 0.5
        within = shared_rest + np.bincount(at, shared_word, len(self.stems))
        logs = []
        for c in (0, 1):
            events = sums[c, 0] + max(0.0, lost[c] - 1.5)
            spare = max(1e-9, 1 - events / total[c])
            stem_spare = max(1e-9, 1 - (sums[c, 1] + max(0.0, lost[c] - 1.5)) / total[c])
            p_stem = _discounted(stem[c]) / total[c] + stem_spare * shared_stem / shared_all
            p_rare = max(0.0, lost[c] - 1.5) / total[c] + stem_spare * (sum(lost) + 0.5) / shared_all
            logs.append((np.log(_discounted(known[c]) / total[c] + spare * p_stem[at] * shared_word / within[at]),
                         np.log(_discounted(rest[c]) / total[c] + spare * p_stem * shared_rest / within),
                         np.log(p_rare)))
        self.word_llr, self.stem_llr, self.rare_llr = ((b - a).astype(np.float32) for a, b in zip(*logs))

    def values(self, keys: np.ndarray) -> np.ndarray:
        value = np.full(len(keys), float(self.rare_llr))
        for table, llr, key in ((self.stems, self.stem_llr, _stems(keys)), (self.words, self.word_llr, keys)):
            if len(table):
                at = np.minimum(np.searchsorted(table, key), len(table) - 1)
                hit = table[at] == key
                value[hit] = llr[at[hit]]
        return value


class Sliced:
    """The models of all slices, each broadcast on its own; a task that needs several holds one at a time."""

    def __init__(self, spark: SparkSession, counts: Counts, folds: tuple[int, ...], support: int):
        sums = all_sums(counts, folds, support)
        sent = {k: spark.sparkContext.broadcast(Model(counts, folds, support, sums)) for k in counts.slices()}
        self.parts = [sent[k] for k in sorted(sent)]
        self.starts = np.array(counts.edges[1:-1], np.uint64)
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def block_bytes(self) -> int:
        """Text to score at once: more where every block goes through several slices."""
        return BLOCK_BYTES * min(len(self.parts), 4)

    def learn(self, words: set[str]) -> None:
        if len(self._known) > 300_000:
            self._known.clear()
        new = [w for w in words if w not in self._known]
        keys = np.fromiter(map(word_key, new), np.uint64, len(new))
        part = np.searchsorted(self.starts, keys >> np.uint64(64 - BUCKET_BITS), "right")
        value = np.empty(len(new))
        for k in np.unique(part).tolist():
            value[part == k] = self.parts[k].value.values(keys[part == k])
            if len(self.parts) > 1:
                self.parts[k].__dict__.pop("_value", None)  # read again from the executor's copy when needed
        self._known.update(zip(new, value.tolist()))

    def evidence(self, parts: list[list[str]]) -> np.ndarray:
        """One row of features per text."""
        self.learn(set().union(*parts))
        out = np.zeros((len(parts), 5))
        for row, words in zip(out, parts):
            if words:
                v = np.fromiter(map(self._known.__getitem__, words), np.float64, len(words))
                top = -np.sort(-(np.partition(v, len(v) - 6)[-6:] if len(v) > 6 else v))
                top = np.concatenate((top, np.zeros(6 - len(top))))
                row[:] = v.mean(), top[0], top[:3].mean(), top.mean(), np.log1p(len(words))
        return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-5, steps: int = 60) -> tuple:
    """(mean, scale, weights) by Newton's method."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w, penalty = np.zeros(z.shape[1]), ridge * len(x) * np.eye(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + penalty, z.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return mean, scale, w


def fit_trimmed(x: np.ndarray, y: np.ndarray, contradicted: float = 0.9) -> tuple:
    """Logistic regression, then once more without the rows whose label has a probability under 1 - contradicted."""
    first = fit_logistic(x, y)
    keep = np.abs(y - probability(x, first)) < contradicted
    return fit_logistic(x[keep], y[keep]) if len(set(y[keep])) == 2 else first


def probability(x: np.ndarray, fitted: tuple) -> np.ndarray:
    mean, scale, w = fitted
    return 1 / (1 + np.exp(-np.clip(np.c_[(x - mean) / scale, np.ones(len(x))] @ w, -500, 500)))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", support: int = SUPPORT, most: int = MOST_ENTRIES):
    """(model, calibration), or None if either class has no row."""
    rows = training_rows(docs, labels, id_col, text_col, label_col)
    have = {r.toxic for r in rows.select("toxic").distinct().collect()}
    if have != {0, 1}:
        return None
    table = continuation_counts(rows).persist()
    counts = Counts(spark, table, support, most)
    by_fold = [Sliced(spark, counts, (1 - f,), support) for f in (0, 1)]

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, fold, h = (batch.column(k).to_numpy() for k in (1, 2, 3))
            for a, b in common.chunks(common.text_bytes(batch.column(0)), by_fold[0].block_bytes()):
                parts = [words_of(t) for t in batch.column(0).slice(a, b - a).to_pylist()]
                x = np.where((fold[a:b] == 0)[:, None], by_fold[0].evidence(parts), by_fold[1].evidence(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[a:b]), pa.array(toxic[a:b]), pa.array(list(x), pa.list_(pa.float64()))],
                    names=["h", "toxic", "x"])

    # ids alone tell which rows are scored
    last = rows.select("h").orderBy("h").limit(CALIBRATION_ROWS).agg(F.max("h")).first()[0]
    chosen = (rows.where(F.col("h") <= last).mapInArrow(evidence, "h long, toxic int, x array<double>")
              .orderBy("h", "x").limit(CALIBRATION_ROWS).collect())
    x, y = np.array([r.x for r in chosen]), np.array([r.toxic for r in chosen], float)
    for part in (p for model in by_fold for p in model.parts):
        part.destroy()
    model = Sliced(spark, counts, (0, 1), support)
    table.unpersist()
    return model, fit_trimmed(x, y)


def score(spark: SparkSession, docs: DataFrame, trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) per input row, from the text alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    if trained is None:
        return docs.select(id_col, F.lit(0.0).alias("score"))
    model, fitted = trained

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in common.chunks(common.text_bytes(batch.column(1)), model.block_bytes()):
                parts = [words_of(t) for t in batch.column(1).slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(probability(model.evidence(parts), fitted))],
                    names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")
