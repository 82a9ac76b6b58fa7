"""Quality rules with risk-controlled cutoffs.

Statistics of every whole text (words are runs of anything but 0x20 and
0x09-0x0D) are computed once and written; everything after that works on the
narrow table.  Base rules: under ``MIN_WORDS`` words, or over
``MAX_REPEAT_PERCENT`` per cent of the words in 8-word windows that the text
has twice.

Each further rule rejects a text whose rate exceeds a cutoff.  For each rule
and stratum (language) the cutoffs of ``GRID`` are tested from the loosest to
the strictest on the labelled good documents, copies of a text counted once:
a cutoff is certified if rejecting k of n good ones is so few that a false
rejection rate of ``risk / rules`` would give as few with a probability of at
most ``error / (rules * strata)`` (exact binomial tail).  The first cutoff that
fails ends the sequence, so the sequence needs no further correction and
Bonferroni covers rules and strata.  With probability 1 - error, every rule set
in use rejects at most ``risk`` of the good documents of each stratum.  Of the
certified cutoffs the one that rejects most labelled bad documents is used,
the loosest of equals; a rule that rejects none is not used there.

Strata with too few labels to certify anything have the base rules alone.

Defined cases: NULL, empty and blank texts have no words and fail the base
rule; a NULL language is a stratum of its own; of several labels of one id the
good one holds; NULL labels and labels without a document count for nothing;
rates of texts without words are 0; repeated rows each get a row; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common
from hitlens.session import shared_dir

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
RISK, ERROR = 0.05, 0.05
#: Cutoffs in per cent, the loosest first.
GRID = (90, 80, 70, 60, 50, 40, 35, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1)
#: Rule: (numerator, denominator) of its rate.
RATES = {
    "symbols": ("n_symbols", "word_chars"),
    "upper": ("n_upper", "n_letters"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")
#: Code-point classes.
_INK, _SYMBOL, _UPPER, _LETTER = 1, 2, 4, 8
_TABLE: np.ndarray | None = None
BLOCK_BYTES = 2_000_000


def _classes() -> np.ndarray:
    global _TABLE
    if _TABLE is None:
        table = np.full(0x110000, _INK, np.uint8)
        table[[0x20, *range(0x09, 0x0E)]] = 0
        table[[ord(c) for c in "#*$%&|<>"]] |= _SYMBOL
        for c in map(chr, range(0x110000)):
            if c.isalpha():
                table[ord(c)] |= _LETTER | (_UPPER if c.isupper() else 0)
        _TABLE = table
    return _TABLE


# ------------------------------------------------------------------ statistics

def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words per document that lie in a window which that document has twice or more."""
    n = max(0, len(ids) - REPEAT_WINDOW + 1)
    at = np.flatnonzero(doc[:n] == doc[REPEAT_WINDOW - 1:])
    if not len(at):
        return np.zeros(n_docs, np.int64)
    key = common.mix(common.rolling(ids, REPEAT_WINDOW)[at]) + common.mix(doc[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    first = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
    same = doc[first] == doc[at]
    for j in range(REPEAT_WINDOW):  # equal keys are compared word by word
        same &= ids[first + j] == ids[at + j]
    twice = np.zeros(len(at), bool)
    twice[1:] = ~new[1:] & same[1:]
    twice[:-1] |= twice[1:] & ~new[1:]  # the first one too
    step = np.zeros(len(ids) + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + REPEAT_WINDOW, -1)
    return np.bincount(doc, np.cumsum(step[:-1]) > 0, n_docs).astype(np.int64)


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier line."""
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            n += 1
            seen.add(line)
    return n, n - len(seen)


def text_stats(texts: list[bytes | None], hashes: common.WordHash) -> list[np.ndarray]:
    """The columns of ``STATS`` for some texts."""
    texts = [t or b"" for t in texts]
    words = [t.split() for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    doc = np.repeat(np.arange(len(words)), n_words)
    ids = np.concatenate([np.empty(0, np.uint64), *map(hashes.of, words)])
    codes = np.frombuffer((b"\n".join(texts) + b"\n").decode().encode("utf-32-le"), np.uint32)
    size = np.fromiter((len(t.decode()) + 1 for t in texts), np.int64, len(texts))
    flags = _classes()[codes]
    start = np.cumsum(size) - size
    ink, symbol, upper, letter = (np.add.reduceat((flags & f) > 0, start, dtype=np.int64)
                                  for f in (_INK, _SYMBOL, _UPPER, _LETTER))
    lines = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 2)
    return [n_words, ink, symbol, lines[:, 1], repeated_words(ids, doc, len(texts)), lines[:, 0], upper, letter]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, h, STATS) per row; h is the text's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = common.WordHash(seed=3)
        for batch in batches:
            texts = common.text_bytes(batch.column(3))
            for a, b in common.chunks(texts, BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(a, b - a) for k in range(3)]
                    + [pa.array(c) for c in text_stats(texts[a:b], hashes)], names=["id", "stratum", "h", *STATS])

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                         F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {kind}, stratum string, h long, " + ", ".join(f"{c} long" for c in STATS))


# --------------------------------------------------------------------- cutoffs

def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n), each with probability p; exact sum of the terms."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def exceeded(rule: str):
    """How many cutoffs of the grid the row's rate exceeds (each looser one is exceeded too last)."""
    top, bottom = RATES[rule]
    over = [F.when(100 * F.col(top) > F.lit(g) * F.col(bottom), 1).otherwise(0) for g in GRID]
    return sum(over[1:], over[0])


def labelled_counts(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> list:
    """Rows (stratum, rule, good, level, n): distinct labelled texts by the number of cutoffs they exceed."""
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg((F.max(F.col(label_col).cast("int")) > 0).alias("good")))
    rows = stats.join(marks, "id").dropDuplicates(["stratum", "h", "good"])
    levels = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), exceeded(r).alias("level")) for r in RATES)))
    return (rows.select("stratum", "good", levels.alias("x")).groupBy("stratum", "good", "x.rule", "x.level")
            .agg(F.count("*").alias("n")).collect())


def certify(counts: list, risk: float = RISK, error: float = ERROR) -> dict[tuple[str, str], int]:
    """(stratum, rule) -> cutoff in per cent, from ``labelled_counts`` rows."""
    table: dict[tuple[str, str, bool], np.ndarray] = {}
    for r in counts:
        levels = table.setdefault((r.stratum, r.rule, r.good), np.zeros(len(GRID) + 1, np.int64))
        levels[r.level] += r.n
    strata = sorted({s for s, _, good in table if good})
    if not strata:
        return {}
    least, share = error / (len(RATES) * len(strata)), risk / len(RATES)
    none = np.zeros(len(GRID) + 1, np.int64)
    out = {}
    for s in strata:
        for rule in RATES:
            good, bad = table.get((s, rule, True), none), table.get((s, rule, False), none)
            n, best = int(good.sum()), (0, None)
            for k, cutoff in enumerate(GRID):
                # a rate that exceeds GRID[k] exceeds all stricter cutoffs: len(GRID) - k of them
                need = len(GRID) - k
                if binomial_tail(int(good[need:].sum()), n, share) > least:
                    break
                caught = int(bad[need:].sum())
                if caught > best[0]:
                    best = (caught, cutoff)
            if best[1] is not None:
                out[s, rule] = best[1]
    return out


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          stratum_col: str = "lang", label_col: str = "quality", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(id_col, STATS, base_failed, kept, failed_rules) per input row."""
    path = shared_dir(spark, "quality")
    statistics(docs, id_col, text_col, stratum_col).write.parquet(path)
    stats = spark.read.parquet(path)
    cutoffs = certify(labelled_counts(stats, labels, id_col, label_col), risk, error)
    failed = [F.when((F.col("stratum") == s) & (100 * F.col(RATES[r][0]) > cut * F.col(RATES[r][1])), F.lit(r))
              for (s, r), cut in sorted(cutoffs.items())]
    words = F.col("n_words")
    base = (words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words)
    rules = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return stats.select(F.col("id").alias(id_col), *STATS, base.alias("base_failed"), rules.alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
