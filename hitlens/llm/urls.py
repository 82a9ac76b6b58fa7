"""URL filter: host and path rules first, logistic regression for the rest.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.  A rule fits its
host and all subdomains if the path starts with the rule's path; the longest
rule that fits decides (of equally long ones a block).

Other URLs are scored by logistic regression on hashed character n-grams
(``ORDERS``) of the host and of the path, each with marks at both ends and a
name space of its own.  It is fitted on the driver, on a small labelled URL
table (at most ``MOST_LABELLED`` rows), and broadcast: ``BUCKETS`` weights.
The built-in table is made by a rule from words of either kind; a word that it
lacks is judged by the n-grams it shares with those.
A URL is blocked from a probability of ``CUT`` on.

Defined cases: NULL URLs and those without ``://`` have an empty host and path
and are allowed; so is one with an empty host; if the labelled table lacks
either label everything without a rule is allowed; NULLs in it count for
nothing; repeated rows each get a row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS, BUCKETS, CUT, MOST_LABELLED = (3, 4, 5), 1 << 15, 0.5, 5_000
GRAM_BUCKETS = 1 << 11
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path) rules of the contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# A small labelled URL table.  Words that addresses of unwanted kinds have in them, by kind:
_BLOCKED = """casino poker roulette slots jackpot blackjack bingo lottery betting bets bet gamble gambling wager bookie
porn xxx sex sexy nude adult escort hentai erotic camgirls webcams hookup milf fetish
viagra cialis pharmacy pills steroids slimming
payday moneyfast quickcash fastloan creditfix
warez keygen cracked torrent pirate nulled serial
replica fakewatch knockoff phishing malware spamlinks adserver tracker popup linkfarm clickbait""".split()
# Ordinary ones, among them names that share letters with those above:
_ALLOWED = """news weather library science garden history museum maths travel diary recipes music school sports university
press health advice photo album books review docs energy data language course daily paper river bird chess public
records film archive theatre hall enterprise station north south house nation city town bank market shop store
car bicycle train plane hotel hiking camera phone computer software cloud forum wiki blog mail search maps social
linked links network freedom freeware open source code math physics chemistry biology medicine doctor hospital
cash cashew cashier mere cashier merchant loan loans lending finance insurance tax law court police
spade spanish spain spanner antispam spamfilter ham haus pillow pillar pill pillsworth bury canterbury alphabet bethany better
essex sussex middlesex sextant unisex casing cassette pokemon poke slotted bingley creditunion pharmacology
trackfield advert adventure adult-education link serialize torrential piracy-law cracker escortservice-history""".split()
#: What addresses of either kind have around the word.
_BEFORE = ("", "", "", "my", "the", "best", "free", "online-", "top", "e", "go-", "super")
_AFTER = ("", "", "", "365", "24", "online", "-world", "hub", "zone", "s", "-club", "land", "site", "world")
_TLD = ("com", "net", "org", "io", "co.uk", "de", "fr", "info", "example.com", "example.net", "example.org", "biz")
_SYLLABLES = "ba co de fi go hu ja ke li mo nu pa qui ro si ta ul ve wi xe yo za an en in on th st er tion ble".split()
_OFFICIAL = ("gov", "edu", "ac.uk", "gov.uk")
_SUB = ("", "", "www.", "www.", "m.", "blog.", "shop.")
#: Addresses of each word.
_EACH = 10


def labelled_urls(spark: SparkSession, part: str = "all") -> DataFrame:
    """(url, label): the words above within host names of many forms, half of them with paths and numbers.

    ``part`` takes the addresses but every fifth of a word (``train``), those (``held_out``) or ``all``.
    """
    rows = []
    for label, words in (("block", _BLOCKED), ("allow", _ALLOWED)):
        for word in dict.fromkeys(words):
            r = random.Random(f"{label} {word}")
            for n in range(_EACH):
                end = r.choice(_OFFICIAL) if label == "allow" and n % 4 == 3 else r.choice(_TLD)
                name = word if n == 0 else r.choice(_BEFORE) + word + r.choice(_AFTER)
                path = r.choice(("", "/", f"/{r.randint(1, 999)}", f"/page/{r.randint(1, 99)}.html", f"/en/{r.randint(1, 9999)}"))
                url = f"https://{r.choice(_SUB)}{name}.{end}{path}"
                if part == "all" or (part == "held_out") == (n % 5 == 4):
                    rows.append((url, label))
            # names that no word explains are ordinary
            if label == "allow" and part != "held_out":
                rows.append((f"http://{r.choice(_SUB)}{''.join(r.choice(_SYLLABLES) for _ in range(r.randint(2, 4)))}."
                             f"{r.choice(_TLD)}/{r.randint(1, 999)}", label))
    return spark.createDataFrame(rows, "url string, label string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The deciding rule as text and its verdict; both NULL if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the last one set wins, so the longest comes last
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def features(host: str, path: str) -> np.ndarray:
    """Sorted distinct buckets of the n-grams."""
    digest, out = xxhash.xxh32_intdigest, set()
    for space, part in (("h", host), ("p", path)):
        text = f"^{part}$"
        for n in ORDERS:
            out.update(digest(space + text[i:i + n]) % BUCKETS for i in range(len(text) - n + 1))
    return np.array(sorted(out), np.int64)


def fit(rows: list[np.ndarray], y: np.ndarray, ridge: float = 2e-6, steps: int = 100) -> np.ndarray | None:
    """Weights and a bias (last); Newton's method in the span of the rows.  None without both labels."""
    if len(set(y.tolist())) < 2:
        return None
    unit = [1 / np.sqrt(max(1, len(f))) for f in rows]
    gram, a = np.ones((len(rows), len(rows))), np.zeros(len(rows))  # ones: the bias
    often = np.bincount(np.concatenate(rows), minlength=BUCKETS) > 1
    column = np.cumsum(often) - 1  # of the buckets that rows share; the others count for their own row alone
    for start in range(0, int(often.sum()), GRAM_BUCKETS):  # only so many columns of the rows are held at a time
        x = np.zeros((len(rows), GRAM_BUCKETS))
        for k, f in enumerate(rows):
            at = column[f[often[f]]] - start
            x[k, at[(at >= 0) & (at < GRAM_BUCKETS)]] = unit[k]
        gram += x @ x.T
    gram[np.diag_indices(len(rows))] += [u * u * np.count_nonzero(~often[f]) for u, f in zip(unit, rows)]
    for _ in range(steps):  # w = x' a; the gradient is x' (y - p - ridge n a)
        p = 1 / (1 + np.exp(-gram @ a))
        pull = y - p - ridge * len(rows) * a
        step = np.linalg.solve((p * (1 - p))[:, None] * gram + ridge * len(rows) * np.eye(len(rows)), pull)
        a += step
        if np.abs(step).max() < 1e-7:
            break
    w = np.append(np.zeros(BUCKETS), a.sum())
    for f, u, v in zip(rows, unit, a.tolist()):
        w[f] += u * v
    return w


def train(spark: SparkSession, labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> np.ndarray | None:
    host, path = host_and_path(F.col(url_col))
    rows = (labelled.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull())
            .select(host.alias("host"), path.alias("path"), (F.col(label_col) == "block").alias("bad"))
            .distinct().limit(MOST_LABELLED + 1).collect())
    if len(rows) > MOST_LABELLED:
        raise ValueError(f"the labelled URL table has over {MOST_LABELLED} rows")
    rows.sort()
    return fit([features(r.host, r.path) for r in rows], np.array([float(r.bad) for r in rows])) if rows else None


def judge(spark: SparkSession, pages: DataFrame, weights: np.ndarray | None, rules=RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, score, verdict) per input row; score is the probability of a block."""
    kind = pages.schema[id_col].dataType.simpleString()
    host, path = host_and_path(F.col(url_col))
    rule, verdict = rule_of(host, path, rules)
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("said"))
    sent = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            score = np.zeros(len(batch))
            if w is not None:
                for k, (h, p) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                    if h:
                        f = features(h, p)
                        score[k] = 1 / (1 + np.exp(-(w[f].sum() / np.sqrt(len(f)) + w[-1])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[id_col, "host", "path", "rule", "said", "score"])

    scored = parsed.mapInArrow(run, f"`{id_col}` {kind}, host string, path string, rule string, said string, score double")
    verdict = F.coalesce("said", F.when(F.col("score") >= CUT, "block").otherwise("allow"))
    return scored.select(id_col, "host", "path", "rule", "score", verdict.alias("verdict"))
