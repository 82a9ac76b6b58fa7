"""Quality rules: statistics against brute force, exact bounds, guarantee, edge cases."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import Row

from conftest import SF01
from hitlens.llm import common, quality, registry


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n")]
    seen, dup = set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
        seen.add(x)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            hit |= set(range(i, i + 8))
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)]


def test_statistics_of_random_texts():
    r = random.Random(4)
    texts = ["".join(r.choice("ab É#|\n\t 🙂<") for _ in range(r.randint(0, 200))) for _ in range(60)]
    texts += [" ".join(r.choice("ab") for _ in range(r.randint(0, 80))) for _ in range(60)]
    texts += [None, "", "\n\n", "a\na\n a\na", "x " * 5000, "one two three four five six seven eight " * 2]
    got = quality.text_stats([t.encode() if t else t for t in texts], common.WordHash(3))
    for i, t in enumerate(texts):
        assert [int(c[i]) for c in got[:5]] == slow(t), t


def test_registered_query_equals_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = registry.op3_quality(spark, SF01).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        want = slow(docs[r.doc_id].text)
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def test_binomial_tail_is_exact():
    for k, n, p in ((0, 10, Fraction(1, 50)), (3, 200, Fraction(1, 80)), (7, 7, Fraction(1, 2)), (20, 900, Fraction(1, 40))):
        want = sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, float(p)) == pytest.approx(float(want), rel=1e-9)


def row(stratum, rule, good, level, n):
    return Row(stratum=stratum, rule=rule, good=good, level=level, n=n)


def test_certified_cutoffs():
    # "a": every good text is under all cutoffs, bad ones are over 20 %; "b": too few labels
    over20 = len(quality.GRID) - quality.GRID.index(20)
    counts = [row("a", "upper", True, 0, 3000), row("a", "upper", False, over20, 9), row("b", "upper", True, 0, 50),
              row("b", "upper", False, over20, 9)]
    assert quality.certify(counts) == {("a", "upper"): 20}
    # 4 % of the good texts are over 40 %: the sequence stops before
    over40 = len(quality.GRID) - quality.GRID.index(40)
    assert quality.certify([*counts, row("a", "upper", True, over40, 125)]) == {}
    assert quality.certify([*counts, row("a", "upper", True, over40, 125), row("a", "upper", False, over40 + 3, 2)]) \
        == {("a", "upper"): quality.GRID[quality.GRID.index(40) - 3]}
    assert quality.certify([]) == {}


def test_false_rejections_stay_under_the_risk():
    """Over many draws the guarantee fails in no more than the stated share."""
    r = random.Random(6)
    fails = 0
    for _ in range(120):
        rate = {g: 0.04 / (1 + k) for k, g in enumerate(reversed(quality.GRID))}  # the stricter, the more good ones go
        good = Counter()
        for _ in range(700):
            u = r.random()
            good[sum(u < rate[g] for g in quality.GRID)] += 1
        counts = [row("a", "upper", True, k, n) for k, n in good.items()] + [row("a", "upper", False, len(quality.GRID) - i, 5)
                                                                          for i in range(len(quality.GRID))]
        for cut in quality.certify(counts).values():
            fails += rate[cut] > quality.RISK / len(quality.RATES)
    assert fails <= 120 * quality.ERROR


def test_edge_cases(spark):
    clean = [(i, " ".join(f"word{(i * 7 + j) % 97}{chr(97 + i % 26)}{i}" for j in range(30)), "en") for i in range(1600)]
    shout = [(5000 + i, " ".join(f"LOUD{(i + j) % 89}X{i}" for j in range(30)), "en") for i in range(40)]
    odd = [(9000, None, "en"), (9001, "", None), (9002, "A B " * 30000, "fr"), (9003, " \n", "en"), (9003, " \n", "en"),
           (None, clean[0][1], None), (9004, shout[0][1] + " MORE", "en"), (9005, shout[0][1], None)]
    df = spark.createDataFrame([(*x, 1, "y") for x in clean + shout + odd],
                               "doc_id long, text string, lang string, n_words long, stratum string")
    labels = spark.createDataFrame([(d, 1, "z") for d, _, _ in clean] + [(d, 0, "z") for d, _, _ in shout]
                                   + [(1, 0, "z"), (5, None, "z"), (None, 0, "z"), (77777, 0, "z")],
                                   "doc_id long, quality int, text string")
    rows = quality.judge(spark, df, labels).collect()
    assert len(rows) == 1600 + 40 + 8
    by = {r.doc_id: r for r in rows}
    assert all(by[d].kept for d, _, _ in clean) and not any(by[d].kept for d, _, _ in shout)
    assert by[5000].failed_rules == ["upper"] and not by[9004].kept and not by[9004].base_failed
    assert all(by[d].base_failed for d in (9000, 9001, 9002, 9003)) and by[None].kept and by[9005].kept
    only = quality.judge(spark, df, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in only)
    assert quality.judge(spark, df.limit(0), labels).collect() == []
