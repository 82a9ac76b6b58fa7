"""Dialogue repair: the parser against all edits, the query against a plain dynamic programme over strings."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF001
from hitlens.llm import dialogue, registry

DIALOGUE = re.compile(r"(s?(ua)+)?")
BLANK = set(" \t\n\x0b\f\r")


def faults(rows):
    """blank / duplicate / truncated / sound per (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        left = [c for c in text if c not in BLANK]
        out.append("blank" if not left else "duplicate" if (role, text) in seen else
                   "truncated" if left[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return out


def all_edits(rows):
    """(cost, audit, repaired) by trying every edit: for a few rows only."""
    marks = faults(rows)
    per_row = []
    for (role, text), mark in zip(rows, marks):
        options = [(4, "D", [])]
        if mark in ("sound", "truncated"):
            more = 3 if mark == "truncated" else 0
            options += [(more, "K", [(role, text)])] + [(3 + more, "R", [(r, text)]) for r in ("user", "assistant")]
        per_row.append(options)
    gap = [(3 * k, "I" * k, [(r, "") for r in roles])
           for k in range(4) for roles in itertools.product(("user", "assistant"), repeat=k)]
    gap = [g for g in gap if "uu" not in "".join(r[0] for r, _ in g[2]) and "aa" not in "".join(r[0] for r, _ in g[2])]
    best = None
    for choice in itertools.product(gap, *itertools.chain.from_iterable(zip(per_row, [gap] * len(rows)))):
        cost = sum(c for c, _, _ in choice)
        if best and cost > best[0]:
            continue
        turns = [t for _, _, ts in choice for t in ts]
        if DIALOGUE.fullmatch("".join(r[:1] or "-" for r, _ in turns)):
            item = cost, "".join(a for _, a, _ in choice), turns
            best = min(best, item) if best else item
    return best


def by_strings(rows):
    """The same by a shortest path over (symbols so far modulo what matters, row), with whole audits."""
    marks = faults(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserts(tops):
        tops = dict(tops)
        for _ in range(4):
            for state, (cost, audit, turns) in list(tops.items()):
                for role in ("user", "assistant"):
                    if new := after.get((state, role[0])):
                        item = cost + 3, audit + "I", [*turns, (role, "")]
                        if new not in tops or item[:2] < tops[new][:2]:
                            tops[new] = item
        return tops

    tops = {"": (0, "", [])}
    for (role, text), mark in zip(rows, marks):
        new_tops = {}
        for state, (cost, audit, turns) in inserts(tops).items():
            options = [(state, 4, "D", [])]
            if mark in ("sound", "truncated"):
                more = 3 if mark == "truncated" else 0
                options += [(after.get((state, r[:1])), c + more, e, [(r, text)])
                            for r, c, e in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R"))]
            for new, price, edit, turn in options:
                if new is not None:
                    item = cost + price, audit + edit, turns + turn
                    if new not in new_tops or item[:2] < new_tops[new][:2]:
                        new_tops[new] = item
        tops = new_tops
    return min(v for k, v in inserts(tops).items() if k in ("", "a"))


def parse(rows):
    """(cost, audit) by the operator's parser."""
    conversation, parser, seen = dialogue._Conversation(1, PARSER.start), PARSER, set()
    for k, ((role, text), mark) in enumerate(zip(rows, faults(rows))):
        fault = {"blank": dialogue.BLANK, "truncated": dialogue.CUT}.get(mark, dialogue.SOUND)
        conversation.add(parser, k, role, b"", 1, fault, (role, text) not in seen)
        seen.add((role, text))
    *segments, summary = conversation.rows(parser)
    return summary[-2], summary[-1]


PARSER = dialogue.Parser()
TEXTS = ["Yes.", "no", " ", "Why?"]


def test_parser_against_all_edits():
    roles = ["system", "user", "assistant", "tool"]
    r = random.Random(1)
    every = [list(x) for n in range(3) for x in itertools.product(itertools.product(roles, TEXTS[:3]), repeat=n)]
    longer = [[(r.choice(roles), r.choice(TEXTS)) for _ in range(3)] for _ in range(12)]
    for rows in r.sample(every, 100) + longer:
        assert parse(rows) == all_edits(rows)[:2] == by_strings(rows)[:2], rows


def test_parser_against_strings():
    r = random.Random(2)
    for _ in range(3000):
        n = r.randint(0, 30)
        roles = r.choice([["user", "assistant"], ["system", "user", "assistant", "tool"], ["assistant"], ["", " ", "user"]])
        rows = [(r.choice(roles), r.choice(TEXTS + [str(k) + "." for k in range(30)])) for _ in range(n)]
        assert parse(rows) == by_strings(rows)[:2], rows
    assert len(PARSER.frontiers) < 2000


def test_frontiers_stay_few_on_long_conversations():
    parser, r = dialogue.Parser(), random.Random(3)
    for _ in range(20):
        rows = [(r.choice(["user", "assistant", "system", "x"]), f"{k}{r.choice(['.', ''])}") for k in range(3000)]
        conversation = dialogue._Conversation(1, parser.start)
        for k, (role, text) in enumerate(rows):
            conversation.add(parser, k, role, b"", 1, dialogue.SOUND if text[-1] == "." else dialogue.CUT, True)
        conversation.rows(parser)
    assert len(parser.frontiers) < 2000 and all(len(f) <= 6 for f in parser.frontiers)


def expected(rows, damage=True):
    """Query rows by the plain programme; rows are (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        held = groups.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        held += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, held in groups.items():
        held.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
        turns = [t for t, _, _ in held if t is not None]
        pairs = [(r, x) for _, r, x in held]
        marks = faults(pairs)
        cost, audit, repaired = by_strings(pairs)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"),
                     marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    got = registry.op12_dialogue(spark, SF001)
    assert got.columns == COLUMNS
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == expected(rows)


def run(spark, rows, count=None):
    schema = "conv_id long, turn long, role string, text string, n long, conv string, kind string, digest string"
    frame = spark.createDataFrame([(*r, 1 if len(r) == 4 else r[4])[:5] + ("a", "b", "c") for r in rows], schema).repartition(4)
    done = dialogue.repair(spark, frame, count_col=count)
    texts = {r[0]: r[1] for r in dialogue.digests(done.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r[0]: (*r[1:], texts.get(r[0], empty)) for r in done.summary.select(COLUMNS[:-1]).collect()}, done


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "SEGMENT", 3)
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."),
            (2, 5, None, "x."), (2, None, "user", None), (2, 9, "user", "Hi"), (2, 9, "user", "Hi"), (2, 9, "assistant", "Yes."),
            (None, 0, "assistant", "a."), (None, 1, "assistant", "b."), (None, 1, "", "b."),
            (3, None, "user", " \n"), (4, 0, "user", "word " * 50_000)]
    rows += [(5, k, ["assistant", "user"][k % 2], f"t{k}.") for k in range(50)]
    rows += [(6, k // 2, "user", "same.") for k in range(20)]
    got, _ = run(spark, rows)
    assert got == expected(rows, damage=False)


def test_counted_rows_stand_for_equal_rows(spark):
    counted = [(1, 0, "user", "Hi.", 3), (1, 1, "assistant", "", 2), (1, 2, "assistant", "Yes.", 1), (2, 0, "user", "x", 0)]
    plain = [r[:4] for r in counted for _ in range(r[4])]
    got, done = run(spark, counted, "n")
    assert got == {**expected(plain, damage=False), 2: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    turns = [tuple(r) for r in done.turns.orderBy("conv_id", "pos").select("conv_id", "pos", "role", "text", "edit").collect()]
    assert turns == [(1, 0, "user", "Hi.", "K"), (1, 1, "assistant", "Yes.", "K")]


@pytest.mark.parametrize("rows", [[], [(7, 0, "user", "gone.", 0)]])
def test_nothing_left(spark, rows):
    got, done = run(spark, rows, "n")
    assert got == {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows}
    assert done.turns.collect() == []
