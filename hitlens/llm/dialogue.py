"""Conversation structure repair by generalised LR parsing of the roles.

A dialogue is nothing, or maybe a system turn and then pairs of user and
assistant turns: role initials ``(s?(ua)+)?``.  ``repair`` finds for every
conversation the cheapest edits that make it one: keep (K, 0), change the role to
user or assistant (R, 3), delete (D, 4), insert an empty user or assistant turn (I,
3).  Blank turns and repeats of a turn must go; a truncated turn that stays
costs 3 more.  Of equally cheap edits those win whose initials, in order, come
first in ASCII.

Parsing.  The tables of the grammar's LR automaton drive a graph-structured
stack: every way to edit the turns so far ends in a stack top, tops share what
lies below, and inserting, keeping, changing and deleting shift symbols with
their costs.  Equal tops are merged, and the smaller (cost, audit) stays.
Audits are not held but ranked: at the end of a turn two audits of equal cost are
equal or differ before either ends, so their order is a small number that the
next turn refines.  Costs are kept relative to the cheapest top, and a top
more than ``FAR`` above it cannot win any more, so there are few frontiers; each
step from one is computed once and looked up afterwards.

Scale.  Equal rows (same conversation, turn, role and text) are added up first and
repeats of a turn are told by the first place of each (conversation, role, text),
both with partial aggregation, so neither a row nor a turn that is repeated very
often meets in one task.  Parsing sees turn numbers, digests and faults, never texts.  It
streams a conversation's rows in order and holds four bytes of each, since the
audit is one value of that length; decisions go on in segments, and a second
streaming pass puts them to the texts.

Defined cases: a NULL role or text is one space; rows of one turn are ordered by
role, then by their text's digest; rows without a turn come first; rows without
a conversation id are a conversation of their own; a conversation without rows
is whole already; an empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hitlens.session import shared_dir

#: ASCII white space, and the marks that end a whole turn.
BLANKS, ENDS = " \t\n\x0b\f\r", (".", "!", "?")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: Faults of a turn.
SOUND, BLANK, CUT = 0, 1, 2

# The LR automaton of   Dialogue -> (nothing) | Turns | s Turns     Turns -> u a | Turns u a
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
#: Complete right-hand sides of Turns: how many symbols they pop; then where Turns leads from the state below.
REDUCE = {5: 2, 7: 3}
GOTO = {0: 3, 1: 4}
#: States in which the input may end: nothing, Turns, s Turns.
ACCEPT = (0, 3, 4)
#: From the cheapest top two inserts (6) and deleting a system turn (4) lead wherever another top leads.
FAR = 10

#: A decision on one row is a byte: the turns inserted before it, then what happens to it.
INSERTS = ["", "u", "a", "ua", "au", "uau", "aua", "uaua", "auau"]
EDITS = ["K", "Ru", "Ra", "D"]
LAST = 0x80
SEGMENT, ROWS_OUT = 1 << 16, 4096


def push(stack: tuple, symbol: str) -> tuple | None:
    """The stack (state, stack below) after a symbol and the reductions that follow; None if it may not come."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        below = stack
        for _ in range(REDUCE[stack[0]]):
            below = below[1]
        stack = (GOTO[below[0]], below)
    return stack


class Parser:
    """Frontiers of the graph-structured stack and the steps between them, computed when first met.

    A frontier is a tuple of (stack, cost above the cheapest, rank of the audit), one per stack top.  A row is
    (role initial or "-", fault, must be deleted).
    """

    def __init__(self):
        self.frontiers: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.moves: list[tuple] = []
        self.steps: dict[tuple, tuple[int, int, int]] = {}
        self.start = self._number((((0, None), 0, 0),))

    def _number(self, frontier: tuple) -> int:
        if frontier not in self.numbers:
            self.numbers[frontier] = len(self.frontiers)
            self.frontiers.append(frontier)
        return self.numbers[frontier]

    def _inserted(self, frontier: tuple) -> list[tuple]:
        """(cost, rank, tail of the audit, symbols, stack, top it comes from): the best for each top after inserts."""
        heap = [(cost, rank, "", "", i, stack) for i, (stack, cost, rank) in enumerate(frontier)]
        heapq.heapify(heap)
        best: dict[int, tuple] = {}
        while heap:
            cost, rank, tail, symbols, i, stack = heapq.heappop(heap)
            if stack[0] in best:
                continue
            best[stack[0]] = (cost, rank, tail, symbols, stack, i)
            for symbol in "ua":
                if symbols + symbol in INSERTS and (longer := push(stack, symbol)):
                    heapq.heappush(heap, (cost + INSERT, rank, tail + "I", symbols + symbol, i, longer))
        return list(best.values())

    def step(self, number: int, row: tuple[str, int, bool]) -> tuple[int, int, int]:
        """(next frontier, what the cheapest top's cost rises by, moves); moves give for each new top the one it
        comes from and the decision."""
        key = (number, row)
        if key in self.steps:
            return self.steps[key]
        initial, fault, must_go = row
        more = TRUNCATED if fault == CUT else 0
        edits = [("D", None, DELETE)]
        if not must_go:
            edits += [("K", initial, KEEP + more), ("Ru", "u", REROLE + more), ("Ra", "a", REROLE + more)]
        found: dict[int, tuple] = {}
        for cost, rank, tail, symbols, stack, i in self._inserted(self.frontiers[number]):
            for edit, symbol, price in edits:
                after = push(stack, symbol) if symbol else stack
                if after is None:
                    continue
                code = INSERTS.index(symbols) * len(EDITS) + EDITS.index(edit)
                item = (cost + price, rank, tail + edit[0], code, i, after)
                if after[0] not in found or item < found[after[0]]:
                    found[after[0]] = item
        least = min(item[0] for item in found.values())
        tops = [found[s] for s in sorted(found) if found[s][0] <= least + FAR]
        audits = sorted({(rank, tail) for _, rank, tail, *_ in tops})
        frontier = tuple((after, cost - least, audits.index((rank, tail))) for cost, rank, tail, _, _, after in tops)
        self.moves.append(tuple((i, code) for _, _, _, code, i, _ in tops))
        self.steps[key] = self._number(frontier), least, len(self.moves) - 1
        return self.steps[key]

    def end(self, number: int, history: array) -> tuple[int, bytes]:
        """(cost above the cheapest top, decisions): the cheapest audit, followed back through the moves."""
        cost, _, _, symbols, _, top = min(x for x in self._inserted(self.frontiers[number]) if x[4][0] in ACCEPT)
        codes = bytearray([LAST | INSERTS.index(symbols)])
        for moves in reversed(history):
            top, code = self.moves[moves][top]
            codes.append(code)
        codes.reverse()
        return cost, bytes(codes)


_AUDIT = ["I" * len(symbols) + edit[0] for symbols in INSERTS for edit in EDITS]


def audit(codes: bytes) -> str:
    """Initials of the edits, in order."""
    return "".join(map(_AUDIT.__getitem__, codes[:-1])) + "I" * len(INSERTS[codes[-1] & ~LAST]) if codes else ""


class Repaired(NamedTuple):
    """``summary``: a row per conversation (gaps, blank, duplicate, truncated, illegal, cost, audit).  ``turns``: the
    repaired dialogue, (conversation, pos, turn, role, text, edit); a conversation is in one partition, in order."""
    summary: DataFrame
    turns: DataFrame


class _Conversation:
    """What is held of a conversation while its rows go by."""

    def __init__(self, conv, start: int):
        self.conv, self.frontier, self.cost, self.history = conv, start, 0, array("I")
        self.first = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.segments: list[tuple] = []

    def add(self, parser: Parser, turn, role: str, digest: bytes, n: int, fault: int, is_first: bool) -> None:
        if not self.segments or len(self.history) - self.segments[-1][0] >= SEGMENT:
            self.segments.append((len(self.history), turn, role, digest))
        if turn is not None and turn != self.last:
            self.distinct += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.illegal += n - 1       # equal initials side by side
        self.initial = initial
        repeats = n if fault == BLANK else n - is_first
        self.blank += n if fault == BLANK else 0
        self.duplicate += 0 if fault == BLANK else repeats
        self.truncated += fault == CUT and n > repeats
        sound = (initial if initial in ("s", "u", "a") else "-", fault, False)
        gone = ("-", SOUND, True)
        for k in range(n):
            self.frontier, rise, moves = parser.step(self.frontier, gone if k >= n - repeats else sound)
            self.cost += rise
            self.history.append(moves)

    def rows(self, parser: Parser) -> list[tuple]:
        cost, codes = parser.end(self.frontier, self.history) if self.history else (0, b"")
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        starts = [s[0] for s in self.segments[1:]] + [len(codes)]
        out = [(1, self.conv, turn, role, digest, codes[a:b], *[None] * 7)
               for (a, turn, role, digest), b in zip(self.segments, starts)]
        out.append((0, self.conv, None, None, None, None, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                    self.cost + cost, audit(codes)))
        return out


def _batches(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Record batches of ``ROWS_OUT`` rows or about 4 MB."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row)
        if len(held) >= ROWS_OUT or weight > 4_000_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], steps: int = 2048) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, steps):
            yield from zip(*(c.slice(at, steps).to_pylist() for c in batch.columns))


def _parse(conv_type: pa.DataType):
    schema = pa.schema([("part", pa.int32()), ("conv", conv_type), ("turn", pa.int64()), ("role", pa.string()),
                        ("digest", pa.binary()), ("codes", pa.binary()),
                        *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                        ("audit", pa.string())])

    def parsed(rows: Iterator[tuple]) -> Iterator[tuple]:
        parser, held, first = Parser(), None, None
        for conv, turn, role, digest, kind, n, fault in rows:
            if held is None or conv != held.conv:
                if held:
                    yield from held.rows(parser)
                held, first = _Conversation(conv, parser.start), None
            if kind == 0:
                first = turn, role, digest
            elif n:
                held.add(parser, turn, role, digest, n, fault, first == (turn, role, digest))
        if held:
            yield from held.rows(parser)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(parsed(_rows(batches)), schema, lambda row: len(row[5] or "") + len(row[-1] or ""))
    return run


def _apply(conv_type: pa.DataType):
    schema = pa.schema([("conv", conv_type), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("edit", pa.string())])

    def repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
        codes, at, pos, now = b"", 0, 0, None

        def inserted(symbols: str):
            nonlocal pos
            for symbol in symbols:
                yield now, pos, None, ROLES[symbol], "", "I"
                pos += 1

        def ended():
            if at < len(codes):
                yield from inserted(INSERTS[codes[at] & ~LAST])

        fresh = True
        for conv, turn, role, _, kind, n, text, segment in rows:
            if fresh or conv != now:
                yield from ended()
                codes, at, pos, now, fresh = b"", 0, 0, conv, False
            if kind == 0:
                codes, at = segment, 0
                continue
            for code in codes[at:at + n]:
                before, edit = divmod(code, len(EDITS))
                yield from inserted(INSERTS[before])
                edit = EDITS[edit]
                if edit != "D":
                    yield now, pos, turn, ROLES[edit[1]] if edit[0] == "R" else role, text, edit[0]
                    pos += 1
            at += n
        yield from ended()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(repaired(_rows(batches, 256)), schema, lambda row: len(row[4]))
    return run


def repair(spark: SparkSession, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text", count_col: str | None = None) -> Repaired:
    """Repair every conversation; ``count_col`` says how many equal rows a row stands for (0: none, but its
    conversation is there)."""
    folder = shared_dir(spark, "dialogue")
    space = F.lit(" ")
    n = F.col(count_col).cast("long") if count_col else F.lit(1).cast("long")
    (turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                  F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
                  n.alias("n"))
     .groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
     .withColumn("digest", F.unhex(F.sha2("text", 256)))
     .write.parquet(f"{folder}/rows"))
    rows = spark.read.parquet(f"{folder}/rows")

    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = (F.when(trimmed == "", BLANK).when(F.right(trimmed, F.lit(1)).isin(*ENDS), SOUND).otherwise(CUT))
    light = rows.select("conv", "turn", "role", "digest", F.lit(1).alias("kind"), "n", fault.alias("fault"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = (light.where(F.col("n") > 0).groupBy("conv", "role", "digest").agg(F.min(place).alias("place"))
              .select("conv", "place.turn", "role", "digest", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"),
                      F.lit(SOUND).alias("fault")))
    conv_type = to_arrow_type(turns.schema[conv_col].dataType)
    kind = turns.schema[conv_col].dataType.simpleString()
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "kind")]
    (light.unionByName(firsts).repartition("conv").sortWithinPartitions(*order)
     .mapInArrow(_parse(conv_type), f"part int, conv {kind}, turn long, role string, digest binary, codes binary, "
                 "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")
     .write.partitionBy("part").parquet(f"{folder}/parsed"))
    parsed = spark.read.schema(
        f"conv {kind}, turn long, role string, digest binary, codes binary, gaps long, blank long, duplicate long, "
        "truncated long, illegal long, cost long, audit string, part int").parquet(f"{folder}/parsed")

    summary = parsed.where("part = 0").select(F.col("conv").alias(conv_col), "gaps", "blank", "duplicate", "truncated",
                                              "illegal", "cost", "audit")
    segments = parsed.where("part = 1").select(
        "conv", "turn", "role", "digest", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("n"),
        F.lit(None).cast("string").alias("text"), "codes")
    whole = rows.select("conv", "turn", "role", "digest", F.lit(1).alias("kind"), "n", "text",
                        F.lit(None).cast("binary").alias("codes"))
    fixed = (whole.unionByName(segments).repartition("conv").sortWithinPartitions(*order)
             .mapInArrow(_apply(conv_type), f"conv {kind}, pos long, turn long, role string, text string, edit string"))
    return Repaired(summary, fixed.withColumnRenamed("conv", conv_col))


def digests(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conversation, sha256): of ``repair``'s turns as ``role:text`` lines; streams each conversation in its order."""
    schema = pa.schema([("conv", to_arrow_type(turns.schema[conv_col].dataType)), ("sha256", pa.string())])

    def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
        now, state = None, None
        for conv, role, text in rows:
            line = f"{role}:{text}".encode()
            if state is None or conv != now:
                if state:
                    yield now, state.hexdigest()
                now, state = conv, hashlib.sha256(line)
            else:
                state.update(b"\n" + line)
        if state:
            yield now, state.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(hashed(_rows(batches, 256)), schema, lambda row: 64)

    kind = turns.schema[conv_col].dataType.simpleString()
    return turns.select(conv_col, "role", "text").mapInArrow(run, f"`{conv_col}` {kind}, sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): rows dropped, emptied, cut, repeated or given another role by the crc32 of
    ``conv_id:turn`` modulo 20; NULLs are one space, also in that key."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("n"))
