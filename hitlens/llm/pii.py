"""Personal data: base patterns, and a skip-chain conditional random field that adds what they miss.

Base kinds (email, ip, card, phone) are leftmost, non-overlapping matches over
the whole text; a match that fails its check is dropped without another try.

Field.  Nodes are the white-space-separated tokens with a digit, ``@``, ``+``,
``[at]`` or ``(at)``, and the tokens on both sides of one that is no more than
an ``@``, ``[at]`` or ``(at)``; all other tokens are ordinary by definition and appear as
context.  Labels are "none" and the kinds.  A node has a potential from its
shape, its neighbours' shapes, its number of digits and its marks.  Neighbouring nodes share a chain potential.  Distant
nodes of a document share a skip potential if they are the same token, or if
their digits end alike (``TAIL`` of them); of a group of such nodes each is
joined to the next, so a token that fills the document costs one edge per
occurrence.  Nodes in a base span are observed.  Loopy sum-product message
passing (damped, ``ROUNDS`` rounds) runs over all documents of a block at once;
a node whose best label has a marginal of ``SURE`` or more becomes a span, and
neighbours of one such label become one.

Training is piecewise, on a bounded sample: the documents of the ``TRAIN_DOCS``
smallest hashes of their ids among those that have a node, ``TRAIN_NODES``
nodes at most.  Their base spans are labels.  What the base patterns miss is
learned from planted spans: into some words of each such document go personal
data in other forms (cards with a wrong digit or other marks, phones without a
plus, masked mails, split addresses; ``planted``), at times again in short, and
ordinary numbers that look alike (dates, versions, prices, order numbers).
Digits of a card's length that fail its check have no known label in a given
text and teach nothing there.  Node potentials are softmax regression, pair
potentials the log ratio of joint to independent label frequencies, smoothed
towards equal labels on skip edges.

Defined cases: NULL and empty texts have no span; repeated rows each get a row;
an empty table gives no rows; without any node in the corpus the field is
absent and the base spans are all; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import common

KINDS = ("email", "ip", "card", "phone")
TAIL, ROUNDS, DAMPING, SURE = 7, 12, 0.5, 0.9
TRAIN_DOCS, TRAIN_NODES, CARRIER_WORDS = 4_000, 60_000, 60
#: A document of a small sample carries planted spans up to so many times.
MOST_LESSONS = 40
SHAPES = 1 << 12
CHAIN, SAME, ALIKE = range(3)

#: Columns of a node's features: shape, shapes before and after, digits and marks, digits with the shape before.
N_FEATURES = 5

_ANY = re.compile(r"[0-9@+]|[\[(]at[\])]")
_BLANK = r"[\x20\x09-\x0D]"
#: A mail cut at its ``@``: the words before and after.
_APART = re.compile(rf"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++){_BLANK}++(?:@|\[at\]|\(at\)){_BLANK}++([^\x20\x09-\x0D]++)")
_MASKS = ("@", "[at]", "(at)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried once, from its start: a shorter one cannot be followed by a dot either
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_CORE = re.compile(r"[0-9A-Za-z+(@](?:.*[0-9A-Za-z)@])?", re.S)
_DIGITS = re.compile(r"[0-9]+")
_WHOLE = re.compile(r".*", re.S)
#: Neighbours become one span up to so many digits; a span of fewer than the least is none.
_MOST_DIGITS = {"email": 1 << 30, "ip": 12, "card": 19, "phone": 15}
_LEAST_DIGITS = {"email": 0, "ip": 4, "card": 13, "phone": 7}


# ------------------------------------------------------------------ base spans

def emails(text: str) -> list[tuple[int, int]]:
    """Each ``@`` once: the longest local part back to the last match, then the domain."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) < 4 or len(p.lstrip("0")) < 4 for p in m[0].split(".")) and \
                all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGITS.findall(m[0]))
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
            out.append((3, *m.span()))
    return out


# ----------------------------------------------------------------------- nodes

def shape(token: str) -> str:
    """Digits by length of run, letters as one of a kind, the rest as it is."""
    token = _DIGITS.sub(lambda m: "9" * min(len(m[0]), 4) if len(m[0]) < 7 else "7" if len(m[0]) < 13
                        else "C" if len(m[0]) < 20 else "X", token)
    return re.sub(r"[^\W\d_]+", "a", token)


def _bucket(text: str) -> int:
    return zlib.crc32(text.encode()) % SHAPES


def features(core: str, before: str, after: str) -> tuple[int, ...]:
    digits = sum(map(len, _DIGITS.findall(core)))
    about = f"{min(digits, 21)} {''.join(sorted(set(re.sub(r'[^\W_]+', '', core))))} {core[:1].isalpha()}"
    return (_bucket(shape(core)), SHAPES + _bucket(before), 2 * SHAPES + _bucket(after),
            3 * SHAPES + _bucket(about), 4 * SHAPES + _bucket(f"{digits} {before}"))


class Graph:
    """Nodes and edges of some documents."""

    def __init__(self):
        self.doc: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.x: list[tuple[int, ...]] = []
        self.digits: list[int] = []
        self.base: list[int] = []  # label from the base spans, 0 for none
        self.edges: list[tuple[int, int, int]] = []

    def add(self, number: int, text: str, spans: list[tuple[int, int, int]]) -> None:
        """The document's tokens with a digit, a plus or a (masked) at."""
        if not _ANY.search(text):
            return
        owner = sorted((a, b, k + 1) for k, a, b in spans)
        at, far = 0, 0
        last_node, last_shape = -1, "^"
        by_token: dict[str, int] = {}
        by_tail: dict[str, int] = {}
        open_: int | None = None  # node that waits for the shape of the next token
        beside = {at for m in _APART.finditer(text) for at in (m.start(1), m.start(2))} \
            if any(mask in text for mask in _MASKS) else ()
        for m in _TOKEN.finditer(text):
            token = m[0]
            core = None
            if m.start() in beside or _ANY.search(token):
                core = _WHOLE.match(token) if token in _MASKS else _CORE.search(token)
            now = shape(token) if core else "w"
            if open_ is not None:
                x = self.x[open_]
                self.x[open_] = (*x[:2], 2 * SHAPES + _bucket(now), *x[3:])
                open_ = None
            if core is None:
                last_node, last_shape = -1, "w"
                continue
            node = len(self.doc)
            start, end = m.start() + core.start(), m.start() + core.end()
            while at < len(owner) and owner[at][1] <= start:
                at += 1
            far = at
            label = 0
            while far < len(owner) and owner[far][0] < end:
                if owner[far][1] > start:
                    label = min(label or 99, owner[far][2])
                far += 1
            self.doc.append(number)
            self.span.append((start, end))
            self.x.append(features(core[0], last_shape, "$"))
            self.base.append(label)
            digits = "".join(_DIGITS.findall(core[0]))
            self.digits.append(len(digits))
            if last_node >= 0:
                self.edges.append((last_node, node, CHAIN))
            last_node, last_shape, open_ = node, now, node
            other = by_token.get(core[0])
            if other is not None:
                self.edges.append((other, node, SAME))
            by_token[core[0]] = node
            if len(digits) >= TAIL:
                tail = by_tail.get(digits[-TAIL:])
                if tail is not None and tail != other:
                    self.edges.append((tail, node, ALIKE))
                by_tail[digits[-TAIL:]] = node


# ----------------------------------------------------------------------- field

@dataclass
class Field:
    """Log potentials: (features, labels) of nodes, (edge kinds, labels, labels) of edges."""

    node: np.ndarray
    pair: np.ndarray

    def marginals(self, graph: Graph) -> np.ndarray:
        """(nodes, labels) by damped loopy sum-product; observed nodes keep their label."""
        labels = self.node.shape[1]
        theta = self.node[np.array(graph.x, np.int64)].sum(axis=1)
        base = np.array(graph.base)
        seen = base > 0
        theta[seen] = -50.0
        theta[seen, base[seen]] = 0.0
        theta -= _log_sum(theta, 1)[:, None]
        if not graph.edges:
            return np.exp(theta)
        e = np.array(graph.edges, np.int64)
        n = len(e)
        source, target = np.concatenate((e[:, 0], e[:, 1])), np.concatenate((e[:, 1], e[:, 0]))
        pair = np.concatenate((self.pair[e[:, 2]], self.pair[e[:, 2]].transpose(0, 2, 1)))
        back = np.concatenate((np.arange(n, 2 * n), np.arange(n)))
        message = np.zeros((2 * n, labels))
        for _ in range(ROUNDS):
            belief = theta.copy()
            np.add.at(belief, target, message)
            new = _log_sum((belief[source] - message[back])[:, :, None] + pair, 1)
            new -= _log_sum(new, 1)[:, None]
            message = DAMPING * message + (1 - DAMPING) * new
        np.add.at(theta, target, message)
        return np.exp(theta - _log_sum(theta, 1)[:, None])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def fit_nodes(x: np.ndarray, y: np.ndarray, labels: int, ridge: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Softmax regression on the active features of a row, by gradient steps scaled per weight."""
    size, active = N_FEATURES * SHAPES, x.shape[1]
    w, scale = np.zeros((size, labels)), np.full((size, labels), 1e-8)
    hot, flat = np.eye(labels)[y], x.ravel()
    for _ in range(steps):
        z = w[x].sum(axis=1)
        pull = hot - np.exp(z - _log_sum(z, 1)[:, None])
        gradient = -ridge * len(x) * w / 100
        for k in range(labels):
            gradient[:, k] += np.bincount(flat, np.repeat(pull[:, k], active), size)
        scale += gradient ** 2
        w += gradient / np.sqrt(scale)
    return w


def pair_potentials(counts: np.ndarray) -> np.ndarray:
    """log joint - log independent label frequencies of each edge kind; skip edges lean to equal labels."""
    labels = counts.shape[1]
    smooth = counts + 0.5
    for kind in (SAME, ALIKE):
        smooth[kind] += 4 * np.eye(labels)
    smooth = smooth + smooth.transpose(0, 2, 1)  # an edge has no direction
    joint = smooth / smooth.sum(axis=(1, 2), keepdims=True)
    return np.log(joint) - np.log(joint.sum(axis=2, keepdims=True)) - np.log(joint.sum(axis=1, keepdims=True))


# ------------------------------------------------------------ planted training

def _number(r: random.Random, n: int) -> str:
    return str(r.randint(1, 9)) + "".join(r.choice("0123456789") for _ in range(n - 1))


def _email(r: random.Random) -> tuple[list[str], list[str]]:
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda a, b: "".join(r.choice(letters) for _ in range(r.randint(a, b)))
    name, host, end = word(2, 9) + r.choice(("", f".{word(3, 8)}", f".{r.randint(1, 99)}")), word(3, 10), r.choice(("com", "net", "org", "de"))
    at, dot = r.choice((("[at]", "[dot]"), ("(at)", "(dot)"), ("[at]", "."), ("(at)", "."), (" @ ", "."), (" [at] ", "."), (" (at) ", ".")))
    form = f"{name}{at}{host}{dot}{end}"
    return form.split(), [f"{name}@{host}.{end}"]


def _ip(r: random.Random) -> tuple[list[str], list[str]]:
    part = [str(r.randint(0, r.choice((9, 99, 255)))) for _ in range(4)]
    form = r.choice(("{}[.]{}[.]{}[.]{}", "{}(.){}(.){}(.){}", "{}.{}.{}[.]{}", "{},{},{},{}", "{}[dot]{}[dot]{}[dot]{}"))
    return [form.format(*part)], [".".join(part)]


def _card(r: random.Random) -> tuple[list[str], list[str]]:
    while luhn(digits := _number(r, r.choice((13, 15, 16, 16, 16, 16, 19)))):
        pass
    fours = [digits[k:k + 4] for k in range(0, len(digits), 4)]
    if len(fours[-1]) < 4 or r.random() < 0.4:
        return [digits], [digits]
    mark = r.choice((" ", "-", ".", "_", "/"))
    return mark.join(fours).split(), [digits]


def _phone(r: random.Random) -> tuple[list[str], list[str]]:
    area, mid, end = _number(r, 3), _number(r, 3), _number(r, 4)
    form = r.choice(("({}) {}-{}", "{}-{}-{}", "({}){}-{}", "{}.{}.{}", "0{} {} {}", "001-{}-{}-{}", "1-{}-{}-{}", "0{}/{}{}", "({}) {} {}"))
    return form.format(area, mid, end).split(), [f"{mid}-{end}", f"+1 ({area}) {mid}-{end}"]


def _ordinary(r: random.Random) -> list[str]:
    n = r.randint
    form = n(0, 13)
    return (f"{n(1900, 2035)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 31)}.{n(1, 12)}.{n(1900, 2035)}", f"{n(0, 23)}:{n(0, 59):02}",
            f"{n(0, 20)}.{n(0, 20)}.{n(0, 99)}", f"{n(1, 20)}.{n(0, 9)}", str(n(1900, 2035)), str(n(1, 99999)),
            f"{n(1, 999)}.{n(0, 99):02}", f"{n(1, 999)},{n(0, 999):03}", _number(r, n(5, 11)), _number(r, n(22, 30)),
            f"{n(1900, 2035)} {n(1, 12)} {n(1, 28)}", f"{n(1, 300)}-{n(301, 999)}", f"a{n(1, 99)}b{n(1, 9999)}")[form].split()


def planted(text: str, seed: int) -> tuple[str, list[tuple[int, int, int]]]:
    """Some words of ``text`` with personal data that base patterns miss, and look-alikes; (kind, start, end) of the former."""
    r = random.Random(seed)
    at = r.randrange(max(1, len(text) - 20 * CARRIER_WORDS))
    words = [m[0] for m in re.finditer(r"[^\x20\x09-\x0D]+", text[at:at + 20 * CARRIER_WORDS]) if not _ANY.search(m[0])]
    words = words[:CARRIER_WORDS] or ["w"]
    items: list[tuple[int, list[str]]] = []
    for _ in range(2):
        kind = r.randrange(len(KINDS))
        form, again = (_email, _ip, _card, _phone)[kind](r)
        items.append((kind, form))
        if r.random() < 0.5:
            items.append((kind, r.choice((form, r.choice(again).split()))))
    items += [(-1, _ordinary(r)) for _ in range(3)]
    places = sorted((r.randint(0, len(words)), k) for k in range(len(items)))
    out, spans, size, done = [], [], 0, 0

    def put(parts: list[str]) -> int:
        nonlocal size
        start = size + bool(out)
        out.extend(parts)
        size = start + len(" ".join(parts))
        return start

    for place, k in places:
        if place > done:
            put(words[done:place])
            done = place
        kind, form = items[k]
        start = put(form)
        if kind >= 0:
            spans.append((kind, start, size))
        elif out and r.random() < 0.3:
            out[-1] += (mark := r.choice(",.;"))
            size += len(mark)
    if done < len(words):
        put(words[done:])
    return " ".join(out), spans


def unchecked(core: str) -> bool:
    """As many digits as a card has: outside all spans they may be one or not."""
    return 13 <= sum(map(len, _DIGITS.findall(core))) <= 19


def _graph(texts: list[str | None]) -> tuple[Graph, list[list[tuple[int, int, int]]]]:
    graph, spans = Graph(), []
    for k, t in enumerate(texts):
        spans.append(base_spans(t) if t else [])
        graph.add(k, t or "", spans[-1])
    return graph, spans


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          train_docs: int = TRAIN_DOCS, train_nodes: int = TRAIN_NODES) -> Field | None:
    labels = len(KINDS) + 1
    have = docs.where(F.col(text_col).rlike("[0-9@+]")).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"))
    edge, n_docs = have.select("h").distinct().orderBy("h").limit(train_docs).agg(F.max("h"), F.count("h")).first()
    if edge is None:
        return None
    lessons = max(1, min(MOST_LESSONS, train_docs // n_docs))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document: its nodes' features and labels, flat, and its label pairs by edge kind."""
        for batch in batches:
            xs, ys, ps = [], [], []
            for h, t in zip(*(c.to_pylist() for c in batch.columns)):
                graph, _ = _graph([t])
                known = [bool(y) or not unchecked(t[a:b]) for y, (a, b) in zip(graph.base, graph.span)]
                at = len(graph.doc)
                for k in range(lessons):
                    more, spans = planted(t, h + k)
                    graph.add(1 + k, more, spans + base_spans(more))
                known += [True] * (len(graph.doc) - at)
                # what was planted comes first, so that a long text does not take its place
                use = [k for k in [*range(at, len(known)), *range(at)] if known[k]][:train_nodes]
                xs.append([f for k in use for f in graph.x[k]])
                ys.append([graph.base[k] for k in use])
                pairs = np.zeros(3 * labels * labels, np.int64)
                for a, b, kind in graph.edges:
                    if known[a] and known[b]:
                        pairs[(kind * labels + graph.base[a]) * labels + graph.base[b]] += 1
                ps.append(pairs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.list_(pa.int32())),
                 pa.array(ps, pa.list_(pa.int64()))], names=["h", "x", "y", "pairs"])

    rows = (have.where(F.col("h") <= edge).mapInArrow(nodes, "h long, x array<int>, y array<int>, pairs array<long>")
            .orderBy("h", "x").limit(train_docs).toLocalIterator())
    xs, ys, counts, held = [], [], np.zeros(3 * labels * labels), 0
    for r in rows:
        counts += np.array(r.pairs)
        if held < train_nodes:
            xs += r.x
            ys += r.y
            held = len(ys)
    x, y = np.array(xs, np.int64).reshape(-1, N_FEATURES)[:train_nodes], np.array(ys, np.int64)[:train_nodes]
    return Field(fit_nodes(x, y, labels), pair_potentials(counts.reshape(3, labels, labels)))


def added_spans(graph: Graph, field: Field, spans: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans of nodes outside the base spans whose label is sure, by document; neighbours of one label are one span,
    as long as they have not more digits than one of their kind.  Too few digits for the kind are no span."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in spans]
    if graph.doc:
        p = field.marginals(graph)
        best = p.argmax(axis=1)
        sure = (best > 0) & (p[np.arange(len(p)), best] >= SURE) & (np.array(graph.base) == 0)
        beside, digits = {b for a, b, kind in graph.edges if kind == CHAIN}, 0
        sizes: dict[tuple[int, int], int] = {}  # digits by document and start
        for k in np.flatnonzero(sure).tolist():
            mine, label = out[graph.doc[k]], int(best[k]) - 1
            digits += graph.digits[k]
            if k in beside and sure[k - 1] and best[k - 1] == best[k] and digits <= _MOST_DIGITS[KINDS[label]]:
                mine[-1] = (label, mine[-1][1], graph.span[k][1])
            else:
                mine.append((label, *graph.span[k]))
                digits = graph.digits[k]
            sizes[(graph.doc[k], mine[-1][1])] = digits
        out = [[s for s in mine if sizes[(n, s[1])] >= _LEAST_DIGITS[KINDS[s[0]]]] for n, mine in enumerate(out)]
    return out


def find(spark: SparkSession, docs: DataFrame, field: Field | None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id_col, base, added): arrays of <kind, start, end> per input row, each by kind as listed, then start."""
    sent = spark.sparkContext.broadcast(field)
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def column(spans: list[list[tuple[int, int, int]]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(s)] for s in spans], pa.list_(item))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for a, b in common.chunks(common.text_bytes(texts), 8_000_000):
                graph, spans = _graph(texts.slice(a, b - a).to_pylist())
                more = added_spans(graph, sent.value, spans) if sent.value is not None else [[] for _ in spans]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), column(spans), column(more)],
                                                 names=[id_col, "base", "added"])

    kind = docs.schema[id_col].dataType.simpleString()
    spans = "array<struct<kind: string, start: long, end: long>>"
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, base {spans}, added {spans}")
