"""Minimal acyclic transducer: words to id sequences in a shared-suffix automaton.

Built word by word in sorted order: the part of the last word that the next
one does not share is final, and each of its states is replaced by an equal
one that exists already, so common suffixes are stored once.  Every edge
carries how many words precede it below its state; the sum along a path is the
word's number, which selects its output ids.  ``pack`` gives one block of
bytes that ``Lexicon`` uses in place, for example memory-mapped.
"""

from __future__ import annotations

import mmap
import os
import tempfile

import numpy as np

#: Header: edges, states, words, ids.  All numbers are four bytes; 2^23 states are the most.
_HEADER, _NUMBER = 4, np.int32


class _State:
    __slots__ = ("edges", "final", "count", "number")

    def __init__(self):
        self.edges: dict[int, _State] = {}
        self.final, self.count, self.number = False, 0, -1

    def signature(self):
        return self.final, tuple((label, id(s)) for label, s in self.edges.items())


def build(words: list[bytes]) -> _State:
    """Minimal automaton of the sorted, distinct, non-empty ``words``."""
    root, register = _State(), {}
    path, last = [root], b""

    def freeze(depth: int) -> None:
        for at in range(len(path) - 1, depth, -1):
            state = path[at]
            state.count = state.final + sum(s.count for s in state.edges.values())
            kept = register.setdefault(state.signature(), state)
            path[at - 1].edges[last[at - 1]] = kept
        del path[depth + 1:]

    for word in words:
        shared = len(os.path.commonprefix((last, word)))
        freeze(shared)
        for label in word[shared:]:
            state = _State()
            path[-1].edges[label] = state
            path.append(state)
        path[-1].final = True
        last = word
    freeze(0)
    root.count = sum(s.count for s in root.edges.values())
    return root


def pack(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The transducer of ``entries`` (word -> output ids) as bytes."""
    words = sorted(entries)
    root = build(words)
    root.number, states = 0, [root]
    for state in states:  # grows while it is read: breadth first
        for child in state.edges.values():
            if child.number < 0:
                child.number = len(states)
                states.append(child)
    keys, targets, skips = [], [], []
    for state in states:
        before = int(state.final)
        for label in sorted(state.edges):
            child = state.edges[label]
            keys.append(state.number << 8 | label)
            targets.append(child.number)
            skips.append(before)
            before += child.count
    lengths = [len(entries[w]) for w in words]
    if len(states) >= 1 << 23:
        raise ValueError("too many states for one lexicon")
    return b"".join(np.asarray(x, _NUMBER).tobytes() for x in (
        [len(keys), len(states), len(words), sum(lengths)], keys, targets, skips,
        [s.final for s in states], np.concatenate(([0], np.cumsum(lengths))),
        [i for w in words for i in entries[w]]))


class Lexicon:
    """Look-ups in packed bytes, many words at once."""

    def __init__(self, data: bytes | mmap.mmap):
        flat = np.frombuffer(data, _NUMBER)
        edges, states, words, ids = flat[:_HEADER].tolist()
        cuts = np.cumsum([_HEADER, edges, edges, edges, states, words + 1, ids])
        self.keys, self.targets, self.skips, self.final, self.starts, self.ids = (
            flat[a:b] for a, b in zip(cuts, cuts[1:]))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 if it is not in the lexicon."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.keys):
            return out
        sizes = np.fromiter(map(len, words), np.int64, n)
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        state, number = np.zeros(n, _NUMBER), np.zeros(n, np.int64)
        live, depth = np.flatnonzero(sizes > 0), 0
        while len(live):
            key = state[live] << _NUMBER(8) | flat[starts[live] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[edge] == key
            live, edge = live[ok], edge[ok]
            state[live] = self.targets[edge]
            number[live] += self.skips[edge]
            depth += 1
            ended = sizes[live] == depth
            done = live[ended]
            done = done[self.final[state[done]] != 0]
            out[done] = number[done]
            live = live[~ended]
        return out

    def output(self, number: int) -> list[int]:
        return self.ids[self.starts[number]:self.starts[number + 1]].tolist()


def mapped(data: bytes) -> mmap.mmap:
    """``data`` as a memory map of a file without a name: it goes with the process that maps it."""
    with tempfile.TemporaryFile() as f:
        f.write(data)
        f.flush()
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
