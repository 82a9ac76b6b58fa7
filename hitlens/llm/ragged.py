"""Id sequences of text pieces, remembered and gathered with NumPy.

A piece is a run of anything but ASCII white space.  Tokenizers whose words
never hold white space give a text the ids of its pieces, one after the other,
so a piece is tokenised once per worker and a text is a gather by piece number.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np


class _Places(dict):
    """piece -> number; unknown pieces get the next one and are noted in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, piece: bytes) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


def _grown(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` written from ``used`` on; doubled when it is full."""
    need = used + len(more)
    if need > len(held):
        bigger = np.empty(max(need, 2 * len(held)), held.dtype)
        bigger[:used] = held[:used]
        held = bigger
    held[used:need] = more
    return held


class PieceTable:
    """``encode`` gives the ids of new pieces; at most about ``most`` pieces are remembered.

    ``encode(pieces)`` returns (all ids, number of ids of each piece, anything else per piece or None).  When the table
    is full the half that was used most often stays.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, list | None]], most: int = 400_000):
        self.encode, self.most = encode, most
        self._reset()

    def _reset(self) -> None:
        self.places, self.extra = _Places(), []
        self.starts, self.sizes, self.uses = np.zeros(1024, np.int64), np.zeros(1024, np.int32), np.zeros(1024, np.int64)
        self.flat, self.held = np.zeros(4096, np.int32), 0

    def numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Number of each piece, valid until the next call."""
        if len(self.places) > self.most:
            self._shrink()
        out = np.fromiter(map(self.places.__getitem__, pieces), np.int64, len(pieces))
        if self.places.fresh:
            self._learn()
        self.uses[:len(self.places)] += np.bincount(out, minlength=len(self.places))
        return out

    def _learn(self) -> None:
        fresh, known = self.places.fresh, len(self.places) - len(self.places.fresh)
        flat, sizes, extra = self.encode(fresh)
        self._add(known, sizes, flat, np.zeros(len(sizes), np.int64))
        if extra is not None:
            self.extra += extra
        self.places.fresh = []

    def _add(self, known: int, sizes: np.ndarray, flat: np.ndarray, uses: np.ndarray) -> None:
        self.starts = _grown(self.starts, known, self.held + np.cumsum(sizes) - sizes)
        self.sizes = _grown(self.sizes, known, sizes)
        self.uses = _grown(self.uses, known, uses)
        self.flat = _grown(self.flat, self.held, flat)
        self.held += len(flat)

    def _shrink(self) -> None:
        n = len(self.places)
        kept = np.sort(np.argsort(self.uses[:n], kind="stable")[n - self.most // 2:])
        pieces, extra = list(self.places), self.extra
        flat, sizes, uses = self.gather(kept)[0], self.sizes[kept].astype(np.int64), self.uses[kept] // 2
        self._reset()
        for k in kept.tolist():
            self.places[pieces[k]] = len(self.places)
        self.extra = [extra[k] for k in kept.tolist()] if extra else []
        self._add(0, sizes, flat, uses)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many ids each piece has."""
        sizes = self.sizes[numbers].astype(np.int64)
        return gathered(self.flat, self.starts[numbers], sizes), sizes


def flattened(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each list has."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return flat[at]


def per_text(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of ``sizes`` over each text's run of ``counts`` pieces."""
    sums = np.concatenate(([0], np.cumsum(sizes)))
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]
