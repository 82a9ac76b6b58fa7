"""Helpers that several operators share: table access, Arrow columns, word splitting, hashing.

Words are split on bytes: ``bytes.lower`` changes A-Z alone and ``bytes.split``
splits on exactly 0x20 and 0x09-0x0D, so whole texts are handled without a
regular expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Every byte but 0-9, a-z and those above 0x7F becomes a space; A-Z become a-z.
LETTERS_DIGITS = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as make it differ from ``taken`` in letters of either case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def crc_mod(column: str, n: int):
    """crc32 of the column as text, modulo n; NULL for NULL."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def chunks(texts: list[bytes | None], limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def text_ranges(column: pa.Array, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges as in ``chunks`` of a string column; no text is copied."""
    sizes = pc.fill_null(pc.binary_length(column.cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(column):
        yield start, len(column)


def text_chunks(column: pa.Array, limit: int = 4_000_000) -> Iterator[tuple[int, int, list[bytes | None]]]:
    """Row ranges as in ``chunks`` with their texts; only one range's texts are copied at a time."""
    data = column.cast(pa.binary())
    for start, end in text_ranges(column, limit):
        yield start, end, data.slice(start, end - start).to_pylist()


class WordHash(dict):
    """word -> 64-bit hash, remembered; cleared when it holds ``most`` words."""

    def __init__(self, seed: int, most: int = 400_000):
        super().__init__()
        self.seed, self.most = seed, most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word, seed=self.seed)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), U64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser of a public hash)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    return x ^ (x >> U64(33))


_BASE = 0x9E3779B97F4A7C15


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of every k consecutive values (length n - k + 1), by doubling."""
    out, have, power, size = None, 0, values, 1
    while True:
        if k & size:
            if out is None:
                out = power
            else:
                tail = power[have:]
                out = out[:len(tail)] * U64(pow(_BASE, size, 1 << 64)) + tail
            have += size
        if have == k:
            return out
        tail = power[size:]
        power = power[:len(tail)] * U64(pow(_BASE, size, 1 << 64)) + tail
        size *= 2
        if not len(power):
            return np.empty(0, U64)
