"""What the text operators share: Arrow plumbing and vectorised word hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dossier.session import ship_package

#: About so many bytes of text are turned into numpy arrays at once: bounds a worker's memory whatever a batch holds.
BLOCK_BYTES = 1 << 20


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with the package at hand on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def numbered(df: DataFrame) -> DataFrame:
    """*df* with its columns named c0, c1, ...: whatever a caller's columns are called, they can't clash with others then."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as bytes objects."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def ints(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def blocks(texts: list[bytes | None], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about *most* bytes of text each; a longer text stands alone."""
    start = held = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEFT = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (at least)."""
    kept = _powers.get(base)
    if kept is None or len(kept[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        inverse = pow(base, -1, 1 << 64)
        up = np.full(size, base, np.uint64)
        down = np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        kept = (np.cumprod(up), np.cumprod(down))
        if n <= 1 << 23:
            _powers[base] = kept
    return kept


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for every range: equal contents give equal hashes wherever they stand."""
    up, down = powers(len(values) + 1, base)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return (prefix[ends] - prefix[starts]) * down[starts]


BYTE_BASE, WORD_BASE, OTHER_BASE = 0x5851F42D4C957F2D, 0xD1342543DE82EF95, 0x2545F4914F6CDD1D

#: Bytes that separate words: ASCII white space.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


#: Longer words are hashed by BLAKE2 one by one; shorter ones eight bytes at a time, all together.
LONG_WORD = 256
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]: every eight bytes are mixed in before the next, so that no pattern of the letters cancels out."""
    size = end - start
    eight = np.ndarray((len(data),), "<u8", data + bytes(8), 0, (1,))
    h = mix(size.astype(np.uint64) * _ODD + _LEFT)
    left = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(left):
        part = eight[start[left] + at] & _KEEP[np.minimum(size[left] - at, 8)]
        h[left] = mix(h[left] ^ part) * _ODD
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return mix(h)


class Words:
    """The words of several texts in one run of arrays: h (64-bit hashes), start and end (bytes in *data*), doc, first."""

    def __init__(self, texts: list[bytes | None], separators: np.ndarray = _SPACE):
        self.data = b" ".join(t or b"" for t in texts) + b" "
        raw = np.frombuffer(self.data, np.uint8)
        space = separators[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space))))
        self.start, self.end = edge[0::2], edge[1::2]
        sizes = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.first = np.searchsorted(self.start, np.concatenate(([0], ends)))  # words of text d: first[d] to first[d + 1]
        self.h = word_hashes(self.data, self.start, self.end)

    def grams(self, n: int, base: int = WORD_BASE) -> np.ndarray:
        """Hash of the n words from each word on; past a text's end the values mean nothing."""
        count = len(self.h)
        at = np.arange(max(0, count - n + 1))
        return mix(range_hash(self.h, at, at + n, base) + _LEFT)


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def batch_of(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])
