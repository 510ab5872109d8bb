"""Helpers the operators share: stored intermediate tables and text in bounded chunks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicegate.session import discard_scratch, shared_scratch

# Bytes of text whose arrays are held at once; a longer text is one chunk of its own.
CHUNK_BYTES = 1 << 21

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_RANDOM = np.random.Generator(np.random.PCG64(20240301))
BYTE_CODES = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


# Folders of stored frames that go when the innermost ``passing`` block ends.
_passing: list[list[str]] = []


def stored(frame: DataFrame, label: str, *, keep: bool = False) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Later stages then start from files that every executor can read, whichever
    executors have been lost meanwhile.  Within a ``passing`` block it is deleted with the block, or, if it is to be
    kept, with the block around that one.
    """
    path = shared_scratch(frame.sparkSession, label)
    blocks = _passing[:-1] if keep else _passing
    if blocks:
        blocks[-1].append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Delete what is stored in the block when it ends; its result must be written by then, and kept."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            discard_scratch(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of an id's decimal text, modulo a divisor; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def remainders(ids: list, divisor: int) -> list:
    """The same in Python."""
    return [None if i is None else zlib.crc32(str(i).encode()) % divisor for i in ids]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


class Chunk:
    """The bytes of consecutive texts and where each begins."""

    def __init__(self, rows: slice, data: np.ndarray, starts: np.ndarray):
        self.rows = rows  # rows of the batch
        self.data = data  # uint8
        self.starts = starts  # one more than rows

    def words(self, letter: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word, and the first word of each text (one more).

        ``letter`` says which bytes are in words; by default all but white space.
        """
        letters = ~SPACES[self.data] if letter is None else letter[self.data]
        fresh = letters.copy()
        fresh[1:] &= ~letters[:-1]
        inner = self.starts[:-1]
        inner = inner[inner < len(letters)]
        fresh[inner] = letters[inner]
        last = letters.copy()
        last[:-1] &= ~letters[1:]
        before = inner[inner > 0] - 1
        last[before] = letters[before]
        begin = np.flatnonzero(fresh)
        return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, self.starts)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into runs of whole texts of about ``limit`` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        begin = offsets[row]
        yield Chunk(slice(row, end), data[begin : offsets[end]], offsets[row : end + 1] - begin)
        row = end


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A to Z in lower case; other characters stay."""
    capital = (data >= 65) & (data <= 90)
    return data + capital.astype(np.uint8) * np.uint8(32)


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, kept as far as they were needed."""
    if len(_powers[0]) < count:
        for at, base in enumerate((_BASE, _INVERSE)):
            factors = np.full(count + count // 4, base, np.uint64)
            factors[0] = 1
            _powers[at] = np.cumprod(factors)
    return _powers[0][:count], _powers[1][:count]


def span_hashes(
    codes: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0
) -> np.ndarray:
    """A 64-bit hash of ``codes[begin:end]`` for many spans at once.

    Polynomial over 64-bit codes.  Equal spans agree wherever they stand; different ones
    agree with a chance of about 2^-64.
    """
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * down[:-1], out=sums[1:])
    values = (sums[end] - sums[begin]) * up[begin]
    return mix(values + (end - begin).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D + 2 * seed))


def window_hashes(codes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """``span_hashes`` of ``width`` codes from every place that has so many."""
    count = len(codes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * down[:-1], out=sums[1:])
    values = (sums[width:] - sums[:-width]) * up[:count]
    return mix(values + np.uint64(width * (0x2545F4914F6CDD1D + 2 * seed) % 2**64))


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hashes(BYTE_CODES[data], begin, end)


def covered(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans that are sorted by their begin; touching spans become one."""
    if not len(begin):
        return begin, end
    reach = np.maximum.accumulate(end)
    fresh = np.empty(len(begin), bool)
    fresh[0] = True
    fresh[1:] = begin[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(begin)) - 1
    return begin[first], reach[last]
