"""What the operators of this subpackage share: reading tables and vectorised words over Arrow text.

Text is handled as UTF-8 bytes. A word of a whole batch of texts is found, lower-cased and hashed by a
handful of numpy passes over the batch's byte buffer, so no Python code runs for a single word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass handles at once; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of words: letters and digits of ASCII and every byte of a longer character.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[48:58] = WORD_BYTES[65:91] = WORD_BYTES[97:123] = WORD_BYTES[128:] = True

#: Bytes of tokens that end only at white space.
SOLID_BYTES = np.ones(256, bool)
SOLID_BYTES[[32, 9, 10, 11, 12, 13]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each one; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes: first and one after the last."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit. Of one value too, as an array of one."""
    h = np.atleast_1d(h)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            _powers[i] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]))
    return _powers[0], _powers[1]


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start[i]:end[i]]."""
    up, down = _grown(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a block: where each begins and ends, a 64-bit hash, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD_BYTES, lower: bool = True):
        self.low = _LOWER[data] if lower else data
        mask = inside[data]
        before, after = np.zeros(len(mask), bool), np.zeros(len(mask), bool)
        before[1:], after[:-1] = mask[:-1], mask[1:]
        before[offsets[:-1][offsets[:-1] < len(mask)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.start, self.end = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # words of text i: first[i] to first[i + 1]
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = span_hash(self.low, self.start, self.end)
        return self._hash

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def window_hash(self, n: int) -> np.ndarray:
        """Of the n words from each word on; only those that ``whole(n)`` marks lie in one text."""
        h = self.hash
        out = np.zeros(len(h), np.uint64)
        if len(h) < n:
            return out
        k = len(h) - n + 1
        sums = np.full(k, np.uint64(n))
        for i in range(n):
            sums = (sums ^ h[i : i + k]) * _STEP
            sums ^= sums >> np.uint64(29)
        out[:k] = mixed(sums)
        return out

    def whole(self, n: int) -> np.ndarray:
        return np.arange(len(self.start)) + n <= np.repeat(self.first[1:], np.diff(self.first))

    def joined(self, i: int, n: int) -> bytes:
        """The n words from word i on, with a space between."""
        return b" ".join(self.low[self.start[j] : self.end[j]].tobytes() for j in range(i, i + n))


def text_of(column: str):
    """A text column with null as the empty text."""
    from pyspark.sql import functions as F

    return F.coalesce(F.col(column).cast("string"), F.lit(""))
