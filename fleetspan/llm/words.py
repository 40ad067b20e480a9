"""Words of many texts at once, as byte ranges and hashes in numpy arrays.

The texts of an Arrow batch lie in one byte buffer; words are found and hashed
in it without a Python object for each. A hash is a polynomial over the bytes
of a word (of the words of a run) modulo 2**64, taken from prefix sums and
then scrambled, so any run of words is hashed in constant time.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_BYTES, SMALL_PIECE = 2_000_000, 1_000_000
"""Text that is worked on at once; less of it where many numbers stand for each word."""
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
"""Bytes between words: blank and tab to carriage return."""
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = np.uint64(0x9E3779B97F4A7C15)
"""Odd, so it has an inverse modulo 2**64."""
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse; the longest so far are kept."""
    known = _POWERS.get(int(base))
    if known is None or len(known[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        inverse = pow(int(base), -1, 1 << 64)
        up, down = np.full(size, base, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        known = _POWERS[int(base)] = np.cumprod(up, out=up), np.cumprod(down, out=down)
    return known


def run_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of values[begin:end] for each pair of bounds."""
    up, down = powers(len(values), base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, up[: len(values)], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


@dataclass
class Words:
    """Words of the texts of one piece: ``first[d]:first[d + 1]`` are those of text d."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return run_hashes(_byte_values()[self.data], self.start, self.end)

    def run_starts(self, k: int) -> np.ndarray:
        """Words with at least k - 1 words of their text behind them."""
        at = np.arange(len(self.start))
        return at[at + k <= self.first[self.doc + 1]]

    def bytes_of(self, d: int) -> bytes:
        return self.data[self.offsets[d] : self.offsets[d + 1]].tobytes()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the bounds of each; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, between: np.ndarray = SPACES, lower: bool = False) -> Words:
    """Find the words: the longest runs of bytes that aren't ``between``."""
    data, offsets = text_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = ~between[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, offsets, start, end, doc, np.searchsorted(start, offsets))


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches between rows so that each piece holds a few MB of text (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy()
        group = (np.cumsum(lengths) - lengths) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows] if batch.num_rows else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The same for rows with the same id and text only, but for 64-bit accidents."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
