"""Words and word windows of whole Arrow text columns, as numpy arrays.

Texts stay UTF-8 bytes. Separators are ASCII, so a byte class splits words the way a
character class would, and positions inside a document are word numbers. A document of
any length is handled as one slice; short documents share a slice of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
#: Length of the tables of powers that a process keeps; longer ones serve one long text.
KEPT_POWERS = SLICE_BYTES + (1 << 16)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true outside of the given inclusive ranges."""
    inside = np.ones(256, dtype=bool)
    for low, high in ranges:
        inside[low : high + 1] = False
    return inside


#: `[^\x20\x09-\x0D]+`
BLANK_WORDS = byte_class((0x20, 0x20), (0x09, 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, to be used on lower-cased text
ALNUM_WORDS = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: Lower-cases A-Z and nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batch: pa.RecordBatch, column: str | int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each."""
    sizes = pc.binary_length(batch.column(column).cast(pa.large_string()))
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of every document (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a base and of its inverse; one table per base is kept."""
    known = _TABLES.get(base)
    if known is None or len(known[0]) < size:
        known = tuple(np.full(max(size, KEPT_POWERS), b, dtype=np.uint64) for b in (base, pow(base, -1, 1 << 64)))
        for table in known:
            table[:1] = 1
            np.multiply.accumulate(table, out=table)
        if size <= KEPT_POWERS:
            _TABLES[base] = known
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: One odd base and one random value per byte for each independent hash.
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_BYTES = tuple(np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for seed in (11, 23))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every span ``values[start:end]``, by differences of one running sum."""
    up, down = _powers(_BASES[which], len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    spans = (total[ends] - total[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Words:
    """The words of a slice: where each lies, and which words belong to which document."""

    def __init__(self, column: pa.Array, inside: np.ndarray = BLANK_WORDS, lower: bool = False):
        self.bytes, self.offsets = text_bytes(column)
        if lower:
            self.bytes = LOWER[self.bytes]
        word = inside[self.bytes]
        begin, end = word.copy(), word.copy()
        if len(word):
            begin[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            edges = self.offsets[:-1][np.diff(self.offsets) > 0]
            begin[edges] = word[edges]
            end[edges[1:] - 1] = word[edges[1:] - 1]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        #: Word numbers at which the documents begin; one more at the end.
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self, which: int = 0) -> np.ndarray:
        return span_hash(_BYTES[which][self.bytes], self.starts, self.ends, which)

    def window_starts(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers at which a full window begins, and the document of each."""
        n = np.maximum(self.counts - size + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        before = np.cumsum(n) - n
        return np.arange(n.sum()) - before[doc] + self.first[:-1][doc], doc

    def text(self, word: int) -> bytes:
        return self.bytes[self.starts[word] : self.ends[word]].tobytes()


def window_hash(words: np.ndarray, starts: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    return span_hash(words, starts, starts + size, which)
