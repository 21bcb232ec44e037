"""Blocks of documents, shards of hashes, and what travels between the two.

Corpus-wide questions about single tokens or windows ("how often is this one in all
texts?") are asked block by block: a block of documents sends, per hash shard, its sorted
keys in about two bits more than their entropy; a shard sees the keys of all blocks, and
answers each block in the order of its keys. The texts are shuffled into blocks once; all
steps of a query that need them read that same exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.tasks import keyed_texts

#: Bytes of text in a block: small inputs make many small blocks, large ones larger ones,
#: so that the number of block and shard pairs grows slower than with fixed blocks.
LEAST_BLOCK, MOST_BLOCK, WANTED_BLOCKS = 4 << 20, 32 << 20, 256
#: Bytes of text for which one shard is made.
SHARD_TEXT = 16 << 20


@dataclass(frozen=True)
class Layout:
    """How many blocks and shards an input of ``size`` bytes gets."""

    size: int

    @property
    def blocks(self) -> int:
        each = min(MOST_BLOCK, max(LEAST_BLOCK, self.size // WANTED_BLOCKS))
        return max(1, -(-self.size // each))

    @property
    def shard_bits(self) -> int:
        return max(0, (self.size // SHARD_TEXT).bit_length())


def laid_out(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Layout]:
    """``id, text, block`` of all rows; the block follows from id and text."""
    narrow = keyed_texts(docs, id_col, text_col)
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    layout = Layout(size)
    return narrow.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(layout.blocks)).cast("int")), layout


def ordered(block: pa.Table) -> pa.RecordBatch:
    """The rows of a block in an order that does not depend on how they arrived."""
    rows = block.select(["id", "text"]).sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
    return pa.RecordBatch.from_arrays([column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column for column in rows.columns], ["id", "text"])


def _low_bits(n: int, universe_bits: int) -> int:
    return max(0, universe_bits - max(1, n).bit_length() + 1)


def pack_sorted(values: np.ndarray, universe_bits: int) -> bytes:
    """Ascending values below ``2**universe_bits``: low bits as they are, high bits in unary."""
    n = len(values)
    if n == 0:
        return b""
    low = _low_bits(n, universe_bits)
    high = (values >> np.uint64(low)).astype(np.int64) if low < 64 else np.zeros(n, dtype=np.int64)
    unary = np.zeros(int(high[-1]) + n, dtype=np.uint8)
    unary[high + np.arange(n)] = 1
    bits = np.unpackbits(np.ascontiguousarray(values).view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :low]
    return np.int64(n).tobytes() + np.packbits(bits).tobytes() + np.packbits(unary).tobytes()


def unpack_sorted(data: bytes, universe_bits: int) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.uint64)
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    low = _low_bits(n, universe_bits)
    middle = 8 + -(-n * low // 8)
    bits = np.zeros((n, 64), dtype=np.uint8)
    bits[:, :low] = np.unpackbits(np.frombuffer(data, dtype=np.uint8, count=middle - 8, offset=8), count=n * low).reshape(n, low)
    values = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).reshape(n)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8, offset=middle)))[:n] - np.arange(n)
    return values | (high.astype(np.uint64) << np.uint64(low)) if low < 64 else values


def pack_counts(counts: np.ndarray) -> bytes:
    """Non-negative counts, one byte each; those from 255 on follow in full."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return np.int64(len(counts)).tobytes() + small.tobytes() + counts[counts >= 255].astype(np.int64).tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=np.int64)
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    counts = np.frombuffer(data, dtype=np.uint8, count=n, offset=8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data[8 + n :], dtype=np.int64)
    return counts


def by_shard(keys: np.ndarray, key_bits: int, shard_bits: int) -> list[slice]:
    """The stretch of ascending keys that belongs to each shard (their top bits)."""
    edges = np.arange(1, 1 << shard_bits, dtype=np.uint64) << np.uint64(key_bits - shard_bits)
    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def below(keys: np.ndarray, key_bits: int, shard_bits: int) -> np.ndarray:
    """Keys without the bits that name their shard."""
    bits = key_bits - shard_bits
    return keys & np.uint64((1 << bits) - 1)
