"""Substring dedup with a count-min prefilter.

A window is ``size`` consecutive words of one document. A word goes when a window covers
it whose word sequence also starts earlier: in a document with a smaller id, or earlier in
the same one. Two passes:

1. Every block of documents makes a sparse count-min sketch of its windows (its non-zero
   cells, sorted, per row of the sketch). Shards of each row add up all blocks and tell
   every block which of its cells hold two windows or more. A sketch never counts too
   low, so a window with a cell of one in any row occurs once and is done with.
2. The rest is grouped exactly, by a 96-bit digest of the words, and all but the first
   occurrence go back to their block, where the covered words are taken out.

The width of the sketch follows the input (cells per row: bytes of text, rounded up to a
power of two), so the share of windows that pass wrongly does not grow with the input.

Defined results: missing and empty texts have no words. Ids are integers; a missing id
comes before all others. Rows with the same id and position are equally early, so
repeated rows under one id do not take words out of each other. Other columns are not
looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsflow.llm.blocks import Layout, below, by_shard, laid_out, ordered, pack_sorted, unpack_sorted
from newsflow.llm.bytewords import Words, mix, slices, text_bytes, window_hash
from newsflow.llm.tasks import sha

WINDOW = 20
ROWS = 2
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
_FIRST = np.iinfo(np.int64).min


class Sketch:
    """Cells of a count-min sketch with ``2**bits`` cells in each of ``rows`` rows."""

    def __init__(self, layout: Layout, rows: int):
        self.rows, self.shard_bits = rows, layout.shard_bits
        self.bits = max(16, layout.size.bit_length(), self.shard_bits)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return mix(hashes ^ np.uint64(_SEEDS[row])) >> np.uint64(64 - self.bits)

    @property
    def inner_bits(self) -> int:
        return self.bits - self.shard_bits


def _windows(rows: pa.RecordBatch, size: int, which: int = 0) -> np.ndarray:
    """Hashes of all windows of a block, in order of document and position."""
    out = [np.zeros(0, dtype=np.uint64)]
    for part in slices(rows, "text"):
        words = Words(part.column("text"))
        out.append(window_hash(words.hashes(which), words.window_starts(size)[0], size, which))
    return np.concatenate(out)


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, rows: int = ROWS) -> DataFrame:
    """``id, n_words, n_removed, kept``: the words that stay, joined by one space."""
    return _dedup(docs, id_col, text_col, size, rows, "kept string", lambda words: {"kept": pa.array([w.decode() for w in words], pa.string())})


def repeated_words_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, rows: int = ROWS) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256``: as above, with a digest for the words."""
    return _dedup(docs, id_col, text_col, size, rows, "kept_sha256 string", lambda words: {"kept_sha256": pa.array([sha(w) for w in words], pa.string())})


def _dedup(docs: DataFrame, id_col: str, text_col: str, size: int, rows: int, ddl: str, output) -> DataFrame:
    texts, layout = laid_out(docs, id_col, text_col)
    sketch, shard_bits = Sketch(layout, rows), layout.shard_bits
    id_type = texts.schema["id"].dataType.simpleString()

    def sketched(block: pa.Table) -> pa.Table:
        number, hashes = block.column("block")[0].as_py(), _windows(ordered(block), size)
        part, cells = [], []
        for row in range(sketch.rows):
            own = np.sort(sketch.cells(hashes, row))
            for shard, span in enumerate(by_shard(own, sketch.bits, shard_bits)):
                if span.stop > span.start:
                    part.append(row << shard_bits | shard)
                    cells.append(pack_sorted(below(own[span], sketch.bits, shard_bits), sketch.inner_bits))
        return pa.table({"part": pa.array(part, pa.int32()), "block": pa.array([number] * len(part), pa.int32()), "cells": pa.array(cells, pa.binary())})

    def merged(part: pa.Table) -> pa.Table:
        """Which cells of each block were counted twice or more over all blocks."""
        own = [unpack_sorted(c, sketch.inner_bits) for c in part.column("cells").to_pylist()]
        total = np.sort(np.concatenate(own))
        several = np.unique(total[1:][total[1:] == total[:-1]])
        flags = []
        for cells in own:
            place = np.minimum(np.searchsorted(several, cells), max(0, len(several) - 1))
            flags.append(np.packbits(several[place] == cells if len(several) else np.zeros(len(cells), dtype=bool)).tobytes())
        return pa.table({"block": part.column("block"), "part": part.column("part"), "flags": pa.array(flags, pa.binary())})

    def passed(block: pa.Table, answers: pa.Table) -> pa.Table:
        """The windows that every row of the sketch counts twice, per shard of the exact pass."""
        names = ["shard", "block", "docs", "starts", "counts", "digest", "more"]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        nothing = pa.table([pa.array([], t) for t in types], names)
        if not block.num_rows or not answers.num_rows:
            return nothing
        number, own = block.column("block")[0].as_py(), ordered(block)
        hashes = _windows(own, size)
        flags = dict(zip(answers.column("part").to_pylist(), answers.column("flags").to_pylist()))
        keep = np.ones(len(hashes), dtype=bool)
        for row in range(sketch.rows):
            cells = sketch.cells(hashes, row)
            order = np.argsort(cells)
            stretch = [np.zeros(0, dtype=np.uint8)]
            for shard, span in enumerate(by_shard(cells[order], sketch.bits, shard_bits)):
                if span.stop > span.start:
                    stretch.append(np.unpackbits(np.frombuffer(flags[row << shard_bits | shard], dtype=np.uint8), count=span.stop - span.start))
            several = np.empty(len(hashes), dtype=bool)
            several[order] = np.concatenate(stretch)
            keep &= several
        chosen = np.flatnonzero(keep)
        if not len(chosen):
            return nothing
        digest, more = hashes[chosen], _windows(own, size, 1)[chosen]
        ids = np.array([_FIRST if i is None else i for i in own.column("id").to_pylist()], dtype=np.int64)
        before = _window_numbers(own, size)
        doc = np.searchsorted(before, chosen, side="right") - 1
        shards = (more >> np.uint64(64 - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(chosen), dtype=np.int64)
        out = []
        for shard in range(1 << shard_bits):
            mine = np.flatnonzero(shards == shard)
            if len(mine):
                docs_here, first = np.unique(doc[mine], return_index=True)
                table = np.stack([ids[docs_here], before[docs_here], np.diff([*first, len(mine)])])
                low = (more[mine] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                out.append((shard, number, table.tobytes(), pack_sorted(chosen[mine].astype(np.uint64), int(len(hashes)).bit_length()), np.int64(len(hashes)).tobytes(), digest[mine].tobytes(), low.tobytes()))
        return pa.table([pa.array(column, t) for column, t in zip(zip(*out), types)], names)

    def grouped(shard: pa.Table) -> pa.Table:
        """All occurrences of a digest but the first go back to their blocks."""
        ids, starts, windows, blocks = [], [], [], []
        for docs_, packed, total in zip(*(shard.column(c).to_pylist() for c in ("docs", "starts", "counts"))):
            table = np.frombuffer(docs_, dtype=np.int64).reshape(3, -1)
            numbers = unpack_sorted(packed, int(np.frombuffer(total, dtype=np.int64)[0]).bit_length()).astype(np.int64)
            ids.append(np.repeat(table[0], table[2]))
            starts.append(numbers - np.repeat(table[1], table[2]))
            windows.append(numbers)
        sizes = [len(w) for w in windows]
        ids, starts = np.concatenate(ids), np.concatenate(starts)
        digest = np.frombuffer(b"".join(shard.column("digest").to_pylist()), dtype=np.uint64)
        more = np.frombuffer(b"".join(shard.column("more").to_pylist()), dtype=np.uint32)
        order = np.lexsort((starts, ids, more, digest))
        same = (digest[order][1:] == digest[order][:-1]) & (more[order][1:] == more[order][:-1])
        head = np.concatenate([[True], ~same])
        leader = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
        later = np.zeros(len(order), dtype=bool)
        later[order] = (ids[order] != ids[leader]) | (starts[order] != starts[leader])
        cut = np.cumsum(sizes)
        for a, b, numbers in zip(cut - sizes, cut, windows):
            blocks.append(pack_sorted(numbers[later[a:b]].astype(np.uint64), 40))
        return pa.table({"block": shard.column("block"), "later": pa.array(blocks, pa.binary())})

    def taken_out(block: pa.Table, later: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table([pa.array([], f.type) for f in out_fields], [f.name for f in out_fields])
        own = ordered(block)
        numbers = np.sort(np.concatenate([np.zeros(0, dtype=np.uint64), *(unpack_sorted(x, 40) for x in later.column("later").to_pylist())])).astype(np.int64)
        before = _window_numbers(own, size)
        cuts = np.searchsorted(numbers, before)
        n_words, n_removed, kept = [], [], []
        data, offsets = text_bytes(own.column("text"))
        for d in range(own.num_rows):
            words = data[offsets[d] : offsets[d + 1]].tobytes().split()
            starts = numbers[cuts[d] : cuts[d + 1]] - before[d]
            n_words.append(len(words))
            if len(starts):
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                edge[starts] += 1
                edge[starts + size] -= 1
                stays = np.cumsum(edge)[:-1] == 0
                words = [w for w, s in zip(words, stays.tolist()) if s]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        return pa.table({id_col: own.column("id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), **output(kept)})

    out_ddl = f"{id_col} {id_type}, n_words long, n_removed long, {ddl}"
    out_fields = [pa.field(id_col, pa.int64() if id_type == "bigint" else pa.int32()), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), *[pa.field(c, pa.string()) for c in output([])]]
    answers = texts.groupBy("block").applyInArrow(sketched, "part int, block int, cells binary").groupBy("part").applyInArrow(merged, "block int, part int, flags binary")
    candidates = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(passed, "shard int, block int, docs binary, starts binary, counts binary, digest binary, more binary")
    later = candidates.groupBy("shard").applyInArrow(grouped, "block int, later binary")
    return texts.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(taken_out, out_ddl)


def _window_numbers(rows: pa.RecordBatch, size: int) -> np.ndarray:
    """How many windows of the block come before each document; one more at the end."""
    counts = [np.zeros(1, dtype=np.int64)]
    for part in slices(rows, "text"):
        counts.append(np.maximum(Words(part.column("text")).counts - size + 1, 0))
    return np.cumsum(np.concatenate(counts))
