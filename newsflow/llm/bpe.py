"""Byte-level BPE: encode with tiktoken and a local rank file, decode to raw bytes.

tiktoken splits a text by the tokenizer's pattern and merges bytes inside each piece.
Long texts are cut beforehand where the pattern can never match across: between a
non-blank and a blank character. Each part is then encoded on its own with the same ids.

Defined results: a missing text is an empty one, and an empty text has no ids and decodes
to no bytes; repeated rows are encoded each; other columns are not looked at.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from newsflow.llm.tasks import add_columns, map_texts, sha, texts_of

#: Characters of text that one call of the tokenizer gets at most, if a safe boundary allows.
PART = 1 << 16
_SAFE = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=2)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file; loaded once per process."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART) -> Iterator[str]:
    """Cut a text at the first safe boundary after each ``size`` characters."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, tokenizer: tiktoken.Encoding, size: int = PART) -> list[int]:
    if len(text) <= size:
        return tokenizer.encode_ordinary(text)
    return [token for part in parts(text, size) for token in tokenizer.encode_ordinary(part)]


def encode_texts(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", part: int = PART) -> DataFrame:
    """The ids of every text: ``id, ids array<int>``."""

    def make():
        tokenizer = encoding(rank_file, pattern)
        return lambda batch: {"ids": pa.array([encode(t, tokenizer, part) for t in texts_of(batch)], pa.list_(pa.int32()))}

    return map_texts(docs, id_col, text_col, "ids array<int>", make)


def decode_ids(rows: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes behind every list of ids: ``id, bytes binary`` (a missing list: none).

    Bytes, not text: a list may end inside of a character.
    """
    narrow = rows.select(id_col, ids_col)

    def run(batches):
        tokenizer = encoding(rank_file, pattern)
        for batch in batches:
            raw = [tokenizer.decode_bytes(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], [id_col, "bytes"])

    return narrow.mapInArrow(run, f"{id_col} {narrow.schema[id_col].dataType.simpleString()}, bytes binary")


def encode_rows(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text") -> DataFrame:
    """All columns but the text, then ``n_tokens``, ``ids`` and whether they decode to the
    text's bytes (``exact``). Columns that had these names are replaced."""
    docs = docs.drop(*[c for c in ("n_tokens", "ids", "exact") if c != text_col])

    def make():
        tokenizer = encoding(rank_file, pattern)

        def apply(batch):
            texts = texts_of(batch)
            ids = [encode(t, tokenizer) for t in texts]
            return {
                "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "ids": pa.array(ids, pa.list_(pa.int32())),
                "exact": pa.array([tokenizer.decode_bytes(i) == t.encode() for i, t in zip(ids, texts)], pa.bool_()),
            }

        return apply

    return add_columns(docs, text_col, "n_tokens long, ids array<int>, exact boolean", make).drop(text_col)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass: ``id, n_tokens, ids_sha256, decoded_sha256``.

    The ids themselves, three to four times the text as rows, stay inside the task.
    """

    def make():
        tokenizer = encoding(rank_file, pattern)
        name = [str(i) for i in range(tokenizer.n_vocab)].__getitem__

        def apply(batch):
            n, coded, decoded = [], [], []
            for text in texts_of(batch):
                ids = encode(text, tokenizer)
                n.append(len(ids))
                coded.append(sha(" ".join(map(name, ids))))
                decoded.append(sha(tokenizer.decode_bytes(ids)))
            return {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(coded, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}

        return apply

    return map_texts(docs, id_col, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
