"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model is learnt from all trusted text: the documents labelled as good, but for a
quarter of the ids, chosen by a hash, that are left to set the quantile. Tokens are words
as written; a word that this text has only once, or not at all, is replaced by its shape
(upper case, lower case, digits and signs, runs collapsed), so that unknown words written
in an unusual way are unlikely and not just unknown.

Counts of trigrams, continuation counts of bigrams and words, and the totals of their
contexts lie in shards by hash, and no task and not the driver holds more than a few
shards. Blocks of texts send the shards their distinct keys, and get the counts in the
order of the keys: first the ids of words, then words, bigrams and trigrams. A trigram is
counted in the shard of its first bigram, which so knows what follows this bigram; the
shard tells that of the second bigram of one more left neighbour, and that one tells the
shards of both words. Keys are 46-bit hashes, so that among a billion n-grams one
lookup in 70,000 hits a wrong one; ids of words are exact, those of shapes 31
bits of a hash.

A document stays if its level is at most a quantile of the levels of the trusted documents
of its language that are not part of the sample. The level is the log-perplexity
per token, drawn towards the median of these documents as ``PRIOR_TOKENS`` tokens of that
kind would, since the perplexity of a few words says little. Languages with fewer than
``LEAST`` such documents use the figures of all; without any trusted document everything
stays. If there are trusted documents, but none for the sample or none besides it, nothing
can be rejected either, and a warning says so.

Defined results: missing and empty texts consist of the end token alone, and stay if the
quantile admits that; a missing language is a language of its own; repeated rows are
judged each, and an id counts once in the sample, with its shortest text; labels without document and documents without label do no harm; other
columns are passed on or not looked at.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from newsflow.llm.blocks import Layout, below, by_shard, pack_counts, pack_sorted, unpack_counts, unpack_sorted
from newsflow.llm.bytewords import _BYTES, Words, mix, slices, span_hash
from newsflow.llm.tasks import written
from newsflow.operators.key_filters import BITS, _is_set
from newsflow.session import Scratch, bounded_batches, delete_path, scratch_path

#: One document brings this part of the bytes at most, unless there is room for more.
SHARE = 64
#: Share of the trusted documents of a language whose level is admitted.
QUANTILE = 0.998
LEAST = 30
#: Languages with figures of their own that are broadcast at most; more are joined.
MAX_LANGUAGES = 10_000
#: Tokens of average text that a document's own tokens are weighed against.
PRIOR_TOKENS = 20
#: Ids of the marks at both ends of a text, and the bit that ids of shapes have.
_START, _END, _SHAPES = np.uint64(0xFFFFFFFE), np.uint64(0xFFFFFFFF), np.uint64(1 << 31)
_LOW = np.uint64(0xFFFFFFFF)
_JOIN = np.uint64(0x9FB21C651E98DF25)
#: Bits of the hashes that words, bigrams and trigrams are looked up by.
KEY_BITS = 46
_KEY_SHIFT = np.uint64(64 - KEY_BITS)
#: Tokens whose counts are brought together at a time.
_STEP = 1 << 17
#: Bytes of text in a block.
BLOCK_TEXT = 10 << 20
#: Turns in which all blocks are scored: what one sends is deleted before the next begins.
TURNS = 5
#: Bits per id of the filter that keeps most other texts from being sent to the blocks.
FILTER_BITS = 16

#: Classes of bytes in a shape; letters of other scripts count as lower case.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 65, 97, 48, 97


class Tokens:
    """Keys of words and, if wanted, of their shapes for all documents of a slice, ends included."""

    def __init__(self, column: pa.Array, shapes: bool = True):
        words = Words(column)
        self.words = words.hashes()
        if not shapes:
            return
        shape = _SHAPE[words.bytes]
        new = np.ones(len(shape), dtype=bool)
        new[1:] = shape[1:] != shape[:-1]
        new[words.starts] = True
        place = np.concatenate([[0], np.cumsum(new)])
        self.shapes = ~span_hash(_BYTES[1][shape[new]], place[words.starts], place[words.ends], 1)
        self.counts = words.counts + 1


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _JOIN + b)


def apart(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9), (30, 1)):
        x = x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))
        x = x * np.uint64(pow(factor, -1, 1 << 64))
    return x


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ascending keys, and where each begins."""
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new], np.flatnonzero(new)


def placed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of the keys, ascending, and the place of each key among them."""
    found, place = np.unique(keys, return_inverse=True)
    return found, place.astype(np.int32)


def added(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct keys, ascending, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    found, begin = grouped(keys[order])
    return found, [np.add.reduceat(v[order], begin) if len(begin) else v[:0] for v in values]


def _tokens(texts: pa.Array, shapes: bool = True) -> list[Tokens]:
    rows = pa.RecordBatch.from_arrays([texts.cast(pa.large_string())], ["text"])
    return [Tokens(part.column("text"), shapes) for part in slices(rows, "text")]


def _distinct_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the distinct words of a block, ascending, and how often each comes."""
    words = np.sort(np.concatenate([*(t.words for t in _tokens(texts, shapes=False)), np.zeros(0, dtype=np.uint64)]) >> _KEY_SHIFT)
    found, begin = grouped(words)
    return found, np.diff(np.append(begin, len(words)))


class _Block:
    """Tokens of the texts of a block, first as words, and by their ids when these are known."""

    def __init__(self, texts: pa.Array):
        parts = _tokens(texts)
        stack = lambda name: np.concatenate([getattr(t, name) for t in parts]) if parts else np.zeros(0, dtype=np.uint64)
        words, self.counts = stack("words") >> _KEY_SHIFT, stack("counts").astype(np.int64)
        self.shapes = np.minimum(_SHAPES | (stack("shapes") >> np.uint64(33)), _START - np.uint64(1)).astype(np.uint32)
        self.firsts = np.cumsum(self.counts) - self.counts
        of_doc = self.counts - 1
        self.at = np.arange(len(words)) + np.repeat(np.arange(len(of_doc)), of_doc)
        self.words, place = np.unique(words, return_inverse=True)
        self.place = place.astype(np.int32)

    def grams(self, known: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``u, v, w`` of every token; ``ids`` are those of the distinct words that are known."""
        of_word = np.zeros(len(self.words), dtype=np.uint64)
        of_word[known] = ids
        w = np.full(int(self.counts.sum()), _END, dtype=np.uint64)
        w[self.at] = np.where(known[self.place], of_word[self.place], self.shapes)
        v = self.before(w)
        return self.before(v), v, w

    def before(self, keys: np.ndarray, start=_START) -> np.ndarray:
        out = np.empty_like(keys)
        out[1:] = keys[:-1]
        out[self.firsts] = start
        return out


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The key of a bigram, from which its ids can be had again."""
    return mix(v << np.uint64(32) | w)


def triple(uv: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
    """The key of a trigram, in the shard of the bigram that it begins with."""
    rest = np.uint64(KEY_BITS - bits)
    return uv >> np.uint64(64 - bits) << rest | joined(uv, w) >> np.uint64(64 - KEY_BITS + bits) if bits else joined(uv, w) >> _KEY_SHIFT


_ZSTD = pa.Codec("zstd")


def _tight(data: bytes) -> bytes:
    """Marks and counts are mostly alike; their length goes before them."""
    return np.int64(len(data)).tobytes() + _ZSTD.compress(data, asbytes=True)


def _loose(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], int(np.frombuffer(data, dtype=np.int64, count=1)[0]), asbytes=True)


def _counts(counts: np.ndarray) -> bytes:
    return _tight(pack_counts(counts))


def _ids_by_byte(ids: np.ndarray) -> bytes:
    """Ids of 32 bits, the lowest bytes of all first, as the higher ones vary less."""
    return _tight(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _ids_of_bytes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_loose(data), dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.uint64)


_MESSAGE = "kind int, part int, block int, keys binary, marks binary, values array<binary>, stats array<long>"
_ARROW = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("marks", pa.binary()), ("values", pa.list_(pa.binary())), ("stats", pa.list_(pa.int64()))])
#: Kinds of messages: tables of words, bigrams and trigrams, what is told to those who add
#: them up, and what a block tells itself.
_WORD, _PAIR, _TRIPLE, _ENDS, _SELF = range(5)
_BITS = {_WORD: 32}


def _messages(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _ARROW)


def _dealt(kind: int, block: int, keys: np.ndarray, values: list[np.ndarray], bits: int, universe: int) -> list[dict]:
    """Ascending keys with their values as a message to each shard that has some."""
    out = []
    for part, span in enumerate(by_shard(keys, universe, bits)):
        if span.stop > span.start:
            out.append({"kind": kind, "part": part, "block": block, "keys": pack_sorted(below(keys[span], universe, bits), universe - bits), "values": [_counts(v[span]) for v in values]})
    return out


def _read(table: pa.Table, bits: int, universe: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys, whole again, and values of messages to one shard."""
    parts = [unpack_sorted(k, universe - bits) for k in table.column("keys").to_pylist()]
    keys = np.concatenate([*parts, np.zeros(0, dtype=np.uint64)])
    if bits and len(keys):
        keys = keys | np.uint64(table.column("part")[0].as_py()) << np.uint64(universe - bits)
    rows = table.column("values").to_pylist()
    return keys, [np.concatenate([unpack_counts(_loose(r[i])) for r in rows]) for i in range(len(rows[0]) if rows else 0)]


def _of_counts(counts: np.ndarray) -> list[int]:
    """Number of counts of one to four, number of all, and their sum."""
    return [*(int((counts == i).sum()) for i in range(1, 5)), int((counts > 0).sum()), int(counts.sum())]


def _types(begin: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Per context: sum of the counts, how many are one, how many two, and how many there are."""
    sums = lambda x: np.add.reduceat(x.astype(np.int64), begin) if len(begin) else np.zeros(0, dtype=np.int64)
    return [sums(counts), sums(counts == 1), sums(counts == 2), sums(counts > 0)]


def _answer_words(asked: pa.Table, table: pa.Table, bits: int) -> pa.Table:
    """Which words have an id, and the ranks that make it, to every block that asks."""
    held = _read(table, bits, KEY_BITS)[0]
    out = []
    for row in asked.select(["part", "block", "keys"]).to_pylist():
        keys = unpack_sorted(row["keys"], KEY_BITS - bits)
        if bits:
            keys = keys | np.uint64(row["part"]) << np.uint64(KEY_BITS - bits)
        known, rank = found_in(held, keys)
        wide = max(1, len(held).bit_length())
        out.append({"kind": _WORD, "part": row["part"], "block": row["block"], "keys": pack_sorted(rank[known].astype(np.uint64), wide), "marks": _tight(np.packbits(known).tobytes()), "stats": [len(keys), wide]})
    return _messages(out)


def found_in(held: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are held, and where."""
    if not len(held):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
    place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    return held[place] == keys, place


def _ids(answers: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of a block's distinct words have an id, and these ids."""
    known, ids = [np.zeros(0, dtype=bool)], [np.zeros(0, dtype=np.uint64)]
    for row in answers.sort_by("part").to_pylist():
        n, wide = row["stats"]
        known.append(np.unpackbits(np.frombuffer(_loose(row["marks"]), dtype=np.uint8), count=n).astype(bool))
        ids.append(np.uint64(row["part"]) << np.uint64(31 - bits) | unpack_sorted(row["keys"], wide))
    return np.concatenate(known), np.concatenate(ids)


def _answer_grams(asked: pa.Table, table: pa.Table, bits: int) -> pa.Table:
    """What the table knows of the keys that are asked for; a block's own words come back."""
    if asked.num_rows == 0 or asked.column("kind")[0].as_py() == _SELF:
        return asked
    kind = asked.column("kind")[0].as_py()
    universe = _BITS.get(kind, KEY_BITS)
    held, values = _read(table, bits, universe)
    out = []
    for row in asked.select(["part", "block", "keys"]).to_pylist():
        keys = unpack_sorted(row["keys"], universe - bits)
        if bits:
            keys = keys | np.uint64(row["part"]) << np.uint64(universe - bits)
        known, place = found_in(held, keys)
        out.append({"kind": kind, "part": row["part"], "block": row["block"], "marks": _tight(np.packbits(known).tobytes()), "values": [_counts(v[place[known]]) for v in values], "stats": [len(keys)]})
    return _messages(out)


def _answered(answers: pa.Table, kind: int, n: int, columns: int) -> list[np.ndarray]:
    """The values of all keys of a kind that a block asked for, zero for unknown ones."""
    rows = answers.filter(pc.equal(answers.column("kind"), kind)).sort_by("part").to_pylist()
    out = [np.zeros(n, dtype=np.int64) for _ in range(columns)]
    at = 0
    for row in rows:
        here = at + np.flatnonzero(np.unpackbits(np.frombuffer(_loose(row["marks"]), dtype=np.uint8), count=row["stats"][0]))
        for column, value in zip(out, row["values"]):
            column[here] = unpack_counts(_loose(value))
        at += row["stats"][0]
    return out


def most_of_one(lengths: np.ndarray, max_bytes: int) -> int:
    """Bytes that one document may bring: all if all fit, else what lets the short ones fit whole.

    Never less than one ``SHARE``-th of the bound, so that usual documents stay whole.
    """
    left, share = max_bytes, max(max_bytes // SHARE, 1)
    for i, n in enumerate(np.sort(lengths).tolist()):
        if n * (len(lengths) - i) > left:
            return max(share, left // (len(lengths) - i))
        left -= n
    return max(share, int(lengths.max(initial=0)))


def trusted_ids(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id`` of all trusted documents outside the held quarter of the ids."""
    good = labels.filter((F.col(label_col) == 1) & (F.pmod(F.xxhash64(id_col), F.lit(4)) != 0)).select(F.col(id_col).alias("id")).distinct()
    return docs.select(F.col(id_col).alias("id")).join(good, "id", "left_semi").distinct()


def likely(rows: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of the ``n`` ids, and few others (about one in seventy).

    A bitmap in pages is broadcast, two bytes an id, so that no text is shuffled for a join.
    """
    pages = -(-n * FILTER_BITS // BITS) or 1
    page = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(pages)).alias("_page")
    set_bits = [F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(BITS)) for i in (2, 3)]
    bits = ids.select(page, F.explode(F.array(*set_bits)).alias("_bit")).groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    first, second = (_is_set(F.col("_bits"), bit) for bit in set_bits)
    return rows.withColumn("_page", page).join(F.broadcast(bits), "_page").filter(first & second).select(*rows.columns)


def trusted_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_docs: int, max_bytes: int) -> DataFrame:
    """``id, text`` of the sample: least hashes of the id, one row each, up to both bounds.

    A document that alone would take a large share of the bytes gives its first words only,
    and so does the one at which the bytes are used up; neither keeps others out.
    """
    good = labels.filter((F.col(label_col) == 1) & (F.pmod(F.xxhash64(id_col), F.lit(4)) != 0)).select(F.col(id_col).alias("id")).distinct()
    # Lengths first: only they travel, the texts of the chosen few are read afterwards.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.octet_length(text_col), F.lit(0)).alias("n"), F.xxhash64(text_col).alias("t"))
    sized = rows.select("id", "n", "t").join(good, "id").groupBy("id").agg(F.min(F.struct("n", "t")).alias("r")).select("id", "r.*")
    first = written(sized.withColumn("h", F.xxhash64("id")).orderBy("h", "id").limit(max_docs), "trusted-lengths")
    share = most_of_one(first.select("n").toArrow().column(0).to_numpy(), max_bytes)
    before = Window.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, -1)
    part = F.least("n", F.lit(share))
    chosen = first.withColumn("before", F.coalesce(F.sum(part).over(before), F.lit(0))).filter(F.col("before") < max_bytes)
    chosen = chosen.select("id", "n", "t", F.least(part, F.lit(max_bytes) - F.col("before")).cast("int").alias("take"))
    # A cut text ends with its last whole word, if it has one.
    cut = F.regexp_replace(F.expr("CAST(substring(CAST(text AS BINARY), 1, take) AS STRING)"), r"\s\S*+$", "")
    text = F.when(F.col("n") > F.col("take"), cut).otherwise(F.col("text")).alias("text")
    return rows.join(F.broadcast(chosen), ["id", "n", "t"]).select("id", text).dropDuplicates(["id"])


def _discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of one, two, three and more."""
    n1, n2, n3, n4 = n[:4]
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    bounded = lambda d, c: min(max(d, 0.05), c - 0.05)
    return np.array([0.0, bounded(1 - 2 * y * n2 / n1, 1), bounded(2 - 3 * y * n3 / n2, 2), bounded(3 - 4 * y * n4 / n3 if n3 else 1.5, 3)])


@dataclass(frozen=True)
class Model:
    """Sharded tables of an interpolated trigram model, and the figures that all need."""

    bits: int
    words: DataFrame
    tables: DataFrame
    #: Per order (trigrams, bigrams, words): the discounts.
    discounts: tuple[np.ndarray, np.ndarray, np.ndarray]
    #: Sum of the continuation counts of words, and how many words have one.
    total: int
    distinct: int
    #: What the discounts take off them.
    left: float

    def word(self, c1: np.ndarray) -> np.ndarray:
        """Probability of words from their continuation counts."""
        d1 = self.discounts[2]
        return (c1 - d1[np.minimum(c1, 3)]) / self.total + self.unseen

    def context(self, order: int, sums: np.ndarray, ones: np.ndarray, twos: np.ndarray, types: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of contexts of trigrams (order 0) or bigrams (1): sum of counts, what discounts take off."""
        d = self.discounts[order]
        return sums, d[1] * ones + d[2] * twos + d[3] * (types - ones - twos)

    def share(self, order: int, c: np.ndarray, sums: np.ndarray, left: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probability from counts, those of the contexts, and the lower order."""
        return np.where(sums > 0, (c - self.discounts[order][np.minimum(c, 3)] + left * lower) / np.maximum(sums, 1), lower)

    @property
    def unseen(self) -> float:
        return self.left / self.total / (self.distinct + 1)


def _n_blocks(size: int) -> int:
    return -(-size // BLOCK_TEXT) or 1


def _blocks(rows: DataFrame, of: list[str], size: int) -> DataFrame:
    return rows.withColumn("block", F.pmod(F.xxhash64(*of), F.lit(_n_blocks(size))).cast("int"))


def _size(rows: DataFrame, text_col: str) -> int:
    return rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def _one_each(table: pa.Table) -> pa.Array:
    """The texts of a block, of each id the shortest; only ids that are listed, if there is a list."""
    if "listed" in table.column_names:
        listed = table.column("listed")
        texts = table.filter(pc.invert(listed))
        table = texts.filter(pc.is_in(texts.column("id"), table.filter(listed).column("id").combine_chunks(), skip_nulls=True))
    rows = table.select(["id", "text"]).append_column("n", pc.fill_null(pc.binary_length(table.column("text")), 0).cast(pa.int64()))
    rows = rows.sort_by([("id", "ascending"), ("n", "ascending"), ("text", "ascending")])
    first = pa.table({"id": rows.column("id"), "row": np.arange(rows.num_rows)}).group_by("id", use_threads=False).aggregate([("row", "min")]).column("row_min")
    return _whole(rows.column("text").take(first))


def _whole(column: pa.ChunkedArray) -> pa.Array:
    column = column.cast(pa.large_string()).combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _words_of(texts: pa.Array, number: int, bits: int, counted: bool) -> list[dict]:
    words, often = _distinct_words(texts)
    return _dealt(_WORD, number, words, [often] if counted else [], bits, KEY_BITS)


@contextmanager
def shuffles_dropped(spark) -> Iterator[None]:
    """Lets Spark delete what a job shuffled when it ends, not when the driver collects its garbage.

    For jobs that end with ``written``, whose shuffles nothing reads again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _cogrouped(left: DataFrame, right: DataFrame, by: list[str], function, schema: str) -> DataFrame:
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(function, schema)


def _table_and_told(messages: DataFrame, purpose: str, kind: int) -> tuple[DataFrame, DataFrame, Callable]:
    """Messages written in one pass: those of a table, those told to others, and what deletes these."""
    spark, path = messages.sparkSession, scratch_path(messages.sparkSession, purpose)
    messages.withColumn("told", F.col("kind") != kind).write.partitionBy("told").parquet(path)
    table, told = (spark.read.schema(_MESSAGE).parquet(f"{path}/told={flag}") for flag in ("false", "true"))
    return table, told, lambda: delete_path(spark, f"{path}/told=true")


def train(sample: DataFrame, size: int = 0, ids: DataFrame | None = None) -> Model | None:
    """The model of ``id, text``, one text of each id; None without any document.

    ``size`` is the bytes of the texts to be scored, if they are more than these. With
    ``ids`` (none missing, each once, of the type of the sample's), only rows of these count.
    """
    narrow = bounded_batches(sample).select("id", F.col("text").cast("string").alias("text"))
    if (narrow if ids is None else ids).isEmpty():
        return None
    if ids is not None:
        narrow = likely(narrow, ids, ids.count())
    own = _size(narrow, "text")
    if ids is not None:
        narrow = narrow.withColumn("listed", F.lit(False)).union(ids.select("id", F.lit(None).cast("string"), F.lit(True)))
    bits, texts = Layout(max(size, own)).shard_bits, _blocks(narrow, ["id"], own)

    def count_words(table: pa.Table) -> pa.Table:
        return _messages(_words_of(_one_each(table), table.column("block")[0].as_py(), bits, True))

    def common(table: pa.Table) -> pa.Table:
        keys, (counts,) = added(*_read(table, bits, KEY_BITS))
        keep = keys[counts > 1]
        return _messages([{"kind": _WORD, "part": table.column("part")[0].as_py(), "keys": pack_sorted(below(keep, KEY_BITS, bits), KEY_BITS - bits), "values": []}])

    def ask_words(table: pa.Table) -> pa.Table:
        return _messages(_words_of(_one_each(table), table.column("block")[0].as_py(), bits, False))

    def count_grams(table: pa.Table, answers: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return _messages([])
        u, v, w = _Block(_one_each(table)).grams(*_ids(answers, bits))
        uv = pair(u, v)
        order = np.lexsort((w, uv))
        uv, w = uv[order], w[order]
        new = np.ones(len(uv), dtype=bool)
        new[1:] = (uv[1:] != uv[:-1]) | (w[1:] != w[:-1])
        begin = np.flatnonzero(new)
        counts = np.diff(np.append(begin, len(uv)))
        uv, w, out = uv[begin], w[begin], []
        for part, span in enumerate(by_shard(uv, 64, bits)):
            if span.stop > span.start:
                # A bigram once, with the number of what follows it.
                context, begin = grouped(uv[span])
                follow = np.diff(np.append(begin, span.stop - span.start))
                out.append({"kind": _TRIPLE, "part": part, "keys": pack_sorted(below(context, 64, bits), 64 - bits), "marks": _ids_by_byte(w[span]), "values": [_counts(follow), _counts(counts[span])]})
        return _messages(out)

    def add_triples(table: pa.Table) -> pa.Table:
        """Trigrams of a shard, what follows its bigrams, and one more left neighbour for each end."""
        part = table.column("part")[0].as_py()
        context, (follow, c) = _read(table, bits, 64)
        uv = np.repeat(context, follow)
        w = np.concatenate([_ids_of_bytes(m) for m in table.column("marks").to_pylist()])
        order = np.lexsort((w, uv))
        uv, w, c = uv[order], w[order], c[order]
        new = np.ones(len(uv), dtype=bool)
        new[1:] = (uv[1:] != uv[:-1]) | (w[1:] != w[:-1])
        begin = np.flatnonzero(new)
        uv, w, c = uv[begin], w[begin], np.add.reduceat(c, begin)
        keys, (counts,) = added(triple(uv, w, bits), [c])
        out = [{"kind": _TRIPLE, "part": part, "keys": pack_sorted(below(keys, KEY_BITS, bits), KEY_BITS - bits), "values": [_counts(counts)], "stats": _of_counts(c)}]
        context, begin = grouped(uv)
        out += _dealt(_PAIR, -1, context >> _KEY_SHIFT, _types(begin, c), bits, KEY_BITS)
        ends, (left,) = added(pair(apart(uv) & _LOW, w), [np.ones(len(w), dtype=np.int64)])
        return _messages(out + _dealt(_ENDS, -1, ends, [left], bits, 64))

    def add_pairs(table: pa.Table) -> pa.Table:
        """Bigrams of a shard with left neighbours and what follows, and what its words have of them."""
        part = table.column("part")[0].as_py()
        of = lambda kind: table.filter(pc.equal(table.column("kind"), kind))
        ends, left = _read(of(_ENDS), bits, 64)
        ends, (left,) = added(ends, left or [np.zeros(0, dtype=np.int64)])
        context, follow = _read(of(_PAIR), bits, KEY_BITS)
        follow = follow or [np.zeros(0, dtype=np.int64)] * 4
        none = lambda n: np.zeros(n, dtype=np.int64)
        keys, values = added(np.concatenate([ends >> _KEY_SHIFT, context]), [np.concatenate([left, none(len(context))]), *(np.concatenate([none(len(ends)), f]) for f in follow)])
        out = [{"kind": _PAIR, "part": part, "keys": pack_sorted(below(keys, KEY_BITS, bits), KEY_BITS - bits), "values": [_counts(v) for v in values], "stats": _of_counts(left)}]
        both = apart(ends)
        v, w, one = both >> np.uint64(32), both & _LOW, np.ones(len(both), dtype=np.int64)
        figures = [none(len(v)), left, left == 1, left == 2, one]
        ids, sums = added(np.concatenate([w, v]), [np.concatenate([one if i == 0 else none(len(w)), np.asarray(f, dtype=np.int64)]) for i, f in enumerate(figures)])
        return _messages(out + _dealt(_WORD, -1, ids, sums, bits, 32))

    def add_words(table: pa.Table) -> pa.Table:
        keys, values = added(*_read(table, bits, 32))
        return _messages([{"kind": _WORD, "part": table.column("part")[0].as_py(), "keys": pack_sorted(below(keys, 32, bits), 32 - bits), "values": [_counts(v) for v in values], "stats": _of_counts(values[0])}])

    words = written(texts.groupBy("block").applyInArrow(count_words, _MESSAGE).groupBy("part").applyInArrow(common, _MESSAGE), "words")
    ids = _cogrouped(texts.groupBy("block").applyInArrow(ask_words, _MESSAGE), words, ["part"], lambda asked, table: _answer_words(asked, table, bits), _MESSAGE)
    # What the shards tell each other is deleted as soon as it is added up.
    counted = _cogrouped(texts, ids, ["block"], count_grams, _MESSAGE).groupBy("part").applyInArrow(add_triples, _MESSAGE)
    triples, told, drop = _table_and_told(counted, "trigrams", _TRIPLE)
    pairs, ends, drop_ends = _table_and_told(told.groupBy("part").applyInArrow(add_pairs, _MESSAGE), "bigrams", _PAIR)
    drop()
    singles = written(ends.groupBy("part").applyInArrow(add_words, _MESSAGE), "continuations")
    drop_ends()
    tables = [triples, pairs, singles]
    figures = [t.select(*[F.sum(F.col("stats")[i]) for i in range(6)]).first() for t in tables]
    discounts = tuple(_discounts(list(f)) for f in figures)
    n1, n2, _, _, distinct, total = figures[2]
    left = float(discounts[2] @ [0, n1, n2, distinct - n1 - n2])
    return Model(bits, words, tables[0].unionByName(tables[1]).unionByName(tables[2]), discounts, total, distinct, left)


def with_scores(docs: DataFrame, model: Model | None, text_col: str = "text", columns: list[str] | None = None, size: int | None = None, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """``columns`` (default: all), then ``n_tokens`` and ``log10_prob`` of the text (0 without a model).

    Blocks of rows ask the shards of the model for the ids of their distinct words, then
    for the counts of their distinct words, bigrams and trigrams. Of several turns, each
    (its number, and how many there are) has the rows of blocks of its own.
    """
    names, columns = docs.columns, docs.columns if columns is None else columns
    text = f"c{names.index(text_col)}"
    kept = [f"c{names.index(c)}" for c in columns]
    rows = bounded_batches(docs).toDF(*[f"c{i}" for i in range(len(names))])
    schema = T.StructType([*[T.StructField(k, rows.schema[k].dataType) for k in kept], *T.StructType.fromDDL("n_tokens long, log10_prob double").fields])
    rows = _blocks(rows, rows.columns, _size(rows, text) if size is None else size)
    if turn[1] > 1:
        rows = rows.filter(F.pmod("block", F.lit(turn[1])) == turn[0])
    output = [*kept, "n_tokens", "log10_prob"]

    def scored_rows(table: pa.Table, block: _Block, logs: np.ndarray) -> pa.Table:
        sums = np.add.reduceat(logs, block.firsts) if len(logs) else logs
        return pa.Table.from_arrays([*[table.column(k) for k in kept], pa.array(block.counts, pa.int64()), pa.array(sums)], output)

    if model is None:

        def unjudged(table: pa.Table) -> pa.Table:
            block = _Block(_whole(table.column(text)))
            return scored_rows(table, block, np.zeros(int(block.counts.sum())))

        return rows.groupBy("block").applyInArrow(unjudged, schema).toDF(*columns, "n_tokens", "log10_prob")

    bits, least = model.bits, Model(model.bits, None, None, model.discounts, model.total, model.distinct, model.left)

    def ask_words(table: pa.Table) -> pa.Table:
        return _messages(_words_of(_whole(table.column(text)), table.column("block")[0].as_py(), bits, False))

    def wanted(u, v, w):
        """Keys of the words, bigrams and trigrams of all tokens, those of the marks at a start behind."""
        return np.append(w, _START), np.append(pair(v, w), pair(_START[None], _START[None])) >> _KEY_SHIFT, triple(pair(u, v), w, bits)

    def ask_grams(table: pa.Table, answers: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return _messages([])
        number = table.column("block")[0].as_py()
        words, pairs, triples = (grouped(np.sort(keys))[0] for keys in wanted(*_Block(_whole(table.column(text))).grams(*_ids(answers, bits))))
        out = _dealt(_WORD, number, words, [], bits, 32) + _dealt(_PAIR, number, pairs, [], bits, KEY_BITS) + _dealt(_TRIPLE, number, triples, [], bits, KEY_BITS)
        own = [{**r, "kind": _SELF, "values": [np.int64(r["part"]).tobytes()], "part": number} for r in answers.to_pylist()]
        return _messages(out + own)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return table.select(kept).append_column("n_tokens", pa.array([], pa.int64())).append_column("log10_prob", pa.array([], pa.float64()))
        block = _Block(_whole(table.column(text)))
        own = answers.filter(pc.equal(answers.column("kind"), _SELF)).to_pylist()
        ids = _ids(_messages([{**r, "part": int(np.frombuffer(r["values"][0], dtype=np.int64)[0]), "values": None} for r in own]), bits)
        keys = list(wanted(*block.grams(*ids)))
        (words, last_word), (pairs, last_pair), (triples, each) = (placed(keys.pop(0)) for _ in range(3))
        c1, *of_v = _answered(answers, _WORD, len(words), 5)
        c2, *of_uv = _answered(answers, _PAIR, len(pairs), 5)
        (c3,) = _answered(answers, _TRIPLE, len(triples), 1)
        # The context of a token ends with the token before it, or is that of a start.
        first_word, first_pair = (block.before(place[:-1], place[-1]) for place in (last_word, last_pair))
        of_v, of_uv, p1 = least.context(1, *of_v), least.context(0, *of_uv), least.word(c1)
        logs = np.empty(len(each))
        for begin in range(0, len(logs), _STEP):
            i = slice(begin, min(begin + _STEP, len(logs)))
            p2 = least.share(1, c2[last_pair[i]], *(x[first_word[i]] for x in of_v), p1[last_word[i]])
            logs[i] = np.log10(least.share(0, c3[each[i]], *(x[first_pair[i]] for x in of_uv), p2))
        return scored_rows(table, block, logs)

    ids = _cogrouped(rows.groupBy("block").applyInArrow(ask_words, _MESSAGE), model.words, ["part"], lambda asked, table: _answer_words(asked, table, bits), _MESSAGE)
    asked = _cogrouped(rows, ids, ["block"], ask_grams, _MESSAGE)
    told = _cogrouped(asked, model.tables, ["kind", "part"], lambda asked, table: _answer_grams(asked, table, bits), _MESSAGE)
    return _cogrouped(rows, told, ["block"], score, schema).toDF(*columns, "n_tokens", "log10_prob")


def _held(figures: DataFrame) -> DataFrame:
    """A written table of one row per language, broadcast if it is as short as it should be."""
    rows = written(figures, "figures")
    return F.broadcast(rows) if rows.count() <= MAX_LANGUAGES else rows


def judged(scored: DataFrame, labels: DataFrame, sample_ids: DataFrame, id_col: str, lang_col: str, label_col: str, quantile: float = QUANTILE, least: int = LEAST) -> DataFrame:
    """``perplexity``, ``level``, ``highest`` and ``keep`` behind the scored rows."""
    raw = -F.col("log10_prob") / F.col("n_tokens")
    drawn = lambda middle: (-F.col("log10_prob") + PRIOR_TOKENS * middle) / (F.col("n_tokens") + PRIOR_TOKENS)
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("_id")).distinct().join(sample_ids.select(F.col("id").alias("_id")), "_id", "left_anti")
    language = F.coalesce(lang_col, F.lit("")).alias("_lang")
    trusted = scored.select(F.col(id_col).alias("_id"), language, "log10_prob", "n_tokens").join(good, "_id", "left_semi")
    middles = lambda rows: rows.agg(F.percentile_approx(raw, 0.5, 10_000).alias("_middle"), F.count(F.lit(1)).alias("_n"))
    of_all = middles(trusted).first()["_middle"]
    per_language = _held(middles(trusted.groupBy("_lang")).filter(F.col("_n") >= least).select("_lang", "_middle"))
    middle = F.coalesce("_middle", F.lit(of_all).cast("double"))
    levels = trusted.join(per_language, "_lang", "left").withColumn("_level", drawn(middle))
    bounds = lambda rows: rows.agg(F.percentile_approx("_level", quantile, 10_000).alias("_q"))
    bound_of_all = bounds(levels).first()["_q"]
    figures = _held(per_language.join(bounds(levels.groupBy("_lang")), "_lang"))
    rows = scored.withColumn("_lang", language).join(figures, "_lang", "left").withColumn("_level", drawn(middle))
    highest = F.coalesce("_q", F.lit(bound_of_all).cast("double"))
    return rows.select(
        *scored.columns,
        F.pow(F.lit(10.0), raw).alias("perplexity"),
        F.col("_level").alias("level"),
        highest.alias("highest"),
        F.coalesce(F.col("_level") <= highest, F.lit(True)).alias("keep"),
    )


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", columns: list[str] | None = None, quantile: float = QUANTILE, max_docs: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """``columns`` of all documents (default: id and language) with the verdict on each.

    The model is learnt from all trusted documents outside the held quarter, or, where
    ``max_docs`` or ``max_bytes`` is given, from the ``trusted_sample`` within these bounds.
    """
    columns = columns or [id_col, lang_col]
    spark, size, texts = docs.sparkSession, _size(docs, text_col), Scratch(docs.sparkSession)
    with shuffles_dropped(spark):
        if max_docs is None and max_bytes is None:
            learnt = written(trusted_ids(docs, labels, id_col, label_col), "learnt")
            model = train(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), size, learnt)
        else:
            sample = texts.keep(trusted_sample(docs, labels, id_col, text_col, label_col, max_docs or 1 << 30, max_bytes or 1 << 60), "trusted")
            learnt = written(sample.select("id").distinct(), "learnt")
            model = train(sample, size)
            texts.drop()
        narrow = docs.select(*dict.fromkeys([*columns, text_col]))
        turns = min(TURNS, _n_blocks(size))
        scored = reduce(DataFrame.union, [written(with_scores(narrow, model, text_col, columns, size, (i, turns)), "scored") for i in range(turns)])
    trusted = scored.select(F.col(id_col).alias("id")).join(labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("id")), "id", "left_semi")
    if model is None and not trusted.isEmpty():
        warnings.warn("no trusted document outside the held quarter of the ids: no model, every document is kept", stacklevel=2)
    elif model and trusted.join(learnt, "id", "left_anti").isEmpty():
        warnings.warn("every trusted document is in the sample: no quantile, every document is kept", stacklevel=2)
    return judged(scored, labels, learnt, id_col, lang_col, label_col, quantile)


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", **options
) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    The columns go by number meanwhile, so none can clash with a figure of the verdict. It
    follows from language and text, so their hashes (two, of 64 bits) name the rejected rows,
    and texts are not written with their scores.
    """
    names = docs.columns
    number = {name: f"_{i}" for i, name in enumerate(names)}
    plain = docs.toDF(*number.values())
    lang, text = number[lang_col], number[text_col]
    plain = plain.withColumns({"_one": F.xxhash64(lang, text), "_two": F.xxhash64(text, F.octet_length(text), lang)})
    marked = labels.select(F.col(id_col).alias(number[id_col]), label_col)
    found = classify(plain, marked, number[id_col], text, lang, label_col, columns=[number[id_col], lang, "_one", "_two"], **options)
    rejected = written(found.filter(~F.col("keep")).select("_one", "_two").distinct(), "rejected")
    return plain.join(rejected, ["_one", "_two"], "left_anti").select(*number.values()).toDF(*names)
