"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Every test item yields its windows of consecutive words (an item with fewer words is one
window). Their hashes form sorted sets, one per window length, that every task holds; the
word windows of the documents are looked up, and a hit is compared word by word before it
counts. Hits cover words; spans of covered words can be cut out, or documents dropped.

The set is broadcast only up to ``max_windows`` windows, about 40 bytes each. A larger
benchmark goes through a join on the window hash instead, with the same results.

Defined results: a missing text has no words and hits nothing; an item without words has
no window and can't occur; items with the same id count once;
items without id hit like others, and together they count as one item, a null at the end of
``items`` that the digest of the ids leaves out; repeated documents are
judged each; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.bytewords import ALNUM_WORDS, Words, slices, window_hash
from newsflow.llm.tasks import filter_rows, keyed_texts, map_texts

WINDOW = 13
MAX_WINDOWS = 2_000_000
#: A document is contaminated from one hit word in so many on.
ONE_IN = 20


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct windows of the items: ``length, hash, window, items array<string>``."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), ALNUM_WORDS, lower=True)
                hashed, ids = words.hashes(), part.column("id").to_pylist()
                length, hashes, text, item = [], [], [], []
                for d, n in enumerate(words.counts):
                    k = min(size, int(n))
                    for start in range(words.first[d], words.first[d + 1] - k + 1) if k else ():
                        length.append(k)
                        hashes.append(int(window_hash(hashed, np.array([start]), k)[0].view(np.int64)))
                        text.append(b" ".join(words.text(i) for i in range(start, start + k)))
                        item.append(ids[d])
                yield pa.RecordBatch.from_arrays([pa.array(length, pa.int32()), pa.array(hashes, pa.int64()), pa.array(text, pa.binary()), pa.array(item, pa.string())], ["length", "hash", "window", "item"])

    narrow = keyed_texts(items, id_col, text_col).withColumn("id", F.col("id").cast("string"))
    rows = narrow.mapInArrow(run, "length int, hash long, window binary, item string")
    # collect_set leaves a missing id out; it is put behind the others.
    nameless = F.when(F.max(F.col("item").isNull()), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    return rows.groupBy("length", "hash", "window").agg(F.concat(F.sort_array(F.collect_set("item")), nameless).alias("items"))


class TestSet:
    """The windows as a task uses them: sorted hashes per length, then the words."""

    __test__ = False

    def __init__(self, rows: list):
        self.rows, self.by_length = rows, {}
        for length in {r["length"] for r in rows}:
            mine = sorted((np.array(r["hash"]).view(np.uint64).item(), i) for i, r in enumerate(rows) if r["length"] == length)
            hashes = np.array([h for h, _ in mine], dtype=np.uint64)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[length] = hashes, [i for _, i in mine], seen

    def hits(self, words: Words):
        """``(first word, length, row)`` of every verified occurrence."""
        hashed = words.hashes()
        for length, (hashes, rows, seen) in self.by_length.items():
            starts, _ = words.window_starts(length)
            found = window_hash(hashed, starts, length)
            likely = np.flatnonzero(seen[(found >> np.uint64(44)).astype(np.int64)])
            low = np.searchsorted(hashes, found[likely], side="left")
            high = np.searchsorted(hashes, found[likely], side="right")
            for j in np.flatnonzero(high > low):
                start = int(starts[likely[j]])
                text = b" ".join(words.text(i) for i in range(start, start + length))
                for k in range(low[j], high[j]):
                    if bytes(self.rows[rows[k]]["window"]) == text:
                        yield start, length, rows[k]


def _judged(words: Words, hits) -> dict:
    """Hit words, items and covered spans (word numbers, end exclusive) of every document."""
    covered = np.zeros(len(words.starts) + 1, dtype=np.int64)
    items: dict[int, set] = {}
    for start, length, names in hits:
        covered[start] += 1
        covered[start + length] -= 1
        items.setdefault(int(np.searchsorted(words.first, start, side="right")) - 1, set()).update(names)
    mask = np.cumsum(covered)[:-1] > 0
    total = np.concatenate([[0], np.cumsum(mask)])
    n_hit = total[words.first[1:]] - total[words.first[:-1]]
    spans = []
    for d in range(len(words.counts)):
        spans.append([])
        if n_hit[d]:
            own = np.concatenate([[False], mask[words.first[d] : words.first[d + 1]], [False]]).astype(np.int8)
            turns = np.flatnonzero(np.diff(own))
            spans[d] = [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
    return {
        "n_words": pa.array(words.counts, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "items": pa.array([sorted(items.get(d, ()), key=lambda i: (i is None, i)) for d in range(len(words.counts))], pa.list_(pa.string())),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    }


_COLUMNS = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``id, n_words, n_hit, items, spans`` of every document."""
    windows = item_windows(items, item_id, item_text, size)
    rows = windows.limit(max_windows + 1).collect()
    if len(rows) > max_windows:
        return _by_join(docs, windows, id_col, text_col)
    held = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in rows])

    def make():
        tests = TestSet(held.value)

        def apply(batch):
            words = Words(batch.column("text"), ALNUM_WORDS, lower=True)
            return _judged(words, ((s, n, tests.rows[r]["items"]) for s, n, r in tests.hits(words)))

        return apply

    return map_texts(docs, id_col, text_col, _COLUMNS, make)


def _by_join(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For a benchmark too large to broadcast: join on the hash, verify where the text is.

    Windows of documents travel as hashes; the words of the few that meet a test window
    go back to their document, found by a hash of the text, and are compared there.
    """
    lengths = [r[0] for r in windows.select("length").distinct().collect()]
    narrow = keyed_texts(docs, id_col, text_col).withColumn("body", F.xxhash64("text"))
    id_type = narrow.schema["id"].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), ALNUM_WORDS, lower=True)
                hashed = words.hashes()
                for length in lengths:
                    starts, doc = words.window_starts(length)
                    found = np.unique(np.stack([window_hash(hashed, starts, length).view(np.int64), doc]), axis=1)
                    yield pa.RecordBatch.from_arrays([part.column("body").take(pa.array(found[1])), pa.array(np.full(found.shape[1], length), pa.int32()), pa.array(found[0], pa.int64())], ["body", "length", "hash"])

    met = narrow.mapInArrow(scan, "body long, length int, hash long").distinct().join(windows, ["length", "hash"])
    per_text = met.groupBy("body").agg(F.collect_list(F.struct("length", "hash", "window", "items")).alias("rows"))

    def verify(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.slice(i, 1)
                words = Words(part.column("text"), ALNUM_WORDS, lower=True)
                tests = TestSet(part.column("rows").to_pylist()[0] or [])
                out = _judged(words, ((s, n, tests.rows[r]["items"]) for s, n, r in tests.hits(words)))
                yield pa.RecordBatch.from_arrays([part.column("id"), *out.values()], [id_col, *out])

    return narrow.join(per_text, "body", "left").select("id", "text", "rows").mapInArrow(verify, f"{id_col} {id_type}, {_COLUMNS}")


def contaminated(n_hit="n_hit", n_words="n_words", one_in: int = ONE_IN):
    """The rule for a whole document: hits make up at least one word in ``one_in``."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * one_in >= F.col(n_words))


def digest(rows: DataFrame) -> DataFrame:
    """The flat columns of a report: item count and digest of the item ids."""
    return rows.select(
        *[c for c in rows.columns if c not in ("items", "spans")],
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, all their columns unchanged.

    With a benchmark too large to broadcast, documents are told apart by their id; rows
    with one id (or none) then go or stay together.
    """
    item_id, item_text = options.get("item_id", "item_id"), options.get("item_text", "text")
    size, most = options.get("size", WINDOW), options.get("max_windows", MAX_WINDOWS)
    rows = item_windows(items, item_id, item_text, size).limit(most + 1).collect()
    if len(rows) > most:
        bad = contamination(docs, items, id_col, text_col, **options).filter(contaminated()).select(F.col(id_col).alias("_bad")).distinct()
        return docs.join(bad, docs[id_col].eqNullSafe(F.col("_bad")), "left_anti")
    held = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in rows])

    def make():
        tests = TestSet(held.value)

        def keep(batch):
            words = Words(batch.column("text"), ALNUM_WORDS, lower=True)
            judged = _judged(words, ((s, n, tests.rows[r]["items"]) for s, n, r in tests.hits(words)))
            n_words, n_hit = judged["n_words"].to_numpy(), judged["n_hit"].to_numpy()
            return ~((n_hit > 0) & (n_hit * ONE_IN >= n_words))

        return keep

    return filter_rows(docs, text_col, make)


def cut_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, max_windows: int = MAX_WINDOWS, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id, text`` with every hit span of words taken out, from its first to its last character."""
    rows = item_windows(items, item_id, item_text, size).limit(max_windows + 1).collect()
    if len(rows) > max_windows:
        raise ValueError("benchmark too large to cut spans in one pass; judge documents instead")
    held = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in rows])

    def make():
        tests = TestSet(held.value)

        def apply(batch):
            plain, words = Words(batch.column("text")), Words(batch.column("text"), ALNUM_WORDS, lower=True)
            drop = np.zeros(len(plain.bytes) + 1, dtype=np.int32)
            for start, length, _ in tests.hits(words):
                drop[words.starts[start]] += 1
                drop[words.ends[start + length - 1]] -= 1
            keep = np.cumsum(drop)[:-1] == 0
            cut = [plain.bytes[a:b][keep[a:b]].tobytes().decode() for a, b in zip(plain.offsets[:-1], plain.offsets[1:])]
            return {"text": pa.array(cut, pa.string())}

        return apply

    return map_texts(docs, id_col, text_col, "text string", make)
