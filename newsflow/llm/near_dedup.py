"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is a weighted set of shingles of ``SHINGLE`` words; the weight of a shingle is
how often the document has it. Every shingle sends arrivals of a Poisson process whose
rate is its weight, each to a random register; a register keeps the shingle that arrives
first. Shingles arrive in rounds, and one drops out when its next arrival is later than
the last register was filled. Two documents agree in a register with the probability
Jaccard similarity of their weighted shingles (for equal weights: the Jaccard similarity).

Candidates agree in a whole band of registers. The similarity of candidates is then worked
out from their shingles. What follows keeps groups of copies cheap and loses no link:

- texts with the same words are one class from the start, and only its first id goes on;
- every band bucket links its documents to its first one; components of these
  (unverified) links hold all candidate pairs, and each is verified by one task, which
  joins documents until no pair of different classes is similar; it emits a tree;
- components above ``GROUP`` documents are cut into blocks; tasks get those pairs of
  blocks that meet in a bucket. Components of all trees are the classes.

With 24 bands of 5 registers a pair of similarity 0.8 is a candidate with probability
0.99993. Pairs whose registers agree in a share 0.15 below the threshold (four standard
errors) are not worked out.

Defined results: a document with fewer words than a shingle, but any, is one shingle;
documents without words are each their own class. Rows with one id belong together; rows
without an id take the class of their text if a row with an id has it, otherwise none.
Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from newsflow.llm.bytewords import Words, mix, slices, span_hash, window_hash
from newsflow.llm.components import components
from newsflow.llm.tasks import keyed_texts, map_texts, written

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND = 24, 5
#: Documents that one task verifies together at most.
GROUP = 1024
_SLACK = 0.15
#: Bits of a shingle's hash that name it.
_BITS = 42
_STEP, _FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x9FB21C651E98DF25)


class Shingles:
    """Distinct shingles of every document of a slice, with weights, sorted by document."""

    def __init__(self, column: pa.Array, size: int = SHINGLE):
        words = Words(column)
        hashed = words.hashes()
        starts, doc = words.window_starts(size)
        whole = np.flatnonzero((words.counts > 0) & (words.counts < size))
        hashes = np.concatenate([window_hash(hashed, starts, size), span_hash(hashed, words.first[whole], words.first[whole + 1])])
        keys = np.concatenate([doc, whole]).astype(np.uint64) << np.uint64(_BITS) | hashes >> np.uint64(64 - _BITS)
        keys.sort()
        new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
        at = np.flatnonzero(new)
        self.weights = np.diff(np.append(at, len(keys))).astype(np.float64)
        self.names = keys[at] & np.uint64((1 << _BITS) - 1)
        self.docs = (keys[at] >> np.uint64(_BITS)).astype(np.int64)
        self.n = len(column)
        self.first = np.searchsorted(self.docs, np.arange(self.n + 1))
        self.sizes = np.diff(self.first)
        self.whole_hash = span_hash(hashed, words.first[:-1], words.first[1:])
        #: A second digest of the words: an order-free sum over the windows.
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(keys & np.uint64((1 << _BITS) - 1)))])
        edge = np.searchsorted(keys, np.arange(self.n + 1, dtype=np.uint64) << np.uint64(_BITS))
        self.sum_hash = sums[edge[1:]] - sums[edge[:-1]]

    def of(self, doc: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.first[doc], self.first[doc + 1])
        return self.names[span], self.weights[span]


def signatures(shingles: Shingles, registers: int = BANDS * BAND) -> np.ndarray:
    """The shingle that arrives first in every register; zero for documents without any."""
    arrival = np.full(shingles.n * registers, np.inf)
    winner = np.zeros(shingles.n * registers, dtype=np.uint64)
    doc, name, weight = shingles.docs, shingles.names, shingles.weights
    now, turn = np.zeros(len(doc)), 0
    while len(doc):
        # A few arrivals at a time once only slow registers are left.
        several = 1 if turn < 4 else 16
        ticks = (np.arange(1, several + 1, dtype=np.uint64) + np.uint64(turn)) * _STEP
        random = mix(name[:, None] * _FOLD + ticks[None, :])
        gaps = -np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[:, None]
        times = now[:, None] + np.cumsum(gaps, axis=1)
        slot = doc[:, None] * registers + (mix(random) % np.uint64(registers)).astype(np.int64)
        flat_slot, flat_time = slot.ravel(), times.ravel()
        np.minimum.at(arrival, flat_slot, flat_time)
        won = arrival[flat_slot] == flat_time
        winner[flat_slot[won]] = np.repeat(name, several)[won]
        turn += several
        last = arrival.reshape(shingles.n, registers).max(axis=1)
        active = times[:, -1] < last[doc]
        doc, name, weight, now = doc[active], name[active], weight[active], times[active, -1]
    return winner.reshape(shingles.n, registers)


def band_keys(found: np.ndarray, bands: int = BANDS, band: int = BAND) -> np.ndarray:
    keys = np.zeros((len(found), bands), dtype=np.uint64)
    for i in range(band):
        keys = mix(keys * _FOLD + found[:, i::band][:, :bands] + np.uint64(1))
    return keys


def probability_jaccard(a: tuple, b: tuple) -> float:
    """Probability Jaccard similarity of two weighted sets ``(sorted names, weights)``."""
    names = np.union1d(a[0], b[0])
    if not len(names):
        return 0.0
    x, y = np.zeros(len(names)), np.zeros(len(names))
    x[np.searchsorted(names, a[0])], y[np.searchsorted(names, b[0])] = a[1], b[1]
    ratio = np.full(len(names), np.inf)
    np.divide(y, x, out=ratio, where=x > 0)
    order = np.argsort(ratio)
    x, y = x[order], y[order]
    left, right = np.cumsum(x), y.sum() - np.cumsum(y)
    both = (x > 0) & (y > 0)
    # Below or at the own ratio x counts most, above it y.
    return float((1.0 / (left[both] / x[both] + right[both] / y[both])).sum())


def verified_tree(ids: list, column: pa.Array, similarity: float = SIMILARITY, registers: int = BANDS * BAND) -> list[tuple]:
    """Links that join all documents of a group into their classes: one less than members."""
    shingles, own = [], []
    for part in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text"):
        found = Shingles(part.column(0))
        own.append(signatures(found, registers).astype(np.uint32))
        shingles += [found.of(d) for d in range(found.n)]
    marks, n = np.concatenate(own), len(ids)
    root = np.arange(n)

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i in range(n):
        agree = (marks[i + 1 :] == marks[i]).mean(axis=1) if i + 1 < n else np.zeros(0)
        likely = np.flatnonzero(agree >= similarity - _SLACK)
        for j in i + 1 + likely[np.argsort(-agree[likely], kind="stable")]:
            a, b = top(i), top(int(j))
            if a != b and len(shingles[i][0]) and len(shingles[j][0]) and probability_jaccard(shingles[i], shingles[j]) >= similarity:
                root[max(a, b)] = min(a, b)
                links.append((ids[i], ids[j]))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, group: int = GROUP) -> DataFrame:
    """``id, class_id``: the smallest id of the class of each row's text."""
    texts = keyed_texts(docs, id_col, text_col)
    id_type = texts.schema["id"].dataType.simpleString()

    def sketch():
        def apply(batch):
            found = Shingles(batch.column("text"))
            keys = band_keys(signatures(found)).view(np.int64)
            return {
                "words": pa.array(found.whole_hash.view(np.int64)),
                "bag": pa.array(found.sum_hash.view(np.int64)),
                "n": pa.array(found.sizes, pa.int32()),
                "keys": pa.array(list(keys), pa.list_(pa.int64())),
            }

        return apply

    rows = written(map_texts(texts, "id", "text", "words long, bag long, n int, keys array<long>", sketch), "sketches")
    same = rows.filter("n > 0").groupBy("words", "bag")
    first = same.agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "keys"))).alias("f"))
    classes = written(first.filter("f.id is not null").select("words", "bag", "f.id", "f.keys"), "classes")

    bands = classes.select("id", F.posexplode("keys").alias("band", "key"))
    buckets = bands.groupBy("band", "key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    stars = bands.join(buckets, ["band", "key"]).filter("id <> first").select("id", "first")
    loose = components(stars, "id", "first")
    sized = written(loose.join(loose.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "component"), "loose")

    small = sized.filter(F.col("size") <= group).select("node", F.struct("component", F.lit(0).alias("p"), F.lit(0).alias("q")).alias("task"))
    half = group // 2
    cut = sized.filter(F.col("size") > group).withColumn("block", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / half)).cast("int"))
    met = bands.join(cut, bands["id"] == cut["node"]).select("component", "band", "key", "block").distinct()
    pairs = (
        met.alias("a")
        .join(met.withColumnRenamed("block", "other").alias("b"), ["component", "band", "key"])
        .filter("block <= other")
        .select("component", F.col("block").alias("p"), F.col("other").alias("q"))
        .distinct()
    )
    sides = pairs.select("component", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    large = cut.join(sides, ["component", "block"]).select("node", F.struct("component", "p", "q").alias("task"))

    def verify(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        links = verified_tree([ids[i] for i in order], table.column("text").take(pa.array(order)).combine_chunks(), similarity)
        kind = table.schema.field("id").type
        return pa.table({"a": pa.array([a for a, _ in links], kind), "b": pa.array([b for _, b in links], kind)})

    grouped = texts.filter("id is not null").join(small.unionByName(large).withColumnRenamed("node", "id"), "id").select("id", "text", "task")
    links = grouped.groupBy("task").applyInArrow(verify, f"a {id_type}, b {id_type}")
    joined = components(links, "a", "b").withColumnRenamed("node", "id")
    named = classes.select("words", "bag", "id").join(joined, "id", "left").select("words", "bag", F.coalesce("component", "id").alias("class_id"))
    answer = rows.select("id", "words", "bag", "n").join(named, ["words", "bag"], "left")
    return answer.select(F.col("id").alias(id_col), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"))


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All columns of one document per class, the one with the smallest id.

    Rows without an id cannot be told apart by one and all stay.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    stays = found.filter(F.col(id_col).eqNullSafe(F.col("class_id"))).select(F.col(id_col).alias("_stays")).distinct()
    joined = docs.join(stays, docs[id_col].eqNullSafe(F.col("_stays")), "left_semi")
    order = Window.partitionBy(id_col).orderBy(text_col)
    return joined.withColumn("_nth", F.row_number().over(order)).filter((F.col("_nth") == 1) | F.col(id_col).isNull()).drop("_nth")
