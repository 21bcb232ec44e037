"""Clusters around centroids, with a vector-approximation file.

Every vector is stored whole and, beside it, as a few bits per dimension that name the
cell its component lies in. The edges of the cells follow the mean and spread of each
dimension over all vectors. For a set of centroids, two tables say how near and how far a
cell of a dimension is at least and at most; summed over a vector's cells they give an
interval for its distance to each centroid. Where one interval lies below all others, the
nearest centroid is known from the cells; only else the whole vector is fetched and the
centroids whose intervals overlap are compared exactly.

The first round reads cells and vectors together, since its sums need every vector, and so
does the last pass, as it returns exact distances. The rounds between read the cells alone
and fetch, by row number, the vectors whose intervals overlap and those that change their
cluster: sums are carried over and move with them. All figures are integers, so rounds are
exact and do not depend on the order of rows.

Defined results: vectors that are missing, have another number of components or hold
missing or non-finite ones do not take part; a vector without id is never a start, but is
put into a cluster; repeated rows are vectors each, and as starts they are ordered by their
components; an empty table, or one without any id, gives no rows. Components of 2 ** 27
or more after scaling are refused with an error, as distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.tasks import bounded_batches, written

LARGEST = 2**27
#: Bits of a cell.
BITS = 6
#: Vectors and centroids that are compared in one go.
PAIRS = 8192


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, wide: int, scale: int) -> DataFrame:
    """``id, x`` of the vectors that take part, ``x`` as integers."""
    given = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    usable = given.filter((F.size("v") == wide) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    too_large = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling"))
    return usable.select("id", F.transform("v", lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(too_large.cast("bigint")).cast("int")).alias("x"))


def matrix(batch: pa.RecordBatch, wide: int, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, wide)


@dataclass(frozen=True)
class Cells:
    """The cells of every dimension: ``edges[d]`` begin all but the first, and the least
    and largest components bound the outer ones."""

    bits: int
    edges: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(stats: list, bits: int) -> Cells:
        """From rows ``d, n, total, squares, least, most``, one per dimension."""
        cut = [NormalDist().inv_cdf(i / (1 << bits)) for i in range(1, 1 << bits)]
        edges, least, most = [], [], []
        for row in sorted(stats, key=lambda r: r["d"]):
            mean = float(row["total"]) / row["n"]
            spread = max(float(row["squares"]) / row["n"] - mean * mean, 0.0) ** 0.5
            edges.append([int(np.ceil(min(max(mean + z * spread, row["least"]), row["most"]))) for z in cut])
            least.append(row["least"])
            most.append(row["most"])
        edges = np.array(edges, dtype=np.int64)
        return Cells(bits, edges, np.column_stack([least, edges]), np.column_stack([edges - 1, most]))

    def pack(self, x: np.ndarray) -> list[bytes]:
        cell = np.stack([np.searchsorted(e, x[:, d], side="right") for d, e in enumerate(self.edges)], axis=1).astype(np.uint8)
        bit = (cell[:, :, None] >> np.arange(self.bits, dtype=np.uint8)) & 1
        return [row.tobytes() for row in np.packbits(bit.reshape(len(x), -1), axis=1)]

    def unpack(self, packed: pa.Array) -> np.ndarray:
        wide = len(self.edges)
        each = -(-wide * self.bits // 8)
        data = np.frombuffer(b"".join(packed.to_pylist()), dtype=np.uint8).reshape(-1, each)
        bit = np.unpackbits(data, axis=1, count=wide * self.bits).reshape(len(data), wide, self.bits)
        return (bit.astype(np.int64) << np.arange(self.bits)).sum(axis=2)

    def intervals(self, centroids: np.ndarray) -> np.ndarray:
        """Per dimension, cell and centroid the least and the largest squared difference."""
        c = centroids.T[:, None, :]
        low, high = self.low[:, :, None] - c, self.high[:, :, None] - c
        most = np.maximum(low**2, high**2)
        least = np.where((low <= 0) & (high >= 0), 0, np.minimum(low**2, high**2))
        return np.concatenate([least, most], axis=2).reshape(-1, 2 * len(centroids))

    def candidates(self, cells: np.ndarray, tables: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Which centroids may be the nearest of each vector.

        Where intervals overlap, the difference to the centroid with the lowest upper end
        is bounded as well: it is linear in the vector, so near centroids cancel out.
        """
        k = len(centroids)
        at = cells + (np.arange(cells.shape[1]) << self.bits)
        bounds = tables[at].sum(axis=1)
        first = bounds[:, k:].argmin(axis=1)
        may = bounds[:, :k] <= bounds[np.arange(len(cells)), k + first][:, None]
        row, c = np.nonzero(may & (may.sum(axis=1) > 1)[:, None] & (np.arange(k) != first[:, None]))
        dims = np.arange(cells.shape[1])
        for some in np.array_split(np.arange(len(row)), -(-len(row) // PAIRS) or 1):
            own, other, cell = centroids[c[some]], centroids[first[row[some]]], cells[row[some]]
            apart = own - other
            end = np.where(apart > 0, self.high[dims, cell], self.low[dims, cell])
            farther = (apart * (own + other - 2 * end)).sum(axis=1) > 0
            may[row[some][farther], c[some][farther]] = False
        return may


def _nearest(x: np.ndarray, may: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster of every vector, exact among its candidates, and how many were compared."""
    cluster = may.argmax(axis=1)
    open_ = np.flatnonzero(may.sum(axis=1) > 1)
    far = np.iinfo(np.int64).max
    exact = np.full((len(open_), len(centroids)), far)
    for c in range(len(centroids)):
        some = np.flatnonzero(may[open_, c])
        exact[some, c] = ((x[open_[some]] - centroids[c]) ** 2).sum(axis=1)
    cluster[open_] = exact.argmin(axis=1)
    return cluster, open_


class _Moves:
    """Sums and counts that clusters gain and lose within a task."""

    SCHEMA = "sums array<long>, gained long"

    def __init__(self, k: int, wide: int):
        self.sums, self.gained = np.zeros((k, wide), dtype=np.int64), np.zeros(k, dtype=np.int64)

    def add(self, cluster: np.ndarray, x: np.ndarray, sign: int) -> None:
        np.add.at(self.sums, cluster, sign * x)
        np.add.at(self.gained, cluster, sign)

    def rows(self) -> list[tuple[int, list[int], int]]:
        changed = np.flatnonzero((self.gained != 0) | (self.sums != 0).any(axis=1))
        return [(int(c), self.sums[c].tolist(), int(self.gained[c])) for c in changed]


_STATE = "row long, cells binary, cluster int, sums array<long>, gained long"
_ARROW = pa.schema([("row", pa.int64()), ("cells", pa.binary()), ("cluster", pa.int32()), ("sums", pa.list_(pa.int64())), ("gained", pa.int64())])


def _assigned(row, cells, cluster) -> pa.RecordBatch:
    n = len(cluster)
    return pa.RecordBatch.from_arrays([row, cells, pa.array(cluster, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.int64())], schema=_ARROW)


def _moved(moves: _Moves) -> pa.RecordBatch:
    rows = moves.rows()
    return pa.RecordBatch.from_pydict({"row": [None] * len(rows), "cells": [None] * len(rows), "cluster": [c for c, _, _ in rows], "sums": [s for _, s, _ in rows], "gained": [g for _, _, g in rows]}, schema=_ARROW)


class Clustering:
    """The stored vectors with their cells, and the rounds over them."""

    def __init__(self, rows: DataFrame, id_col: str, vec_col: str, wide: int = 64, scale: int = 64, bits: int = BITS):
        self.id_col, self.wide = id_col, wide
        vectors = bounded_batches(whole_vectors(rows, id_col, vec_col, wide, scale))
        stats = vectors.select("x").mapInArrow(self._statistics, "d int, n long, total decimal(38,0), squares decimal(38,0), least long, most long")
        stats = stats.groupBy("d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("least").alias("least"), F.max("most").alias("most")).collect()
        self.cells = Cells.of(stats, bits) if stats else None
        if self.cells:
            id_type = vectors.schema["id"].dataType.simpleString()
            packed = vectors.mapInArrow(self._packed, f"id {id_type}, x array<int>, cells binary")
            self.stored = written(packed.withColumn("row", F.monotonically_increasing_id()), "vectors")

    def _statistics(self, batches):
        from decimal import Decimal

        n, total, squares = 0, 0, 0
        least = most = None
        for batch in batches:
            x = matrix(batch, self.wide)
            if not len(x):
                continue
            n += len(x)
            # Python integers: squares of many large components do not fit a long.
            total = total + x.sum(axis=0).astype(object)
            squares = squares + (x**2).astype(np.float64).sum(axis=0).astype(object)
            least = x.min(axis=0) if least is None else np.minimum(least, x.min(axis=0))
            most = x.max(axis=0) if most is None else np.maximum(most, x.max(axis=0))
        if n:
            whole = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(self.wide), pa.int32()), pa.array([n] * self.wide, pa.int64()), pa.array([Decimal(int(t)) for t in total], whole), pa.array([Decimal(int(t)) for t in squares], whole), pa.array(least, pa.int64()), pa.array(most, pa.int64())],
                ["d", "n", "total", "squares", "least", "most"],
            )

    def _packed(self, batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(self.cells.pack(matrix(batch, self.wide)), pa.binary())], ["id", "x", "cells"])

    def starts(self, k: int, seed: int) -> np.ndarray:
        """The ``k`` vectors whose id comes first by digest, in that order."""
        keyed = self.stored.filter("id is not null").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("key"), "x")
        return np.array([r["x"] for r in keyed.orderBy("key", "x").limit(k).collect()], dtype=np.int64).reshape(-1, self.wide)

    def first_round(self, centroids: np.ndarray) -> DataFrame:
        """Assignments of all vectors and their sums, in one pass over cells and vectors."""
        cells, wide, tables = self.cells, self.wide, self.cells.intervals(centroids)

        def run(batches):
            moves = _Moves(len(centroids), wide)
            for batch in batches:
                x = matrix(batch, wide)
                cluster, _ = _nearest(x, cells.candidates(cells.unpack(batch.column("cells")), tables, centroids), centroids)
                moves.add(cluster, x, 1)
                yield _assigned(batch.column("row"), batch.column("cells"), cluster)
            yield _moved(moves)

        return written(self.stored.select("row", "cells", "x").mapInArrow(run, _STATE), "round")

    def judged(self, state: DataFrame, centroids: np.ndarray) -> DataFrame:
        """What the cells alone say: ``row, cells, before, cluster, candidates``; the
        candidates are empty where the cluster is known."""
        cells, tables = self.cells, self.cells.intervals(centroids)

        def run(batches):
            for batch in batches:
                may = cells.candidates(cells.unpack(batch.column("cells")), tables, centroids)
                known = may.sum(axis=1) == 1
                left = [[] if k else np.flatnonzero(m).tolist() for k, m in zip(known.tolist(), may)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("cells"), batch.column("cluster"), pa.array(np.where(known, may.argmax(axis=1), -1), pa.int32()), pa.array(left, pa.list_(pa.int32()))],
                    ["row", "cells", "before", "cluster", "candidates"],
                )

        seen = state.filter("row is not null").select("row", "cells", "cluster")
        return written(seen.mapInArrow(run, "row long, cells binary, before int, cluster int, candidates array<int>"), "judged")

    def settled(self, judged: DataFrame, centroids: np.ndarray) -> DataFrame:
        """Fetch the vectors that are undecided or move: clusters of the former, and what
        all of them add to and take from the sums."""
        wide, k = self.wide, len(centroids)

        def run(batches):
            moves = _Moves(k, wide)
            for batch in batches:
                x, cluster = matrix(batch, wide), batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                may = np.zeros((len(x), k), dtype=bool)
                for i, some in enumerate(batch.column("candidates").to_pylist()):
                    may[i, some or [cluster[i]]] = True
                open_ = cluster < 0
                cluster, _ = _nearest(x, may, centroids)
                before = batch.column("before").to_numpy(zero_copy_only=False)
                gone = cluster != before
                moves.add(cluster[gone], x[gone], 1)
                moves.add(before[gone], x[gone], -1)
                mask = pa.array(open_)
                yield _assigned(batch.column("row").filter(mask), batch.column("cells").filter(mask), cluster[open_])
            yield _moved(moves)

        fetched = judged.filter("cluster < 0 or cluster <> before").join(self.stored.select("row", "x"), "row")
        return written(fetched.select("row", "cells", "before", "cluster", "candidates", "x").mapInArrow(run, _STATE), "settled")

    def next_round(self, state: DataFrame, centroids: np.ndarray) -> tuple[DataFrame, DataFrame]:
        """Assignments of all vectors, and the rows of moves."""
        judged = self.judged(state, centroids)
        settled = self.settled(judged, centroids)
        return judged.filter("cluster >= 0").select("row", "cells", "cluster").unionByName(settled.filter("row is not null").select("row", "cells", "cluster")), settled

    def last_pass(self, centroids: np.ndarray) -> DataFrame:
        """``id, cluster, distance, centroid_sha256`` of every vector."""
        cells, wide, tables = self.cells, self.wide, self.cells.intervals(centroids)
        digests = np.array([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()], dtype=object)
        id_type = self.stored.schema["id"].dataType.simpleString()

        def run(batches):
            for batch in batches:
                x = matrix(batch, wide)
                cluster, _ = _nearest(x, cells.candidates(cells.unpack(batch.column("cells")), tables, centroids), centroids)
                distance = ((x - centroids[cluster]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), pa.array(digests[cluster], pa.string())], ["id", "cluster", "distance", "centroid_sha256"])

        return written(self.stored.select("id", "cells", "x").mapInArrow(run, f"id {id_type}, cluster int, distance long, centroid_sha256 string"), "clusters")


def _moved_totals(moves: DataFrame, sums: list[list[int]], counts: list[int]) -> None:
    """Add the moves of all tasks to the sums: as many figures as all centroids have."""
    each = moves.filter("row is null").select("cluster", "gained", F.posexplode("sums").alias("d", "s"))
    total = each.groupBy("cluster", "d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("gained").alias("gained"))
    for row in total.collect():
        sums[row["cluster"]][row["d"]] += int(row["s"])
        if row["d"] == 0:
            counts[row["cluster"]] += row["gained"]


def cluster_vectors(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 16,
    rounds: int = 3,
    wide: int = 64,
    scale: int = 64,
    seed: int = 1,
    bits: int = BITS,
) -> DataFrame:
    """``id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector.

    Components are scaled and floored to integers. The ``k`` vectors whose id comes first
    by SHA-256 of ``seed:id`` are the first centroids; each round puts every vector to the
    nearest centroid (the smaller number among equals) and moves a centroid to the floored
    mean of its vectors. Distances are squared.
    """
    work = Clustering(rows, id_col, vec_col, wide, scale, bits)
    centroids = work.starts(k, seed) if work.cells else np.zeros((0, wide))
    if not len(centroids):
        kind = rows.select(id_col).schema[0].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    sums, counts = [[0] * wide for _ in centroids], [0] * len(centroids)
    state = None
    for _ in range(rounds):
        if state is None:
            state = moves = work.first_round(centroids)
        else:
            state, moves = work.next_round(state, centroids)
        _moved_totals(moves, sums, counts)
        centroids = np.array([[s // n for s in total] if n else old for total, n, old in zip(sums, counts, centroids.tolist())], dtype=np.int64)
    final = work.last_pass(centroids)
    # One row per centroid, so it may be broadcast at any size of the table.
    each = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = each.agg(F.sum("cluster_inertia")).first()[0]
    joined = final.join(F.broadcast(each), "cluster")
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")
