"""Near-duplicate embeddings by navigable small-world graphs, one per shard.

Vectors meet only within one label. Identical vectors of a label become one
representative with a multiplicity. The representatives of a label fall into shards of at
most ``SHARD``; a task builds a hierarchical navigable small-world graph of its shard, in
batches that search the graph built so far. Then every shard is searched with the vectors
of its own and of every other shard of the label, in both directions, and what either
direction finds is verified by cosine in double precision.

Beams widen in two ways. A query whose beam holds only linked vectors may have more: its
beam doubles until some of it lies below the threshold or it holds the shard. And a sample
of the queries is compared with the whole shard: if fewer than ``RECALL`` of their links
were found, the beams of all queries of this pair of shards double and the search runs
again, up to beams as wide as the shard. From a quarter of the shard on, a beam is replaced
by the product with the whole shard, which is exact; small shards are never searched.

A task returns link counts and a tree of the links it found, never all pairs; components
of the trees are the groups.

Defined results: vectors that are missing, zero, or hold a missing or non-finite component
link with nothing, like vectors without a label; they are their own component. Vectors of
one label but different lengths do not meet. Rows with one id belong together, and count
as different vectors. Rows without an id are returned, alone. Other columns are not looked
at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsflow.llm.components import components
from newsflow.llm.tasks import written

COSINE = 0.93
#: Representatives in a shard at most, on average.
SHARD = 4096
DEGREE, BUILD_BEAM, BEAM = 12, 48, 48
RECALL, AUDITED = 0.99, 64
#: Slack of single precision while searching.
_SLACK = 1e-4


class Graph:
    """Levels of neighbour lists over unit vectors; level 0 has twice the degree."""

    def __init__(self, vectors: np.ndarray, neighbours: list[np.ndarray], members: list[np.ndarray], entry: int):
        self.vectors, self.neighbours, self.members, self.entry = vectors, neighbours, members, entry

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 7) -> Graph:
        n = len(vectors)
        random = np.random.default_rng(seed)
        level = np.minimum(6, (-np.log(random.random(n)) / np.log(degree)).astype(int))
        top = int(level.max())
        order = np.argsort(-level, kind="stable")
        neighbours = [np.full((n, degree * (2 if i == 0 else 1)), -1, dtype=np.int32) for i in range(top + 1)]
        graph = cls(vectors, neighbours, [np.flatnonzero(level >= i) for i in range(top + 1)], int(order[0]))
        done = 1
        while done < n:
            # Batches double, so that a batch searches at least as many vectors as it adds.
            batch = order[done : done + min(512, done)]
            entry = np.full(len(batch), graph.entry)
            for at in range(top, -1, -1):
                joins = level[batch] >= at
                if at and not joins.any():
                    entry = graph._beam(vectors[batch], entry[:, None], at, 1)[0][:, 0]
                    continue
                found, near = graph._beam(vectors[batch], entry[:, None], at, beam)
                graph._link(batch[joins], found[joins], near[joins], at)
                entry = found[:, 0]
            done += len(batch)
        return graph

    def _link(self, batch: np.ndarray, found: np.ndarray, near: np.ndarray, at: int) -> None:
        lists, width = self.neighbours[at], self.neighbours[at].shape[1]
        among = self.vectors[batch] @ self.vectors[batch].T
        np.fill_diagonal(among, -2)
        found = np.concatenate([found, np.where(among > -2, batch[None, :], -1)], axis=1)
        near = np.concatenate([near, among], axis=1)
        keep = min(found.shape[1], 3 * width)
        part = np.argpartition(-near, keep - 1, axis=1)[:, :keep]
        found, near = np.take_along_axis(found, part, 1), np.take_along_axis(near, part, 1)
        for row, node in enumerate(batch):
            lists[node] = self._spread(found[row], near[row], width)
        # The other direction: neighbours that are full choose again among old and new.
        source = np.repeat(batch, width)
        target = lists[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        ranked = np.argsort(target, kind="stable")
        source, target = source[ranked], target[ranked]
        for nodes in np.split(np.arange(len(target)), np.flatnonzero(np.diff(target)) + 1):
            if not len(nodes):
                continue
            node = target[nodes[0]]
            old = lists[node][lists[node] >= 0]
            every = np.union1d(old, source[nodes])
            if len(every) <= width:
                lists[node, : len(every)] = every
            else:
                lists[node] = self._spread(every, self.vectors[every] @ self.vectors[node], width)

    def _spread(self, found: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
        """Nearest neighbours that are not closer to a chosen one, then the nearest others."""
        order = np.argsort(-near)
        order = order[(near[order] > -1.5) & (found[order] >= 0)][: 3 * width]
        ids, score = found[order], near[order]
        among = self.vectors[ids] @ self.vectors[ids].T
        chosen: list[int] = []
        covered = np.full(len(ids), -2.0, dtype=np.float32)
        for i in range(len(ids)):
            if len(chosen) >= width * 3 // 4:
                break
            if covered[i] <= score[i]:
                chosen.append(i)
                np.maximum(covered, among[i], out=covered)
        mask = np.zeros(len(ids), dtype=bool)
        mask[chosen] = True
        rest = np.flatnonzero(~mask)[: width - len(chosen)]
        out = np.full(width, -1, dtype=np.int32)
        picked = ids[np.concatenate([np.array(chosen, dtype=int), rest])]
        out[: len(picked)] = picked
        return out

    def _beam(self, queries: np.ndarray, start: np.ndarray, at: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest vectors met by a best-first search, for many queries in step."""
        q, n = len(queries), len(self.vectors)
        lists = self.neighbours[at]
        seen = np.zeros((q, n), dtype=bool)
        rows = np.arange(q)
        ids = np.full((q, width), -1, dtype=np.int64)
        near = np.full((q, width), -2.0, dtype=np.float32)
        open_ = np.zeros((q, width), dtype=bool)
        s = min(start.shape[1], width)
        ids[:, :s] = start[:, :s]
        near[:, :s] = np.einsum("qd,qsd->qs", queries, self.vectors[start[:, :s]])
        open_[:, :s] = True
        seen[rows[:, None], start[:, :s]] = True
        live = rows
        while len(live):
            best = np.where(open_[live], near[live], -3.0)
            pick = best.argmax(axis=1)
            going = best[np.arange(len(live)), pick] > -2.5
            live, pick = live[going], pick[going]
            if not len(live):
                break
            open_[live, pick] = False
            fresh = lists[ids[live, pick]].astype(np.int64)
            new = (fresh >= 0) & ~seen[live[:, None], fresh]
            fresh = np.where(new, fresh, 0)
            row, col = np.nonzero(new)
            seen[live[row], fresh[row, col]] = True
            score = np.full(fresh.shape, -2.0, dtype=np.float32)
            score[row, col] = np.einsum("pd,pd->p", queries[live[row]], self.vectors[fresh[row, col]])
            all_ids = np.concatenate([ids[live], np.where(new, fresh, -1)], axis=1)
            all_near = np.concatenate([near[live], score], axis=1)
            all_open = np.concatenate([open_[live], new], axis=1)
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :width]
            ids[live] = np.take_along_axis(all_ids, order, 1)
            near[live] = np.take_along_axis(all_near, order, 1)
            open_[live] = np.take_along_axis(all_open, order, 1)
        return ids, near

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(queries), 1), self.entry)
        for at in range(len(self.neighbours) - 1, 0, -1):
            entry = self._beam(queries, entry, at, 1)[0]
        return self._beam(queries, entry, 0, width)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return np.einsum("pd,pd->p", a, b) / np.sqrt(np.einsum("pd,pd->p", a, a) * np.einsum("pd,pd->p", b, b))


def linked(graph: Graph, queries: np.ndarray, cosine: float, beam: int = BEAM, recall: float = RECALL, audited: int = AUDITED) -> np.ndarray:
    """Which vectors of the graph lie within the threshold of each query, as a matrix."""
    n, floor = len(graph.vectors), cosine - _SLACK
    sample = np.unique(np.linspace(0, len(queries) - 1, min(audited, len(queries))).astype(int))
    truth = queries[sample] @ graph.vectors.T >= floor
    while True:
        found = np.zeros((len(queries), n), dtype=bool)
        todo, width = np.arange(len(queries)), min(beam, n)
        while len(todo):
            if width * 4 >= n:
                # Beams of this width visit most of the shard: look at all of it.
                for part in np.array_split(todo, -(-len(todo) // 512)):
                    found[part] = queries[part] @ graph.vectors.T >= floor
                break
            wider = []
            for part in np.array_split(todo, -(-len(todo) // 512)):
                ids, near = graph.search(queries[part], width)
                row, col = np.nonzero((near >= floor) & (ids >= 0))
                found[part[row], ids[row, col]] = True
                wider.append(part[near[:, -1] >= floor])
            todo, width = np.concatenate(wider), min(2 * width, n)
        hits, links = int((found[sample] & truth).sum()), int(truth.sum())
        if hits >= recall * links or beam >= n:
            return found
        beam *= 2


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[int]:
    """Numbers of the pairs that join parts not yet joined."""
    root = list(range(n))
    chosen = []
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        while root[j] != j:
            root[j] = root[root[j]]
            j = root[j]
        if i != j:
            root[max(i, j)] = min(i, j)
            chosen.append(k)
    return chosen


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, dtype=np.float64).reshape(len(rows), -1)


def near_duplicate_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, shard: int = SHARD
) -> DataFrame:
    """``id, n_links, component_id, kept`` of every vector."""
    plain = rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("string").alias("label"))
    id_type = plain.schema["id"].dataType.simpleString()
    sound = plain.filter("id is not null and label is not null and v is not null").filter(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    )
    # Vectors of different lengths cannot be compared; the length is part of the group.
    keyed = sound.withColumn("label", F.struct("label", F.size("v").alias("d")))
    same = written(keyed.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
    shards = same.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    placed = same.join(shards, "label").withColumn("shard", F.pmod(F.xxhash64("rep", "v"), F.col("shards")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        vectors = _matrix(table.column("v"))
        # Scaled first: squares of tiny or huge components must not vanish or overflow.
        vectors /= np.abs(vectors).max(axis=1, keepdims=True)
        unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
        graph = Graph.build(unit)
        return pa.table(
            {
                "label": table.column("label").slice(0, 1),
                "shard": table.column("shard").slice(0, 1),
                "shards": table.column("shards").slice(0, 1),
                "reps": pa.array([table.column("rep").to_pylist()], pa.list_(table.schema.field("rep").type)),
                "copies": pa.array([table.column("copies").to_pylist()], pa.list_(pa.int64())),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "graph": pa.array([[level.tobytes() for level in graph.neighbours]], pa.list_(pa.binary())),
                "entry": pa.array([graph.entry], pa.int32()),
            }
        )

    label_ddl = "label struct<label:string,d:int>"
    built = written(placed.groupBy("label", "shard").applyInArrow(build, f"{label_ddl}, shard int, shards int, reps array<{id_type}>, copies array<long>, vectors binary, graph array<binary>, entry int"), "graphs")
    # Every pair of shards of a label meets in one task, whichever shard is searched.
    pairs = built.select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other")).withColumn(
        "pair", F.struct("label", F.least("shard", "other").alias("p"), F.greatest("shard", "other").alias("q"))
    )

    def meet(table: pa.Table) -> pa.Table:
        sides = []
        for row in table.sort_by("shard").to_pylist():
            vectors = np.frombuffer(row["vectors"], dtype=np.float64).reshape(len(row["reps"]), -1)
            unit = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)
            levels = [np.frombuffer(x, dtype=np.int32).reshape(len(vectors), -1) for x in row["graph"]]
            sides.append((row["reps"], np.array(row["copies"]), vectors, Graph(unit, levels, [], row["entry"])))
        (reps, copies, vectors, graph), own = sides[0], len(sides) == 1
        other_reps, other_copies, other_vectors, other_graph = sides[-1]
        found = linked(other_graph, graph.vectors, cosine)
        found |= found.T if own else linked(graph, other_graph.vectors, cosine).T
        a, b = np.nonzero(found)
        if own:
            a, b = a[a < b], b[a < b]
        sure = np.zeros(len(a), dtype=bool)
        for part in range(0, len(a), 1 << 18):
            s = slice(part, part + (1 << 18))
            sure[s] = _cosines(vectors[a[s]], other_vectors[b[s]]) >= cosine
        a, b = a[sure], b[sure]
        left = np.bincount(a, weights=other_copies[b], minlength=len(reps))
        right = np.bincount(b, weights=copies[a], minlength=len(other_reps))
        tree = _forest(a, b if own else b + len(reps), len(reps) + len(other_reps))
        ids = [*reps, *other_reps]
        n = np.concatenate([left, right]).astype(np.int64)
        some = np.flatnonzero(n)
        kind = table.schema.field("reps").type.value_type
        return pa.table(
            {
                "rep": pa.array([ids[i] for i in some] + [reps[a[k]] for k in tree], kind),
                "n": pa.array([*n[some].tolist(), *[0] * len(tree)], pa.int64()),
                "to": pa.array([None] * len(some) + [other_reps[b[k]] for k in tree], kind),
                "label": table.column("label").take(pa.array([0] * (len(some) + len(tree)), pa.int64())),
            }
        )

    met = written(pairs.groupBy("pair").applyInArrow(meet, f"rep {id_type}, n long, to {id_type}, {label_ddl}"), "pairs")
    counts = met.groupBy("label", "rep").agg(F.sum("n").alias("n"))
    # Ids of copies hang below their representative, then the trees between those.
    copies = keyed.join(same, ["label", "v"]).select("id", "rep", "label", "copies")
    members = written(copies.join(counts, ["label", "rep"], "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("n", F.lit(0))), "members")
    links = met.filter("to is not null").select(F.col("rep").alias("a"), F.col("to").alias("b")).unionByName(members.filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    joined = components(links, "a", "b")
    per_id = members.groupBy("id").agg(F.max("n_links").alias("n_links")).join(joined.withColumnRenamed("node", "id"), "id", "left")
    # Unsound rows under an id that has a sound one are rows of that id with no links.
    answer = plain.select("id").join(per_id, "id", "left")
    component = F.coalesce("component", "id")
    return answer.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
