"""Merkle manifest of a table: one tree per group, one tree over the groups.

Every row is a leaf, a digest of chosen columns. Leaves ascend by id within their group;
every eight consecutive nodes (the last run: fewer, even one) become the digest of their
digests, until one is left, the group's subroot. The subroots, ordered by group, go on the
same way to the root. A proof of a row is what stands beside its path on the way up.

Leaves are put in order by a range sort of ids and digests, and numbered from the row
counts of the sorted parts; no group is sorted in one task, and texts are not shuffled.
The levels are built bottom up and stored as node rows, each with the digests of its run
and a link to its parent. A recursive query then ascends: it joins the rows it has with
their parents, appends the siblings to the proof and folds the claimed digest into the
parent's, until there is no parent. The leaves of one run share their way up, so they
climb in one row that holds each leaf's own folded digest and the siblings once.

Defined results: a missing value is a value of its own (``-``), also as id or group, and
comes first in order. Rows that share an id are ordered by their digest; equal rows are
leaves each. An empty table has no leaves and no root. Other columns are not looked at.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from newsflow.llm.tasks import written

#: Nodes of a run.
FAN = 8
#: Bytes of a digest.
WIDE = 32
#: The number of the tree over the groups.
TOP = -1
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

NODE = "tree long, level int, idx long, width long, digest binary, children binary, up_tree long, up_level int, up_idx long, pos int"

CLIMB = """
WITH RECURSIVE climb(tree, run, folded, siblings, up_tree, up_level, up_idx, pos) AS (
  SELECT tree, idx,
         transform(claimed, (c, p) -> CASE WHEN alone THEN c ELSE {anchor} END),
         X'', up_tree, up_level, up_idx, pos
  FROM {{runs}}
  UNION ALL
  SELECT c.tree, c.run,
         transform(c.folded, h -> {step}),
         concat(c.siblings, {left}, {right}), n.up_tree, n.up_level, n.up_idx, n.pos
  FROM climb c JOIN {{nodes}} n ON n.tree = c.up_tree AND n.level = c.up_level AND n.idx = c.up_idx
)
SELECT tree, run, folded, siblings FROM climb WHERE up_level IS NULL"""


def _left(children: str, pos: str) -> str:
    return f"substring({children}, 1, {WIDE} * {pos})"


def _right(children: str, pos: str) -> str:
    return f"substring({children}, {WIDE} * {pos} + {WIDE + 1}, {WIDE * FAN})"


def _folded(children: str, pos: str, digest: str) -> str:
    """The digest of a run in which one node is replaced, in SQL."""
    return f"unhex(sha2(lower(hex(concat({_left(children, pos)}, {digest}, {_right(children, pos)}))), 256))"


def spelled(value: Column) -> Column:
    """A value as it enters a digest: ``-`` if missing, else its bytes with their number."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


@contextmanager
def _all_rows(spark: SparkSession):
    """Lets a recursive query return any number of rows while it runs."""
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_ROW_LIMIT)
        else:
            spark.conf.set(_ROW_LIMIT, before)


def _numbered(rows: DataFrame, order: list[str], into: str, purpose: str) -> DataFrame:
    """The rows with their number in a total order, from 0.

    The sorted rows are written with a number that ascends within each part; how many rows
    the parts before hold is a running sum over as many rows as there are parts.
    """
    spread = rows.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order)
    stored = written(spread.withColumn("_seq", F.monotonically_increasing_id()), purpose)
    stored = stored.withColumns({"_part": F.shiftright("_seq", 33), "_nth": F.col("_seq").bitwiseAND((1 << 33) - 1)})
    parts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_ahead"))
    return stored.join(ahead, "_part").withColumn(into, F.col("_ahead") + F.col("_nth")).drop("_part", "_seq", "_nth", "_ahead")


def _linked(nodes: DataFrame, level: int, trees: int) -> DataFrame:
    """Node rows of one level, linked to the node that digests their run."""
    last = F.col("width") == 1
    top = F.col("tree") == TOP
    up = lambda inner, over, kind: F.when(~last, inner).when(~top & F.lit(trees > 1), over).cast(kind)
    return nodes.withColumns({
        "level": F.lit(level),
        "up_tree": up(F.col("tree"), F.lit(TOP), "long"),
        "up_level": up(F.lit(level + 1), F.lit(1), "int"),
        "up_idx": up(F.floor(F.col("idx") / FAN), F.floor(F.col("tree") / FAN), "long"),
        "pos": up(F.col("idx") % FAN, F.col("tree") % FAN, "int"),
    })


def _runs(nodes: DataFrame, digest_col: str, **more: Column) -> DataFrame:
    """Consecutive nodes, eight by eight: ``tree, idx, width, children, digest``."""
    run = F.sort_array(F.collect_list(F.struct((F.col("idx") % FAN).alias("pos"), F.col(digest_col).alias("digest"), *[c.alias(n) for n, c in more.items()])))
    grouped = nodes.groupBy("tree", F.floor(F.col("idx") / FAN).alias("idx"), "width").agg(run.alias("run"))
    joined = F.expr("aggregate(run, X'', (a, r) -> concat(a, r.digest))")
    return grouped.select(
        "tree",
        "idx",
        F.ceil(F.col("width") / FAN).alias("width"),
        F.when(F.col("width") == 1, F.col("run")[0]["digest"]).otherwise(digest(hexed(joined))).alias("digest"),
        joined.alias("children"),
        (F.col("width") == 1).alias("alone"),
        *[F.col("run").getField(n).alias(n) for n in more],
    )


@dataclass(frozen=True)
class Manifest:
    """The stored trees. ``runs`` are the runs of leaves, with the ``ids`` and ``claimed``
    digests of their leaves; ``nodes`` all nodes above the leaves; ``subroots`` one row per
    group (``tree, group, leaves, subroot``); ``root`` as hex, None for an empty table."""

    runs: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None
    id_col: str


def build(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: tuple[str, ...] = COLUMNS,
    claims: dict[str, Column] | None = None,
) -> Manifest:
    """Build and store the trees of a table.

    ``claims`` gives other values for some of the columns: what somebody says the row
    holds. Their digest is what a climb checks; by default it is the row's own.
    """
    claims = claims or {}
    named = {c: f"_{i}" for i, c in enumerate(dict.fromkeys([id_col, group_col, *columns]))}
    values = docs.select(*[F.col(c).alias(n) for c, n in named.items()], *[v.alias(f"_claim_{named[c]}") for c, v in claims.items()])
    own = [spelled(F.col(named[c])) for c in columns]
    claimed = [spelled(F.col(f"_claim_{named[c]}" if c in claims else named[c])) for c in columns]
    leaves = values.select(F.col(named[id_col]).alias("id"), F.col(named[group_col]).alias("group"), digest(*own).alias("leaf"), digest(*claimed).alias("claimed"))
    # Texts are read once, for this table; the range sort below reads its input twice.
    leaves = _numbered(written(leaves, "leaves"), ["group", "id", "leaf", "claimed"], "at", "sorted-leaves")
    groups = leaves.groupBy("group").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("width"))
    groups = written(_numbered(groups, ["group"], "tree", "sorted-groups"), "groups")
    placed = leaves.join(groups.withColumnRenamed("group", "of"), F.col("group").eqNullSafe(F.col("of"))).withColumn("idx", F.col("at") - F.col("start"))
    largest, trees = groups.agg(F.coalesce(F.max("width"), F.lit(0)), F.count(F.lit(1))).first()
    node = [c.split()[0] for c in NODE.split(", ")]
    runs = written(_linked(_runs(placed, "leaf", claimed=F.col("claimed"), ids=F.col("id")), 1, trees), "runs")
    levels = [runs]
    while largest > FAN:
        largest = -(-largest // FAN)
        below = levels[-1].filter("width > 1")
        levels.append(written(_linked(_runs(below, "digest"), len(levels) + 1, trees).select(*node), "nodes"))
    stored = [level.select(*node) for level in levels]
    subroots = _union([level.filter("width = 1").select("tree", "digest") for level in stored])
    above, width, level = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).cast("long").alias("width"), "digest"), trees, 0
    while width > 1:
        width, level = -(-width // FAN), level + 1
        above = written(_linked(_runs(above, "digest"), level, trees).select(*node), "nodes")
        stored.append(above)
    top = (above if trees > 1 else subroots).select(hexed(F.col("digest"))).first()
    named_roots = groups.join(subroots, "tree").select("tree", "group", F.col("width").alias("leaves"), hexed(F.col("digest")).alias("subroot"))
    return Manifest(runs, _union(stored), named_roots, top[0] if top else None, id_col)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def climb(manifest: Manifest) -> DataFrame:
    """``tree, run, folded, siblings`` at the root: per run of leaves the root that each
    leaf's claim folds to, and the siblings from its parent's level up."""
    spark = manifest.nodes.sparkSession
    query = CLIMB.format(
        anchor=_folded("children", "p", "c"),
        step=_folded("n.children", "c.pos", "h"),
        left=_left("n.children", "c.pos"),
        right=_right("n.children", "c.pos"),
    )
    with _all_rows(spark):
        return written(spark.sql(query, runs=manifest.runs, nodes=manifest.nodes), "climbed")


def verify(manifest: Manifest) -> DataFrame:
    """One row per leaf: ``id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    The proof is the digest of all siblings on the way up, left to right, level by level.
    """
    up = climb(manifest).withColumnRenamed("run", "idx")
    whole = manifest.runs.select("tree", "idx", "ids", "children").join(up, ["tree", "idx"]).join(manifest.subroots.select("tree", "subroot"), "tree")
    each = whole.select("subroot", "children", "siblings", F.posexplode(F.arrays_zip("ids", "folded")).alias("p", "one"))
    own = F.expr(f"concat({_left('children', 'p')}, {_right('children', 'p')})")
    return each.select(
        F.col("one.ids").alias(manifest.id_col),
        hexed(F.expr(f"substring(children, {WIDE} * p + 1, {WIDE})")).alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        F.sha2(hexed(F.concat(own, F.col("siblings"))).cast("binary"), 256).alias("proof_sha256"),
        hexed(F.col("one.folded")).alias("folded_root"),
        (hexed(F.col("one.folded")) == F.lit(manifest.root)).alias("verified"),
    )


def tampered_copy(docs: DataFrame, every: int = 3, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, with A-Z lower-cased in the rows whose id's CRC-32 ``every`` divides."""
    chosen = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    lowered = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(chosen, lowered).otherwise(F.col(text_col))


def check_tampering(docs: DataFrame, every: int = 3, id_col: str = "doc_id", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS, text_col: str = "text") -> DataFrame:
    """Build the manifest, claim tampered texts for some rows, and climb with all."""
    return verify(build(docs, id_col, group_col, columns, {text_col: tampered_copy(docs, every, id_col, text_col)}))
