"""Incremental folds of a change log: a stored state plus new changes, instead of the log.

A state has one row per key. Beside every value it keeps the order of the change that
wrote it, so that two states merge into the state of both logs: of two first writers the
earlier one counts, of two last writers the later one. Merging does not depend on the
order of the parts, and merging a part again changes nothing, so changes may come late or
twice. ``result`` turns a state into the table that a reduction of the whole log gives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from newsflow.operators.history import START
from newsflow.session import Scratch
from newsflow.sources.landing import read_landed, write_partitions

BUCKETS = 64


@dataclass(frozen=True)
class Kept:
    """One figure of a state.

    ``pick`` is ``first`` or ``last`` (by the order of the log), ``least`` or ``most`` (by
    value). Only changes for which ``when`` holds count. ``since`` names a first writer:
    what was written before it does not count in the result.
    """

    value: Column
    pick: str = "last"
    when: Column | None = None
    since: str | None = None


@dataclass(frozen=True)
class Fold:
    """How a log is folded by ``keys``; ``order`` is a total order of its changes.

    ``kept`` figures whose names begin with ``_`` are for the result only: a struct among
    them gives its fields as columns. Rows without ``required`` figures are left out.
    """

    keys: dict[str, Column]
    order: tuple[str, ...]
    kept: dict[str, Kept]
    required: tuple[str, ...] = ()
    hidden_keys: tuple[str, ...] = ()

    def state(self, log: DataFrame) -> DataFrame:
        """The state of a log; combined in the map tasks before it is shuffled."""
        at = F.struct(*[F.col(c) for c in self.order])
        figures = []
        for name, one in self.kept.items():
            if one.pick in ("least", "most"):
                value = one.value if one.when is None else F.when(one.when, one.value)
                figures.append((F.min if one.pick == "least" else F.max)(value).alias(name))
            else:
                ord_ = at if one.when is None else F.when(one.when, at)
                pick = F.min_by if one.pick == "first" else F.max_by
                figures.append(pick(F.struct(at.alias("ord"), one.value.alias("value")), ord_).alias(name))
        return log.groupBy(*[c.alias(k) for k, c in self.keys.items()]).agg(*figures)

    def merge(self, *states: DataFrame) -> DataFrame:
        """The state of all logs together."""
        both = reduce(DataFrame.unionByName, states)
        figures = []
        for name, one in self.kept.items():
            if one.pick in ("least", "most"):
                figures.append((F.min if one.pick == "least" else F.max)(name).alias(name))
            else:
                figures.append((F.min_by if one.pick == "first" else F.max_by)(F.col(name), F.col(f"{name}.ord")).alias(name))
        return both.groupBy(*self.keys).agg(*figures)

    def result(self, state: DataFrame) -> DataFrame:
        """The current row of every key."""
        for name in self.required:
            state = state.filter(F.col(name).isNotNull())
        columns = [F.col(k) for k in self.keys if k not in self.hidden_keys]
        for name, one in self.kept.items():
            if one.pick in ("least", "most"):
                value = F.col(name)
            elif one.since:
                value = F.when(F.col(f"{name}.ord") >= F.col(f"{one.since}.ord"), F.col(f"{name}.value"))
            else:
                value = F.col(f"{name}.value")
            if not name.startswith("_"):
                columns.append(value.alias(name))
            elif one.pick in ("first", "last") and isinstance(state.schema[name].dataType["value"].dataType, T.StructType):
                columns += [value[f].alias(f) for f in state.schema[name].dataType["value"].dataType.names]
        return state.select(*columns)


def _written(column: str) -> Kept:
    """The last change that wrote a column."""
    return Kept(F.col(column), "last", F.col(column).isNotNull())


def history_fold(ord_cols: Sequence[str], fixed: Sequence[str], mutable: Sequence[str], id_col: str = "id", status: str = "status", time: str = "changed_at") -> Fold:
    """The fold behind ``history.history_state``."""
    started, at = F.col(status) == START, F.col(time)
    return Fold(
        {id_col: F.col(id_col)},
        tuple(ord_cols),
        {
            **{c: _written(c) for c in mutable},
            status: Kept(F.col(status)),
            "started_at": Kept(at, "most", started),
            "completed_at": Kept(at, "last", ~started),
            "created_at": Kept(at, "least"),
            "updated_at": Kept(at, "most"),
            "_fixed": Kept(F.struct(*fixed), "first", started),
        },
        ("_fixed",),
    )


def dag_run_fold(
    ord_cols: Sequence[str],
    key: str = "run_id",
    fixed: Sequence[str] = ("dag_id", "execution_date", "tickers"),
    reported: Sequence[str] = ("total_articles", "error_message"),
    status: str = "status",
    time: str = "changed_at",
) -> Fold:
    """The fold behind ``history.dag_run_state``.

    A finish before the first start has no effect. As only last writers count, it is enough
    to test these against the first start when the result is taken, and a start that comes
    late may move that one back.
    """
    started, at = F.col(status) == START, F.col(time)
    return Fold(
        {key: F.col(key)},
        tuple(ord_cols),
        {
            status: Kept(F.col(status), since="_first"),
            "started_at": Kept(at, "last", started),
            "completed_at": Kept(at, "last", ~started, "_first"),
            **{c: Kept(F.col(c), "last", F.col(c).isNotNull(), "_first") for c in reported},
            "_first": Kept(F.struct(*fixed), "first", started),
        },
        ("_first",),
    )


def upsert_fold(keys: dict[str, Column], ord_cols: Sequence[str], fixed: Sequence[str], mutable: Sequence[str], keep_unwritten: bool = False, hidden_keys: Sequence[str] = ()) -> Fold:
    """The fold behind ``history.upsert_state``."""
    last = {c: _written(c) if keep_unwritten else Kept(F.col(c)) for c in mutable}
    return Fold(dict(keys), tuple(ord_cols), {**last, "_fixed": Kept(F.struct(*fixed), "first")}, (), tuple(hidden_keys))


def file_fold(
    ord_cols: Sequence[str],
    keys: Sequence[str] = ("file_type", "ticker", "file_date"),
    path: str = "s3_key",
    fixed: Sequence[str] = ("s3_bucket", "s3_key"),
    mutable: Sequence[str] = ("file_size_bytes", "row_count", "uploaded_at"),
    key_chars: int | None = None,
) -> Fold:
    """The fold behind ``history.file_upsert``."""
    compared = F.col(path) if key_chars is None else F.substring(F.col(path), 1, key_chars)
    return upsert_fold({**{k: F.col(k) for k in keys}, "_prefix": compared}, ord_cols, fixed, mutable, hidden_keys=("_prefix",))


def advance(spark: SparkSession, path: str, fold: Fold, delta: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Fold new changes into a stored state; returns the stored state.

    The state lies in buckets by a hash of its key. Only buckets that the changes touch are
    read and replaced, from a staged copy. A state has the number of buckets it began with.
    """
    scratch = Scratch(spark)
    bucket = F.pmod(F.xxhash64(*fold.keys), F.lit(buckets)).cast("int")
    new = scratch.keep(fold.state(delta).withColumn("bucket", bucket), "delta")
    # At most as many numbers as there are buckets.
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
    stored = read_landed(spark, path, new.schema).filter(F.col("bucket").isin(touched))
    merged = fold.merge(stored.drop("bucket"), new.drop("bucket")).withColumn("bucket", bucket)
    write_partitions(scratch.keep(merged, "merged"), path, "overwrite", ["bucket"])
    scratch.drop()
    return read_landed(spark, path, new.schema).drop("bucket")
