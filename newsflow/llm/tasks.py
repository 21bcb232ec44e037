"""How the operators of this package run Arrow code inside Spark tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from newsflow.llm.bytewords import slices
from newsflow.session import bounded_batches, scratch_path


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names, so that no other column can clash."""
    return bounded_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def map_texts(docs: DataFrame, id_col: str, text_col: str, columns: str, make: Callable) -> DataFrame:
    """Apply ``make()(slice) -> {column: values}`` to all texts, a bounded slice at a time.

    ``columns`` is the DDL of what the function returns; the id goes first, unchanged.
    ``make`` is called once per task, for what is costly to set up.
    """
    narrow = keyed_texts(docs, id_col, text_col)
    schema = T.StructType([T.StructField(id_col, narrow.schema["id"].dataType), *T.StructType.fromDDL(columns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in slices(batch, "text"):
                out = apply(part)
                yield pa.RecordBatch.from_arrays([part.column("id"), *map(as_array, out.values())], [id_col, *out])

    return narrow.mapInArrow(run, schema)


def add_columns(docs: DataFrame, text_col: str, columns: str, make: Callable) -> DataFrame:
    """All columns of the rows, and behind them what ``make()(slice)`` works out.

    The slice given to the function has the text alone, as column ``text``.
    """
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(columns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in slices(batch, at):
                out = apply(pa.RecordBatch.from_arrays([part.column(at)], ["text"]))
                yield pa.RecordBatch.from_arrays([*part.columns, *map(as_array, out.values())], [*part.schema.names, *out])

    return bounded_batches(docs).mapInArrow(run, schema)


def filter_rows(docs: DataFrame, text_col: str, make: Callable) -> DataFrame:
    """Whole rows, all columns unchanged, for which ``make()(slice)`` is true.

    The slice given to the function has the text alone, as column ``text``.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            for part in slices(batch, at):
                yield part.filter(as_array(keep(pa.RecordBatch.from_arrays([part.column(at)], ["text"]))))

    return bounded_batches(docs).mapInArrow(run, docs.schema)


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    """The texts of a slice; a missing text counts as an empty one."""
    return [t or "" for t in batch.column("text").to_pylist()]


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table once to the shared scratch folder and read it back.

    Cuts the lineage: what was written is not computed again when an executor is lost.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
