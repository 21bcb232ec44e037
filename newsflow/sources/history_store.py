"""Where the run-history tables live: parquet folders or a JDBC database."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from newsflow.schemas import HISTORY_SCHEMAS
from newsflow.sources.landing import read_landed


@dataclass(frozen=True)
class HistoryStore:
    """Give either ``path`` (parquet) or ``jdbc`` (options with ``url``)."""

    spark: SparkSession
    path: str | None = None
    jdbc: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if bool(self.path) == bool(self.jdbc):
            raise ValueError("give either path or jdbc")

    def read(self, table: str, split_on: str | None = None, **bounds: str) -> DataFrame:
        """A history table. ``split_on`` with ``lowerBound``, ``upperBound`` and
        ``numPartitions`` reads a database table in parallel."""
        schema = HISTORY_SCHEMAS[table]
        if self.path:
            return read_landed(self.spark, f"{self.path}/{table}", schema)
        reader = self.spark.read.format("jdbc").options(dbtable=table, **self.jdbc)
        if split_on:
            reader = reader.options(partitionColumn=split_on, **bounds)
        return reader.load()

    def append(self, table: str, rows: DataFrame) -> None:
        self._write(table, rows, "append")

    def replace(self, table: str, rows: DataFrame) -> None:
        """Write a reduced table. ``rows`` must not read the folder it replaces."""
        self._write(table, rows, "overwrite")

    def _write(self, table: str, rows: DataFrame, mode: str) -> None:
        if table not in HISTORY_SCHEMAS:
            raise KeyError(table)
        if self.path:
            rows.write.mode(mode).parquet(f"{self.path}/{table}")
        else:
            # Overwriting keeps the table with its keys and defaults.
            rows.write.format("jdbc").options(dbtable=table, truncate="true", **self.jdbc).mode(mode).save()
