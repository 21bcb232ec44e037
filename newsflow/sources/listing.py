"""A listing of files as a table: a Python data source with a partition per folder.

Executors list, each the folders below one entry of the base, in path order and a page at
a time; the driver sees the entries of one folder only. A condition on the beginning of
the path, or on the path being behind a key, is pushed down and leaves out the folders it
rules out. Files without bytes are listed as well, which file scans pass over.

Folders are read through pyarrow's file systems. Stores that only Spark can open are
listed by Spark's own file source, on the driver (``listed_files``).
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, StringStartsWith

from newsflow.sources.files import all_files, plain_path

#: Schemes that pyarrow opens; Hadoop's names for the same stores.
SCHEMES = {"": "file", "file": "file", "s3": "s3", "s3a": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
#: Files that a task holds before it hands them on.
PAGE = 10_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
LISTED = "path string, size bigint, modified timestamp"


def scheme_of(path: str) -> str:
    found = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):", path)
    return found[1].lower() if found else ""


@dataclass
class Folder(InputPartition):
    """What one task lists: a folder with all below it, or only the files in it."""

    path: str
    deep: bool


class FileListing(DataSource):
    """``path, size, modified`` of every file below the option ``path``; with ``max_keys``
    each folder gives its first files in path order, after ``start_after`` if set."""

    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return LISTED

    def reader(self, schema) -> DataSourceReader:
        return (PushedListingReader if self.options.get("pushed") == "true" else ListingReader)(self.options)


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.base = options["path"].rstrip("/")
        self.most = int(options["max_keys"]) if options.get("max_keys") else None
        self.after = options.get("start_after") or ""
        self.prefix = options.get("prefix") or ""

    # What a path is called here, and what its file system calls it.

    def _system(self):
        import pyarrow.fs as fs

        scheme = scheme_of(self.base)
        rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "", self.base)
        if SCHEMES[scheme] == "file":
            return fs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
        system, root = fs.FileSystem.from_uri(f"{SCHEMES[scheme]}://{rest}")
        return system, root, f"{scheme}:/"

    def _entries(self, system, folder: str) -> list:
        import pyarrow.fs as fs

        found = system.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True))
        seen = [e for e in found if not e.base_name.startswith(("_", ".")) or "=" in e.base_name]
        # Folders are ordered by the paths in them, so that a walk goes in path order.
        return sorted(seen, key=lambda e: e.path + "/" if e.type == fs.FileType.Directory else e.path)

    def _wanted(self, path: str, folder: bool) -> bool:
        if not folder:
            return path.startswith(self.prefix) and path > self.after
        inside = path + "/"
        near = inside.startswith(self.prefix) or self.prefix.startswith(inside)
        return near and (inside > self.after or self.after.startswith(inside))

    def partitions(self) -> list[InputPartition]:
        import pyarrow.fs as fs

        system, root, mark = self._system()
        # Go down while the prefix leaves one way.
        while self.prefix.startswith(f"{mark}{root}/"):
            step = self.prefix[len(mark) + len(root) + 1 :].partition("/")
            if not step[1]:
                break
            root = f"{root}/{step[0]}"
        folders = [e.path for e in self._entries(system, root) if e.type == fs.FileType.Directory and self._wanted(mark + e.path, True)]
        return [Folder(root, False), *[Folder(f, True) for f in folders]]

    def read(self, partition: Folder):
        import pyarrow as pa
        import pyarrow.fs as fs

        system, _, mark = self._system()
        schema = pa.schema([("path", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC"))])
        page, given = [], 0
        stack = [iter(self._entries(system, partition.path))]
        while stack and (self.most is None or given < self.most):
            entry = next(stack[-1], None)
            if entry is None:
                stack.pop()
            elif entry.type == fs.FileType.Directory:
                if partition.deep and self._wanted(mark + entry.path, True):
                    stack.append(iter(self._entries(system, entry.path)))
            elif self._wanted(mark + entry.path, False):
                # Milliseconds, as Spark's own listings have them.
                at = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(milliseconds=(entry.mtime_ns or 0) // 1_000_000)
                page.append((mark + entry.path, entry.size, at))
                given += 1
            if len(page) == PAGE:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*page), schema.types)], schema=schema)
                page = []
        if page:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*page), schema.types)], schema=schema)


class PushedListingReader(ListingReader):
    """For sessions that push conditions into Python sources; others refuse this method."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Only folders are left out here; Spark still tests the rows."""
        for one in filters:
            if getattr(one, "attribute", None) == ("path",):
                if isinstance(one, StringStartsWith) and len(one.value) > len(self.prefix):
                    self.prefix = one.value
                if isinstance(one, (GreaterThan, GreaterThanOrEqual)):
                    # The row that equals the key may be wanted, so look from just before it.
                    self.after = max(self.after, one.value[:-1])
            yield one


def listed_files(spark: SparkSession, base: str, max_keys: int | None = None, start_after: str | None = None) -> DataFrame:
    """``path, size, modified`` of all files below a folder, none if it is not there.

    ``max_keys`` and ``start_after`` are for ``file_page``.
    """
    if scheme_of(base) not in SCHEMES:
        try:
            files = all_files(spark, base).withColumn("path", plain_path(F.col("path")))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            files = spark.createDataFrame([], LISTED)
        return files if start_after is None else files.filter(F.col("path") > start_after)
    spark.dataSource.register(FileListing)
    reader = spark.read.format("file_listing").option("path", base).option("pushed", spark.conf.get(PUSHDOWN, "false"))
    if max_keys is not None:
        reader = reader.option("max_keys", max_keys)
    if start_after is not None:
        reader = reader.option("start_after", start_after)
    return reader.load()


def file_page(spark: SparkSession, base: str, max_keys: int = 1000, start_after: str | None = None) -> DataFrame:
    """The first ``max_keys`` files in path order, or those after the last path of the page
    before. A folder is listed up to that many files, whatever it holds."""
    return listed_files(spark, base, max_keys, start_after).orderBy("path").limit(max_keys)
