"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Listings are pruned by conditions on the path.
    "spark.sql.python.filterPushdown.enabled": "true",
    # Whole pages and articles are wide rows: keep one Arrow batch small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app_name: str = "newsflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were planned for."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[tuple[str, str]] = set()


def ship_packages(spark: SparkSession, *folders: str) -> None:
    """Make source packages importable in Python workers wherever they run.

    Does nothing for what this application was sent before.
    """
    context = spark.sparkContext
    for folder in folders:
        path = os.path.abspath(folder)
        if (context.applicationId, path) in _shipped:
            continue
        parent, name = os.path.split(path)
        archive = os.path.join(tempfile.mkdtemp(prefix="newsflow-"), name)
        context.addPyFile(shutil.make_archive(archive, "zip", parent, name))
        _shipped.add((context.applicationId, path))


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path for intermediate tables in the folder all executors share.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is
    unset, a local session (tests) gets a folder of its own; any other one is refused, as
    its executors would each write to their own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if not current:
            master = spark.sparkContext.master
            if not master.startswith("local") or master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsflow-"))
            current = spark.sparkContext.getCheckpointDir()
        root = current
    return f"{root.rstrip('/')}/newsflow/{purpose}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Documents or pages in one Arrow batch at most; with texts of a few kilobytes, a few megabytes.
BATCH_ROWS = 1000


def bounded_batches(df: DataFrame) -> DataFrame:
    """Make sure that the session sends wide rows to Python in small batches.

    The default of 10,000 rows would hold some hundred megabytes of texts per task beside
    the heap. A smaller setting of the session stays.
    """
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


class Scratch:
    """Intermediate tables of one job, written once and read back.

    Used where two later steps need the same expensive rows, so that they are neither
    computed twice nor lost with an executor. ``drop`` deletes them once the job's output
    is written; nothing may read them afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, purpose: str) -> DataFrame:
        path = scratch_path(self.spark, purpose)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        while self.paths:
            delete_path(self.spark, self.paths.pop())


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back, for as long as the
    caller's result may be read."""
    return Scratch(df.sparkSession).keep(df, purpose)
