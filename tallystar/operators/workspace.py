"""Intermediate results that are read more than once."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``, and where that is
    unset the session's warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _hadoop(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def run_folder(spark: SparkSession) -> str:
    """This session's folder for intermediate data. It goes when the driver's JVM ends, or
    earlier with ``remove_run_folder``."""
    folder = f"{shared_root(spark)}/tallystar-{spark.sparkContext.applicationId}"
    files, path = _hadoop(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    files, path = _hadoop(spark, folder)
    files.delete(path, True)


def remove_run_folder(spark: SparkSession) -> None:
    remove(spark, run_folder(spark))


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A name for a new folder below the run folder."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release_exchanges(spark: SparkSession) -> None:
    """Free the disks of what finished queries have exchanged. Spark deletes those files when the
    driver's JVM collects the plans that refer to them, and a driver with room to spare may
    not collect any before a run ends."""
    spark._jvm.System.gc()


class Workspace:
    """Holds frames as Parquet tables in ``folder`` and deletes them on ``close``.

    The folder has to be one that all executors share. Lost executors then cost
    nothing, lineage ends at the table, later readers prune columns, and what one table took
    to make is not kept on disk while the next is made.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._written: list[str] = []

    def hold(self, df: DataFrame, label: str, by: str | None = None) -> DataFrame:
        """Write and read back; ``by`` names a column by whose values files are kept apart."""
        path = f"{self.folder}/{label}-{uuid.uuid4().hex}"
        release_exchanges(self.spark)
        writer = df.write.partitionBy(by) if by else df.write
        writer.option("compression", "zstd").parquet(path)
        self._written.append(path)
        # Once more: plans that ended just before the write may not have been let go by then.
        release_exchanges(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        for path in self._written:
            remove(self.spark, path)
        self._written = []

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def run_workspace(spark: SparkSession) -> Workspace:
    """One for lazy results that go on reading what it holds: it goes with the run folder."""
    return Workspace(spark, run_folder(spark))
