"""Versioned Parquet tables.

A table is a folder with one sub-folder per version.  Spark's job commit writes ``_SUCCESS`` last, so the
current version is the highest one that carries the marker; a job lost half way leaves a folder that no
reader looks at.  A version brings its own schema.  One writer per table at a time.  A write keeps the new version and
the ``KEPT_VERSIONS - 1`` committed ones before it and deletes older ones, so a query may go on reading the version it
started from while the next one is written, but not longer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.scratch import delete_folder

_PREFIX = "version="
KEPT_VERSIONS = 2


def _listed(spark: SparkSession, path: str) -> dict[int, bool]:
    """Versions there are, and whether each is committed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, bool] = {}
    if files.exists(folder):
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(_PREFIX):
                found[int(name[len(_PREFIX) :])] = files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    return found


def _committed(spark: SparkSession, path: str) -> list[int]:
    return [number for number, done in _listed(spark, path).items() if done]


def _versions(spark: SparkSession, path: str) -> tuple[int, int]:
    """Highest committed version and highest version seen at all; 0 means none."""
    found = _listed(spark, path)
    return max((n for n, done in found.items() if done), default=0), max(found, default=0)


def _folder(path: str, version: int) -> str:
    return f"{path}/{_PREFIX}{version:08d}"


def snapshot_exists(spark: SparkSession, path: str) -> bool:
    return _versions(spark, path)[0] > 0


def current_version(spark: SparkSession, path: str) -> int:
    return _versions(spark, path)[0]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version == 0:
        raise FileNotFoundError(f"no committed version of {path}")
    return spark.read.parquet(_folder(path, version))


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = KEPT_VERSIONS) -> DataFrame:
    """Write a new version and return a frame over it.  ``df`` may read the version it replaces."""
    spark = df.sparkSession
    target = _folder(path, _versions(spark, path)[1] + 1)
    writer = df.write.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    for number in sorted(_committed(spark, path))[:-keep]:
        delete_folder(spark, _folder(path, number))
    return spark.read.parquet(target)


def compact(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Rewrite the current version with evenly sized files; the rows stay the same.

    Without a file count the rebalance hint lets adaptive execution cut partitions to
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    table = read_snapshot(spark, path)
    return write_snapshot(table.repartition(files) if files else table.hint("rebalance"), path)
