"""Intermediate tables in shared storage.

A step that reads its input more than once writes it first, so that lost executors re-read files rather
than re-run the whole lineage and so that every reader sees the same rows.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}
_scopes: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application below ``spark.checkpoint.dir``.

    Without that setting a local session gets a folder of its own; on a cluster it is an error, because a
    folder of one machine is not visible to the others.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="tidemark-"))
    return f"{base.rstrip('/')}/tidemark/{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path that no other step uses."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    for paths in _scopes:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside when the block ends; frames over them must not outlive it."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            delete_folder(spark, path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write the rows once and return a frame over the files together with the row count.

    The count is taken while writing; no second scan is run for it.
    """
    spark = df.sparkSession
    seen = Observation(f"{label}-{uuid.uuid4().hex[:8]}")
    path = scratch_path(spark, label)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(seen.get["rows"])


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; frames that still read them stop working."""
    delete_folder(spark, scratch_root(spark))
