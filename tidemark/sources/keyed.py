"""Parquet tables partitioned by a hash bucket of their key, so that a change rewrites only the buckets it touches.

An ordinary partitioned table (``<path>/_of=N/_bucket=K``): Spark lists, prunes and overwrites its partitions.  An upsert
reads the touched buckets and replaces those partitions dynamically: the old files stay until all new ones are written.  A
write that is lost half way is repeated with the same result.  One writer per table at a time; readers start after it.

Rows are not shuffled to their buckets: a task writes one file per bucket it has rows of, at most ``buckets`` files of its
share.  Only changes of few rows are gathered first, so that many small upserts do not leave many small files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.bronze import setting
from tidemark.sources.scratch import delete_folder, materialise

# For small tables; choose it so that a bucket of the full table holds a gigabyte or so.
BUCKETS = 16
BUCKET, OF = "_bucket", "_of"
# An upsert that leaves fewer rows in its buckets shuffles them into one file per bucket.
GATHERED_ROWS = 1_000_000
AUDIT_TEXTS = ("_source_file", "_source_system", "_batch_id")
# Up to so many buckets a task keeps a file open for each, instead of sorting its rows by bucket.
OPEN_FILES = ("spark.sql.maxConcurrentOutputFileWriters", "64")


def keyed_exists(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET, OF)


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    return df.withColumns({OF: F.lit(buckets), BUCKET: place})


def _write(rows: DataFrame, path: str, key: str, replace: str) -> None:
    # A dictionary of unique keys is given up half way in every file; nobody looks for ranges of the audit texts.
    plain = {f"parquet.enable.dictionary#{key}": "false"} | {f"parquet.column.statistics.enabled#{c}": "false" for c in AUDIT_TEXTS}
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", replace).option("compression", "zstd").options(**plain)
    with setting(rows.sparkSession, *OPEN_FILES):
        writer.partitionBy(OF, BUCKET).parquet(path)


def _keep_columns(df: DataFrame, path: str, buckets: int) -> None:
    """A table without rows is one empty file that holds the columns."""
    df.drop(BUCKET, OF).limit(0).coalesce(1).write.mode("append").parquet(f"{path}/{OF}={buckets}/{BUCKET}=0")


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> int:
    """Replace the whole table by rows that do not come from it.  Returns the rows.

    The table stays as it was until the new rows are written: they replace its partitions dynamically, and what is left of
    it then goes.
    """
    spark = df.sparkSession
    before = set(spark.read.parquet(path).inputFiles()) if keyed_exists(spark, path) else set()
    seen = Observation(f"keyed-{uuid.uuid4().hex[:8]}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    _write(_bucketed(counted, key, buckets), path, key, "dynamic" if before else "static")
    if before:
        for folder in {f.rsplit("/", 1)[0] for f in before & set(spark.read.parquet(path).inputFiles())}:
            delete_folder(spark, folder)
    rows = int(seen.get["rows"])
    if not rows:
        _keep_columns(_bucketed(df, key, buckets), path, buckets)
    return rows


def upsert_keyed(source: DataFrame, path: str, key: str, replaces: DataFrame | None = None, buckets: int = BUCKETS) -> int:
    """Update rows with the key of a source row, insert the others; rewrites the touched buckets only.  Returns the source rows.

    The source has one row per key.  Keys of ``replaces`` leave the table even if the source has no row for them.  A
    column only one side has is null on the other; a new column rewrites all buckets, so that all files hold it.
    ``buckets`` counts for a table that is not there yet or has no rows.
    """
    spark = source.sparkSession
    if not keyed_exists(spark, path):
        return write_keyed(source, path, key, buckets)
    table = spark.read.parquet(path)
    held = table.select(OF).head()
    buckets = held[OF] if held else buckets
    staged, rows = materialise(_bucketed(source, key, buckets), "upsert")
    keys = staged.select(key, BUCKET)
    if replaces is not None:
        keys, _ = materialise(_bucketed(replaces.select(key), key, buckets).select(key, BUCKET).unionByName(keys).distinct(), "upsert-keys")
    # At most one row per bucket.
    touched = {r[BUCKET] for r in keys.select(BUCKET).distinct().collect()}
    if not touched:
        return rows
    if not set(source.columns) <= set(table.columns):
        touched = set(range(buckets))
    kept = table.where(F.col(BUCKET).isin(*touched)).join(keys.select(key), key, "left_anti")
    rewritten, before = table.where(F.col(BUCKET).isin(*touched)), set(table.inputFiles())
    result = kept.unionByName(staged, allowMissingColumns=True)
    seen = Observation(f"upsert-{uuid.uuid4().hex[:8]}")
    again = result.observe(seen, F.count(F.lit(1)).alias("rows"))
    # The table's count comes from the footers of its files.
    few = rewritten.count() + rows < GATHERED_ROWS
    # Read and replaced at once: old files go when all new ones are written.
    _write(again.hint("rebalance", BUCKET) if few else again, path, key, "dynamic")
    left = {f.rsplit("/", 2)[1] for f in before & set(spark.read.parquet(path).inputFiles())}
    for bucket in touched:
        if f"{BUCKET}={bucket}" in left:  # it has no row now
            delete_folder(spark, f"{path}/{OF}={buckets}/{BUCKET}={bucket}")
    if not int(seen.get["rows"]) and table.where(~F.col(BUCKET).isin(*touched)).isEmpty():
        _keep_columns(result, path, buckets)
    return rows
