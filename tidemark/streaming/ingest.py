"""New landing files as a stream: drain what has arrived, then stop.

The checkpoint remembers the files already read.  There is no event-time state, so nothing grows with the
age of the stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.schemas import SOURCES
from tidemark.sources.bronze import write_judged
from tidemark.sources.keyed import BUCKETS, upsert_keyed
from tidemark.sources.files import CORRUPT, REASON, add_audit_columns, judgement, text_fields


def remembered_schema(spark: SparkSession, path: str, store: str) -> StructType:
    """Schema inferred on the first run and kept beside the checkpoint for every later run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        inferred = spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path).schema
        spark.createDataFrame([(inferred.json(),)], "value STRING").coalesce(1).write.text(store)
    return StructType.fromJson(json.loads(spark.read.text(store).head()["value"]))


def file_stream(
    spark: SparkSession, path: str, table: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """CSV arrivals with audit columns; ``max_files`` bounds one micro-batch of a large backlog."""
    reader = spark.readStream.schema(schema).option("header", True).option("escape", '"')
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("multiLine", table in SOURCES and SOURCES[table].multi_line)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return add_audit_columns(reader.csv(path), f"csv/{table}")


def drain_to_bronze(
    spark: SparkSession,
    path: str,
    table: str,
    target: str,
    checkpoint: str,
    schema: StructType | None = None,
    max_files: int | None = None,
    quarantine: str | None = None,
) -> DataFrame:
    """Append all new files to ``target``; a repeated call adds nothing.  Returns the table so far.

    With ``quarantine``, records that break the schema go there with the reason, one partition per batch; without
    it, a field that is no value of its type becomes null.
    """
    known = schema if schema is not None else remembered_schema(spark, path, f"{checkpoint}/schema")
    if quarantine is not None:
        reason, typed = judgement(known)

        def split(batch: DataFrame, batch_id: int) -> None:
            part = f"_batch={batch_id:08d}"
            judged = batch.withColumn(REASON, reason)
            write_judged(judged, typed, lambda df: df.write.mode("overwrite").parquet(f"{target}/{part}"), f"{quarantine}/{part}")

        text = file_stream(spark, path, table, text_fields(known), max_files)
        writer = text.writeStream.foreachBatch(split).trigger(availableNow=True)
        writer.option("checkpointLocation", f"{checkpoint}/state").start().awaitTermination()
        return spark.read.schema(text.drop(CORRUPT).withColumns(typed).schema).parquet(target).drop("_batch")
    stream = file_stream(spark, path, table, known, max_files)
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{checkpoint}/state").option("path", target).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def drain_to_silver(
    spark: SparkSession,
    path: str,
    table: str,
    key: str,
    transform: Callable[[DataFrame], DataFrame],
    bronze: str,
    silver: str,
    checkpoint: str,
    schema: StructType,
    max_files: int | None = None,
    buckets: int = BUCKETS,
    quarantine: str | None = None,
    left_out: Callable[[DataFrame], DataFrame] | None = None,
    rejected: str | None = None,
) -> int:
    """Bring new files into bronze and upsert their cleaned rows into silver.  Returns the valid records read.

    Records that break the contract go to ``quarantine`` (a folder beside bronze by default) with the reason, one
    partition per batch; with ``left_out`` (called when silver holds the batch) and ``rejected``, rows that the cleaned
    table leaves out are stored too.  A batch that is repeated after a failure replaces its own partitions and upserts the same rows, so the result is the
    same.
    """
    read = 0
    refused = quarantine or f"{bronze}_quarantine"
    reason, typed = judgement(schema)

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal read
        part = f"_batch={batch_id:08d}"
        folder = f"{bronze}/{part}"
        judged = batch.withColumn(REASON, reason)
        rows, _ = write_judged(judged, typed, lambda df: df.write.mode("overwrite").parquet(folder), f"{refused}/{part}")
        read += rows
        kept = judged.drop(CORRUPT, REASON).withColumns(typed).schema
        landed = batch.sparkSession.read.schema(kept).parquet(folder)
        # A key whose newest version is invalid leaves silver, as it does when everything is rebuilt.
        # The transform leaves one row per key; only the buckets of the batch's keys are rewritten.
        upsert_keyed(transform(landed), silver, key, replaces=landed, buckets=buckets)
        if left_out is not None and rejected is not None:
            left_out(landed).write.mode("overwrite").parquet(f"{rejected}/{part}")

    stream = file_stream(spark, path, table, text_fields(schema), max_files)
    writer = stream.writeStream.foreachBatch(apply).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{checkpoint}/state").start().awaitTermination()
    return read


def mark_as_read(spark: SparkSession, path: str, table: str, checkpoint: str, schema: StructType) -> None:
    """Move the checkpoint behind the files that are there now, without reading them: a rebuild has taken them in."""
    writer = file_stream(spark, path, table, schema).writeStream.foreachBatch(lambda batch, batch_id: None).trigger(availableNow=True)
    writer.option("checkpointLocation", f"{checkpoint}/state").start().awaitTermination()
