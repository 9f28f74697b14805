"""Landing files to bronze folders."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.schemas import PARTITION_DATE, SOURCES, Layout, SourceTable
from tidemark.sources.files import CORRUPT, REASON, ingest_csv, judge_csv
from tidemark.sources.parallel import run_parallel
from tidemark.sources.scratch import delete_folder, folder_exists, materialise

log = logging.getLogger(__name__)

#: Rows of a file that is not cut by date, so that a task that sorts what it reads need not take more.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class Loaded:
    """Outcome of loading one table."""

    table: str
    rows: int
    seconds: float
    error: str | None = None
    rejected: int = 0


def write_counted(df: DataFrame, write: Callable[[DataFrame], object]) -> int:
    """Write and count in one pass."""
    seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"])


def with_partition_date(df: DataFrame, table: SourceTable) -> DataFrame:
    """Event tables get the date they are partitioned by; others stay as they are."""
    if table.event_time is None:
        return df
    return df.withColumn(PARTITION_DATE, F.to_date(table.event_time))


def write_bronze(df: DataFrame, path: str, partition_by: Sequence[str] = (), replace: str = "dynamic") -> None:
    """Overwrite the folder: all of it (``replace="static"``) or only the partitions that occur in ``df``.

    The rebalance hint brings rows together by partition value, so a date becomes a few files instead of one per
    task, and lets adaptive execution split a date that exceeds the advisory partition size.  Files are cut by date
    anyway, so small shuffle partitions are left apart: merging them would only queue their dates in one task.
    """
    if not partition_by:
        df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd").parquet(path)
        return
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", replace).option("compression", "zstd")
    with setting(df.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        writer.partitionBy(*partition_by).parquet(path)


_settings_lock = threading.Lock()
_settings_held: dict[str, tuple[int, str | None]] = {}


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting while any thread writes: the first one in sets it, the last one out puts back what was there."""
    with _settings_lock:
        inside, before = _settings_held.get(name, (0, None))
        if not inside:
            before = spark.conf.get(name, None)
            spark.conf.set(name, value)
        _settings_held[name] = (inside + 1, before)
    try:
        yield
    finally:
        with _settings_lock:
            inside, before = _settings_held.pop(name)
            if inside > 1:
                _settings_held[name] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, before)


_setting = setting


def write_bronze_date(df: DataFrame, path: str, day: str) -> None:
    """Replace the folder of one date, also by nothing."""
    df.drop(PARTITION_DATE).write.mode("overwrite").parquet(f"{path}/{PARTITION_DATE}={day}")


def drop_streamed_date(spark: SparkSession, path: str, schema: StructType, event_time: str, day: str) -> None:
    """Take one date out of the rows that came as new files; only the arrivals that hold it are rewritten."""
    if not folder_exists(spark, path):
        return
    streamed = spark.read.schema(StructType([*schema.fields, StructField("_batch", StringType())])).parquet(path)
    own = F.coalesce(F.to_date(event_time) == F.lit(day).cast("date"), F.lit(False))
    # At most one row per arrival.
    touched = [r["_batch"] for r in streamed.filter(own).select("_batch").distinct().collect()]
    if not touched:
        return
    # Stored first: a partition cannot be overwritten while it is read.
    kept, rows = materialise(streamed.filter(F.col("_batch").isin(touched) & ~own), "streamed-rest")
    if rows:
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)
    filled = {r["_batch"] for r in kept.select("_batch").distinct().collect()} if rows else set()
    for batch in set(touched) - filled:
        delete_folder(spark, f"{path}/_batch={batch}")


def write_judged(judged: DataFrame, typed: dict[str, Column], write: Callable[[DataFrame], object], quarantine: str, always: bool = False) -> tuple[int, int]:
    """Hand the valid records, typed, to ``write`` and store the others with their reason.  Returns both counts.

    Counts come from the write; the records are read a second time only where some are bad.  ``always`` writes the
    quarantine folder also without a bad record, so that it holds nothing from before.
    """
    seen = Observation(f"judged-{uuid.uuid4().hex[:8]}")
    bad = F.col(REASON).isNotNull()
    counted = judged.observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
    write(counted.filter(~bad).drop(CORRUPT, REASON).withColumns(typed))
    rows, rejected = int(seen.get["rows"]), int(seen.get["rejected"])
    if rejected or always:
        (judged.filter(bad) if rejected else judged.limit(0)).write.mode("overwrite").parquet(quarantine)
    return rows, rejected


def read_quarantine(spark: SparkSession, layout: Layout, table: str) -> DataFrame | None:
    """All rejected records of a table, of whole loads, new files and reprocessed dates; None if there are none."""
    found = []
    for path in (layout.quarantine(table), layout.quarantine_streaming(table), layout.quarantine_reprocessed(table)):
        if folder_exists(spark, path):
            found.append(spark.read.parquet(path))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None


def load_table(
    spark: SparkSession, layout: Layout, table: SourceTable, batch_id: str, infer: bool = False, replace: str = "static"
) -> Loaded:
    """Landing files to bronze; records that break the contract go to the table's quarantine folder with the reason."""
    started = time.monotonic()
    partitions = [PARTITION_DATE] if table.event_time else []
    landing = layout.landing(table.name)
    if infer:
        raw = with_partition_date(ingest_csv(spark, landing, table.name, None, batch_id, table.multi_line), table)
        rows = write_counted(raw, lambda df: write_bronze(df, layout.bronze(table.name), partitions, replace))
        return Loaded(table.name, rows, time.monotonic() - started)
    judged, typed = judge_csv(spark, landing, table.name, table.schema, batch_id, table.multi_line)

    def write(valid: DataFrame) -> None:
        write_bronze(with_partition_date(valid, table), layout.bronze(table.name), partitions, replace)

    rebuild = replace == "static"
    rows, rejected = write_judged(judged, typed, write, layout.quarantine(table.name), always=rebuild)
    if rebuild:  # all landing files have been judged again
        delete_folder(spark, layout.bronze_streaming(table.name))
        delete_folder(spark, layout.quarantine_streaming(table.name))
        delete_folder(spark, layout.quarantine_reprocessed(table.name))
    return Loaded(table.name, rows, time.monotonic() - started, rejected=rejected)


def ingest_all(
    spark: SparkSession,
    layout: Layout,
    batch_id: str,
    tables: Iterable[str] = tuple(SOURCES),
    on_error: str = "raise",
    workers: int = 4,
) -> list[Loaded]:
    """Load the named tables side by side.

    ``on_error="continue"`` records a failure in its outcome and goes on; ``"raise"`` stops the run.
    """
    if on_error not in ("raise", "continue"):
        raise ValueError(f"unknown error handling: {on_error}")

    def job(name: str) -> Callable[[], Loaded]:
        def load() -> Loaded:
            started = time.monotonic()
            try:
                return load_table(spark, layout, SOURCES[name], batch_id)
            except Exception as error:
                seconds = time.monotonic() - started
                if on_error == "raise":
                    raise
                log.warning("ingest of %s failed: %s", name, error)
                return Loaded(name, 0, seconds, str(error).splitlines()[0])

        return load

    return run_parallel(spark, [job(t) for t in tables], workers)


def ingest_from_config(
    spark: SparkSession, config: DataFrame, landing: str, bronze: str, day: date, workers: int = 4
) -> list[Loaded]:
    """Copy the tables listed in a configuration frame (``tableName``, ``sourcePath``; one row per table).

    ``<landing>/<sourcePath>/*.csv`` becomes snappy Parquet in ``<bronze>/<tableName>/yyyy/MM/dd``; records of a known
    table that break its contract go to ``<bronze>/_quarantine/<tableName>/yyyy/MM/dd`` with the reason.
    """
    items = config.select("tableName", "sourcePath").collect()

    def job(table: str, source: str) -> Callable[[], Loaded]:
        def copy() -> Loaded:
            started = time.monotonic()
            files = {"recursiveFileLookup": True, "pathGlobFilter": "*.csv"}
            dated = f"{table}/{day:%Y/%m/%d}"

            def write(df: DataFrame) -> None:
                df.write.mode("overwrite").option("compression", "snappy").parquet(f"{bronze}/{dated}")

            if table not in SOURCES:
                reader = spark.read.option("header", True).option("escape", '"').options(**files)
                return Loaded(table, write_counted(reader.csv(f"{landing}/{source}"), write), time.monotonic() - started)
            known = SOURCES[table]
            judged, typed = judge_csv(spark, f"{landing}/{source}", table, known.schema, None, known.multi_line, **files)
            audit = [c for c in judged.columns if c not in {*known.schema.names, CORRUPT, REASON}]
            rows, rejected = write_judged(judged, typed, lambda df: write(df.drop(*audit)), f"{bronze}/_quarantine/{dated}", always=True)
            return Loaded(table, rows, time.monotonic() - started, rejected=rejected)

        return copy

    return run_parallel(spark, [job(i["tableName"], i["sourcePath"]) for i in items], workers)
