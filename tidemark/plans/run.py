"""A whole run over a folder layout: ingest, clean, check, aggregate, log.

Stages follow each other through files; tables inside a stage do not depend on each other and are submitted
side by side.  Row counts come from the writes themselves.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.operators.merge import replace_slice
from tidemark.operators.quality import SILVER_RULES, evaluate, gate
from tidemark.plans import gold, marts, silver, staging, star
from tidemark.schemas import INGESTED_AT, PARTITION_DATE, SOURCES, Layout, SourceTable
from tidemark.sources.bronze import drop_streamed_date, ingest_all, setting, write_bronze_date, write_counted
from tidemark.sources.files import CORRUPT, REASON, judge_csv
from tidemark.sources.keyed import BUCKETS, read_keyed, write_keyed
from tidemark.sources.parallel import run_parallel
from tidemark.sources.run_log import StepRecord, append_steps, now
from tidemark.sources.scratch import delete_folder, folder_exists, materialise, scratch_scope
from tidemark.sources.snapshot import read_snapshot, snapshot_exists, write_snapshot
from tidemark.sources.warehouse import WAREHOUSE_TABLES, JdbcSink, ParquetSink
from tidemark.streaming.ingest import drain_to_silver, mark_as_read

log = logging.getLogger(__name__)

MODES = ("full", "incremental", "reprocess")

# Versions are ordered in the tasks that read them, before the shuffle: a share of rows that is sorted in memory.
SORTED_SPLITS = ("spark.sql.files.maxPartitionBytes", "16m")


@dataclass(frozen=True)
class Outcome:
    """What a stage did with one table."""

    table: str
    rows: int
    seconds: float
    error: str | None = None


@dataclass
class MedallionRun:
    """One run.

    ``gate_mode`` says what failed quality checks do (``warn`` or ``fail``); ``fail_on_error`` says whether a
    failed step stops the run or is only logged; ``on_ingest_error`` says the same of one table's landing files
    (``raise`` or ``continue`` with the other tables).  With a ``warehouse`` sink the run ends with the load of the
    warehouse tables.  ``buckets`` is how many hash buckets a silver table gets when it is first written.  ``reporting``
    also builds the star schema, whose surrogate keys stay what they were in the run before, and the marts over every
    landed version; ``fiscal_start_month`` is for its calendar.  Intermediate tables of the run are deleted when it ends.
    """

    spark: SparkSession
    layout: Layout
    as_of: date | str
    run_id: str
    gate_mode: str = "warn"
    fail_on_error: bool = True
    on_ingest_error: str = "raise"
    workers: int = 4
    buckets: int = BUCKETS
    name: str = "daily_etl"
    warehouse: ParquetSink | JdbcSink | None = None
    reporting: bool = False
    fiscal_start_month: int = 1
    steps: list[StepRecord] = field(default_factory=list)

    def run(self, mode: str = "full", batch_date: date | str | None = None) -> list[StepRecord]:
        """``full`` rebuilds everything, ``incremental`` takes new landing files only, ``reprocess`` replaces
        one date of the event tables."""
        if mode not in MODES:
            raise ValueError(f"unknown mode: {mode}")
        if mode == "reprocess" and batch_date is None:
            raise ValueError("reprocess needs a batch date")
        try:
            with scratch_scope(self.spark):
                if mode == "full":
                    self._stage("bronze_ingestion", self.ingest)
                    self._stage("silver_transformation", self.clean)
                elif mode == "incremental":
                    self._stage("silver_transformation", self.clean_new_files)
                else:
                    self._stage("silver_transformation", lambda: self.replace_date(str(batch_date)))
                self._stage("data_quality", self.check)
                self._stage("gold_aggregation", self.aggregate)
                if self.reporting:
                    self._stage("star_dimensions", self.dimensions)
                    self._stage("star_facts", self.facts)
                    self._stage("marts", self.build_marts)
                if self.warehouse is not None:
                    self._stage("warehouse_load", self.load)
        finally:
            append_steps(self.spark, self.layout.audit, self.steps)
        return self.steps

    def _stage(self, step: str, work: Callable[[], list[Outcome]]) -> None:
        """Run a stage; every table gets a log row with its own rows, seconds and error."""
        started = time.monotonic()
        outside: Exception | None = None
        try:
            outcomes = work()
        except Exception as error:  # not the failure of one table
            outside = error
            outcomes = [Outcome("all", 0, time.monotonic() - started, _first_line(error))]
        for o in outcomes:
            status = "success" if o.error is None else "failed"
            self.steps.append(StepRecord(self.run_id, self.name, step, o.table, status, o.rows, int(o.seconds), o.error, now()))
        failed = [o for o in outcomes if o.error is not None]
        tolerated = step == "bronze_ingestion" and self.on_ingest_error == "continue"
        if failed and self.fail_on_error and not tolerated:
            raise outside or StageError(step, failed)
        for o in failed:
            log.warning("%s of %s failed: %s", step, o.table, o.error)

    def _each(self, jobs: Mapping[str, Callable[[], int]]) -> list[Outcome]:
        """Run the tables of a stage side by side; a failure of one does not hide what the others did."""

        def timed(table: str, job: Callable[[], int]) -> Callable[[], Outcome]:
            def run() -> Outcome:
                started = time.monotonic()
                try:
                    return Outcome(table, job(), time.monotonic() - started)
                except Exception as error:
                    return Outcome(table, 0, time.monotonic() - started, _first_line(error))

            return run

        return run_parallel(self.spark, [timed(t, j) for t, j in jobs.items()], self.workers)

    def _silver(self, table: str) -> DataFrame:
        return read_keyed(self.spark, self.layout.silver(table))

    def _bronze(self, table: str, path: str) -> DataFrame:
        with setting(self.spark, *self._listing()):
            return self.spark.read.schema(_bronze_schema(table)).parquet(path)

    def _listing(self) -> tuple[str, str]:
        """The folders of all dates are listed by a few tasks, not by one each."""
        return "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(2 * self.spark.sparkContext.defaultParallelism)

    def _landed(self, table: str) -> DataFrame:
        """Every version in bronze, from whole loads and from new files."""
        schema, found = _bronze_schema(table), []
        for path in (self.layout.bronze(table), self.layout.bronze_streaming(table)):
            if folder_exists(self.spark, path):
                found.append(self._bronze(table, path).select(schema.names))
        if not found:
            raise FileNotFoundError(f"no bronze of {table}")
        return reduce(DataFrame.unionByName, found)

    def _previous(self, table: str) -> DataFrame | None:
        path = self.layout.star(table)
        return read_snapshot(self.spark, path) if snapshot_exists(self.spark, path) else None

    def _built(self, table: str) -> DataFrame:
        return read_snapshot(self.spark, self.layout.star(table))

    # Stages

    def ingest(self) -> list[Outcome]:
        loaded = ingest_all(self.spark, self.layout, self.run_id, on_error="continue", workers=self.workers)
        return [Outcome(t.table, t.rows, t.seconds, t.error) for t in loaded]

    def clean(self) -> list[Outcome]:
        """Rebuild silver from bronze; what landed so far is not new to a later incremental run."""

        def job(table: str) -> Callable[[], int]:
            def build() -> int:
                bronze = self._bronze(table, self.layout.bronze(table))
                cleaned = silver.BUILDERS[table](bronze, stamp=True)
                with setting(self.spark, *SORTED_SPLITS):
                    rows = write_keyed(cleaned, self.layout.silver(table), SOURCES[table].key, self.buckets)
                delete_folder(self.spark, self.layout.rejected(table))
                left_out = silver.rejected_beside(bronze, table, self._silver(table))
                left_out.write.mode("overwrite").parquet(f"{self.layout.rejected(table)}/_run={self.run_id}/_batch=full")
                mark_as_read(self.spark, self.layout.landing(table), table, self.layout.checkpoint(table), SOURCES[table].schema)
                return rows

            return build

        return self._each({t: job(t) for t in SOURCES})

    def clean_new_files(self) -> list[Outcome]:
        """Stream new landing files into bronze and upsert them into silver."""

        def job(table: str) -> Callable[[], int]:
            def drain() -> int:
                return drain_to_silver(
                    self.spark,
                    self.layout.landing(table),
                    table,
                    SOURCES[table].key,
                    lambda df: silver.BUILDERS[table](df, stamp=True),
                    bronze=self.layout.bronze_streaming(table),
                    silver=self.layout.silver(table),
                    checkpoint=self.layout.checkpoint(table),
                    schema=SOURCES[table].schema,
                    buckets=self.buckets,
                    quarantine=self.layout.quarantine_streaming(table),
                    left_out=lambda df: silver.rejected_beside(df, table, read_keyed(df.sparkSession, self.layout.silver(table))),
                    rejected=f"{self.layout.rejected(table)}/_run={self.run_id}",
                )

            return drain

        return self._each({t: job(t) for t in SOURCES})

    def replace_date(self, batch_date: str) -> list[Outcome]:
        """Re-ingest one date of the event tables: one bronze folder, and that date's rows in silver, even if none is left."""

        def job(table: SourceTable) -> Callable[[], int]:
            def replace() -> int:
                # Read once: the records of the day, and the bad ones whose day cannot be read.
                judged, typed = judge_csv(self.spark, self.layout.landing(table.name), table.name, table.schema, self.run_id, table.multi_line)
                own_day, bad = F.to_date(F.col(table.event_time).try_cast("timestamp")), F.col(REASON).isNotNull()
                wanted = F.coalesce(own_day == F.lit(batch_date).cast("date"), bad)
                found, _ = materialise(judged.filter(wanted), "reprocess")
                found.filter(bad).write.mode("overwrite").parquet(f"{self.layout.quarantine_reprocessed(table.name)}/{PARTITION_DATE}={batch_date}")
                again = found.filter(~bad).drop(CORRUPT, REASON).withColumns(typed)
                write_bronze_date(again, self.layout.bronze(table.name), batch_date)
                drop_streamed_date(self.spark, self.layout.bronze_streaming(table.name), _bronze_schema(table.name), table.event_time, batch_date)
                cleaned = silver.BUILDERS[table.name](again, stamp=True)
                # The keys the day had before leave, and those it has now, valid or not.
                rows = replace_slice(cleaned, self.layout.silver(table.name), table.key, table.event_time, batch_date, again, self.buckets)
                left_out = silver.rejected_beside(again, table.name, self._silver(table.name))
                left_out.write.mode("overwrite").parquet(f"{self.layout.rejected(table.name)}/_run={self.run_id}/_batch={batch_date}")
                return rows

            return replace

        return self._each({t.name: job(t) for t in SOURCES.values() if t.event_time})

    def check(self) -> list[Outcome]:
        started = time.monotonic()
        tables = {t: self._silver(t) for t in ("orders", "customers", "products", "order_items")}
        results = evaluate(SILVER_RULES, tables, "silver").withColumn("run_id", F.lit(self.run_id))
        rows = write_counted(results, lambda df: df.write.mode("append").parquet(self.layout.quality))
        stored = self.spark.read.parquet(self.layout.quality).filter(F.col("run_id") == self.run_id)
        gate(stored, self.gate_mode)
        return [Outcome("silver", rows, time.monotonic() - started)]

    def aggregate(self) -> list[Outcome]:
        """Gold tables; a silver table that is missing stops those alone that are built from it."""

        def of(*tables: str) -> list[DataFrame]:
            return [self._silver(t) for t in tables]

        builders: dict[str, Callable[[], DataFrame]] = {
            "daily_sales": lambda: gold.daily_sales(*of("orders"), stamp=True, stored=True),
            "customer_360": lambda: gold.customer_360(
                *of("customers", "orders", "order_items", "products", "reviews"), self.as_of, stamp=True
            ),
            "product_performance": lambda: gold.product_performance(
                *of("products", "orders", "order_items", "reviews"), stamp=True
            ),
            "hourly_traffic": lambda: gold.hourly_traffic(*of("clickstream"), stamp=True),
        }

        return self._snapshots(builders, self.layout.gold)

    def _snapshots(self, builders: Mapping[str, Callable[[], DataFrame]], path: Callable[[str], str]) -> list[Outcome]:
        def job(table: str) -> Callable[[], int]:
            return lambda: write_counted(builders[table](), lambda df: write_snapshot(df, path(table)))

        return self._each({t: job(t) for t in builders})

    def dimensions(self) -> list[Outcome]:
        """Dimensions of the star schema; the tiers are those of the gold profile."""

        def customers() -> DataFrame:
            tiers = read_snapshot(self.spark, self.layout.gold("customer_360")).select("customer_id", "customer_tier")
            return star.dim_customer(self._silver("customers"), tiers, stamp=True, previous=self._previous("dim_customer"))

        return self._snapshots(
            {
                "dim_date": lambda: star.dim_date(star.date_spine_of(self._silver("orders"), "order_date"), self.fiscal_start_month),
                "dim_customer": customers,
                "dim_product": lambda: star.dim_product(self._silver("products"), stamp=True, previous=self._previous("dim_product")),
            },
            self.layout.star,
        )

    def facts(self) -> list[Outcome]:
        """The order fact, then the item fact, which looks up its order there."""

        def orders() -> DataFrame:
            return star.fact_orders(self._silver("orders"), self._built("dim_customer"), stamp=True, previous=self._previous("fact_orders"))

        def items() -> DataFrame:
            found = self._silver("order_items"), self._built("fact_orders"), self._built("dim_product")
            return star.fact_order_items(*found, stamp=True, previous=self._previous("fact_order_items"))

        done = self._snapshots({"fact_orders": orders}, self.layout.star)
        if done[0].error is not None:  # the items would meet the orders of the run before
            return [*done, Outcome("fact_order_items", 0, 0.0, "fact_orders failed")]
        return [*done, *self._snapshots({"fact_order_items": items}, self.layout.star)]

    def build_marts(self) -> list[Outcome]:
        customers, products, orders, items = (
            getattr(staging, f"stg_{t}")(self._landed(t)) for t in ("customers", "products", "orders", "order_items")
        )
        return self._snapshots(
            {
                "mart_daily_sales": lambda: marts.mart_daily_sales(orders, stamp=True),
                "mart_customer_360": lambda: marts.mart_customer_360(customers, orders, items, self.as_of, stamp=True),
                "mart_product_performance": lambda: marts.mart_product_performance(products, orders, items, stamp=True),
            },
            self.layout.mart,
        )

    def load(self) -> list[Outcome]:
        """Hand the gold tables to the warehouse."""

        def job(table: str) -> Callable[[], int]:
            gold_table = read_snapshot(self.spark, self.layout.gold(table))
            return lambda: write_counted(gold_table, lambda df: self.warehouse.write(df, table))

        return self._each({t: job(t) for t in WAREHOUSE_TABLES})


class StageError(RuntimeError):
    """A stage failed for some of its tables."""

    def __init__(self, step: str, failed: list[Outcome]):
        super().__init__(f"{step} failed: " + "; ".join(f"{o.table}: {o.error}" for o in failed))


def _first_line(error: Exception) -> str:
    return (str(error).splitlines() or [type(error).__name__])[0]


def _bronze_schema(table: str) -> StructType:
    """Contract and audit columns of a bronze table; the partition date is left to the folder names."""
    schema = StructType([StructField(f.name, f.dataType, True) for f in SOURCES[table].schema.fields])
    for column in ("_source_file", "_source_system", "_batch_id"):
        schema = schema.add(column, "string")
    return schema.add(INGESTED_AT, "timestamp")
