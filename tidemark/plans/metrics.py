"""Run metrics over the run log.

Log columns: run_id, pipeline_name, step, table_name, status, rows_processed, execution_time,
error_message, created_at.  "Latest" figures use ``max_by``, which aggregates map-side, so a log with one
very busy pipeline is no harder than an even one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent

# Step names by layer, and the oldest allowed success.
LAYER_OF_STEP = {"bronze_ingestion": "bronze", "silver_transformation": "silver", "gold_aggregation": "gold"}
QUALITY_STEP = "data_quality"
STALE_AFTER_HOURS = 25


def _at(as_of: date | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp")


def run_summary(run_log: DataFrame) -> DataFrame:
    """Steps, successes, failures and seconds of every run."""
    return run_log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("steps"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.sum("execution_time").alias("total_seconds"),
    )


def outcomes(run_log: DataFrame) -> DataFrame:
    """Outcome of every run: failed when one of its steps failed, with the steps and tables that did."""
    step = F.concat("step", F.lit("."), "table_name")
    failed = F.col("status") == "failed"
    return run_log.groupBy("run_id").agg(
        F.when(F.count_if(failed) > 0, "failed").otherwise("success").alias("outcome"),
        F.count(F.lit(1)).alias("steps"),
        F.count_if(failed).alias("failed_steps"),
        F.sum("rows_processed").alias("rows_processed"),
        F.array_join(F.sort_array(F.collect_set(F.when(failed, step))), ", ").alias("failures"),
    )


def layer_row_counts(run_log: DataFrame) -> DataFrame:
    """Rows of the latest successful load of each table in each layer."""
    layer = F.lit(None).cast("string")
    for step, name in LAYER_OF_STEP.items():
        layer = F.when(F.col("step") == step, F.lit(name)).otherwise(layer)
    loads = run_log.filter((F.col("status") == "success") & F.col("step").isin(*LAYER_OF_STEP))
    newest = F.struct("created_at", "rows_processed")
    return loads.groupBy(layer.alias("layer"), "table_name").agg(
        F.max_by("rows_processed", newest).alias("row_count"), F.max("created_at").alias("loaded_at")
    )


def quality_score(run_log: DataFrame) -> DataFrame:
    """Share of passed quality steps per run, and whether to raise an alert."""
    checks = run_log.filter(F.col("step") == QUALITY_STEP)
    return (
        checks.groupBy("run_id")
        .agg(
            F.count_if(F.col("status") == "success").alias("checks_passed"),
            F.count_if(F.col("status") != "success").alias("checks_failed"),
        )
        .withColumn("score", percent(F.col("checks_passed"), F.col("checks_passed") + F.col("checks_failed")))
        .withColumn("alert", F.col("checks_failed") > 0)
    )


def run_staleness(run_log: DataFrame, as_of: date | str, limit_hours: int = STALE_AFTER_HOURS) -> DataFrame:
    """Whole hours since the last success of each pipeline; a pipeline that never succeeded is stale."""
    success = F.when(F.col("status") == "success", F.col("created_at"))
    last = run_log.groupBy("pipeline_name").agg(F.max(success).alias("last_success"))
    hours = F.timestamp_diff("HOUR", F.col("last_success"), _at(as_of)).cast("int")
    overdue = F.col("last_success") < _at(as_of) - F.make_dt_interval(hours=F.lit(limit_hours))
    return last.withColumns(
        {"hours_since_success": hours, "is_stale": F.coalesce(overdue, F.lit(True))}
    )


def run_metrics(run_log: DataFrame, as_of: date | str, window_hours: int = 24) -> DataFrame:
    """Current status and last duration per step; failure rate and rows over the window before ``as_of``."""
    order = F.struct("created_at", "run_id", "table_name", "rows_processed", "execution_time", "status")
    start = _at(as_of) - F.make_dt_interval(hours=F.lit(window_hours))
    recent = (F.col("created_at") > start) & (F.col("created_at") <= _at(as_of))
    return (
        run_log.groupBy("pipeline_name", "step")
        .agg(
            F.max_by("status", order).alias("current_status"),
            F.max_by("execution_time", order).alias("last_duration"),
            F.count_if(recent).alias("recent_runs"),
            F.count_if(recent & (F.col("status") == "failed")).alias("recent_failures"),
            F.coalesce(F.sum(F.when(recent, F.col("rows_processed"))), F.lit(0).cast("bigint")).alias("recent_rows"),
        )
        .withColumn("failure_rate", percent(F.col("recent_failures"), F.col("recent_runs")))
    )
