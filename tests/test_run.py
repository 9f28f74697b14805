import os

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES, storage
from tidemark.catalog.tables import Tables, land_csv
from tidemark.operators.quality import QualityGateError
from tidemark.plans.run import MedallionRun
from tidemark.schemas import SOURCES, Layout
from tidemark.sources import files, run_log, snapshot
from tidemark.sources.bronze import read_quarantine
from tidemark.sources.keyed import read_keyed

AS_OF = "2024-02-10"


@pytest.fixture
def layout(tmp_path, raw_customers, raw_products, raw_orders, raw_items, raw_clicks, raw_reviews):
    layout = Layout(str(tmp_path))
    raw = (raw_customers, raw_products, raw_orders, raw_items, raw_clicks, raw_reviews)
    for (name, table), df in zip(SOURCES.items(), raw):
        columns = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema]
        land_csv(df.select(columns), layout.landing(name))
    return layout


def counts(spark, layout):
    return {t: read_keyed(spark, layout.silver(t)).count() for t in SOURCES}


EXPECTED = {"customers": 5, "products": 4, "orders": 6, "order_items": 7, "clickstream": 5, "reviews": 3}


def test_full_run(spark, layout):
    steps = MedallionRun(spark, layout, AS_OF, "r1").run()
    assert counts(spark, layout) == EXPECTED
    assert snapshot.read_snapshot(spark, layout.gold("customer_360")).count() == 5
    log = run_log.read_run_log(spark, layout.audit)
    assert log.count() == len(steps) == 6 + 6 + 1 + 4
    assert {r["status"] for r in log.collect()} == {"success"}
    rows = {(r["step"], r["table_name"]): r["rows_processed"] for r in log.collect()}
    assert rows["bronze_ingestion", "orders"] == 8 and rows["silver_transformation", "orders"] == 6
    assert rows["data_quality", "silver"] == 15 and rows["gold_aggregation", "daily_sales"] == 4
    assert spark.read.parquet(layout.quality).filter("NOT passed").count() == 3  # C9, O99 and P99 have no partner


def test_incremental_run_takes_new_files_only(spark, layout, raw_orders):
    MedallionRun(spark, layout, AS_OF, "r1").run("incremental")
    assert counts(spark, layout) == EXPECTED
    more = raw_orders.filter("order_id = 'O7'").withColumns({"order_id": F.lit("O20"), "shipping_address": F.lit("x")})
    land_csv(more, layout.landing("orders"), mode="append")
    run = MedallionRun(spark, layout, AS_OF, "r2")
    run.run("incremental")
    assert counts(spark, layout) == EXPECTED | {"orders": 7}
    read = {s.table_name: s.rows_processed for s in run.steps if s.step == "silver_transformation"}
    assert read["orders"] == 1 and read["customers"] == 0


def test_reprocess_replaces_one_date(spark, layout, raw_orders):
    MedallionRun(spark, layout, AS_OF, "r1").run()
    corrected = raw_orders.filter("order_id <> 'O4'").withColumn(
        "total_amount", F.when(F.col("order_id") == "O5", 1.0).when(F.col("order_id") == "O1", 2.0).otherwise(F.col("total_amount"))
    )
    land_csv(corrected.withColumn("shipping_address", F.lit("x")), layout.landing("orders"), mode="overwrite")
    MedallionRun(spark, layout, AS_OF, "r2").run("reprocess", "2024-02-01")
    got = {r["order_id"]: float(r["total_amount"]) for r in read_keyed(spark, layout.silver("orders")).collect()}
    # O4 left the date, O5 changed on it; O1 is of another date and keeps its old amount.
    assert "O4" not in got and got["O5"] == 1.0 and got["O1"] == 150.0
    assert spark.read.parquet(layout.bronze("orders")).count() == 7


def test_reprocess_reads_the_landing_files_once(spark, layout, monkeypatch, raw_orders):
    MedallionRun(spark, layout, AS_OF, "r1").run()
    bad = raw_orders.withColumns({"customer_id": F.when(F.col("order_id") != "O4", F.col("customer_id")), "shipping_address": F.lit("x")})
    land_csv(bad, layout.landing("orders"), mode="overwrite")
    seen, judge = spark.sparkContext.accumulator(0), files.judge_csv

    def count(key):
        seen.add(1)
        return True

    counted = F.udf(count, "boolean").asNondeterministic()  # no other filter goes before it

    def watched(spark, path, table, *rest):
        judged, typed = judge(spark, path, table, *rest)
        return judged.filter(counted(SOURCES[table].key)), typed

    for place in ("tidemark.sources.files.judge_csv", "tidemark.plans.run.judge_csv"):
        monkeypatch.setattr(place, watched, raising=False)
    MedallionRun(spark, layout, AS_OF, "r2").run("reprocess", "2024-02-01")
    assert seen.value == 8 + 6  # orders and clicks
    assert "O4" not in {r["order_id"] for r in read_keyed(spark, layout.silver("orders")).collect()}
    refused = read_quarantine(spark, layout, "orders")
    assert [(r["order_id"], r["_reject_reason"]) for r in refused.collect()] == [("O4", "missing customer_id")]


def test_folders_of_all_dates_are_listed_by_few_tasks(spark, layout):
    days = spark.range(60).selectExpr("CAST(id AS STRING) AS order_id", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS _partition_date")
    days.coalesce(1).write.partitionBy("_partition_date").parquet(layout.bronze("orders"))
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("listing", "listing")
    try:
        landed = MedallionRun(spark, layout, AS_OF, "r1")._landed("orders")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    found = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert found and max(found) <= 2 * context.defaultParallelism < 60
    assert landed.count() == 60


def test_gate_can_stop_the_run(spark, layout):
    run = MedallionRun(spark, layout, AS_OF, "r1", gate_mode="fail")
    with pytest.raises(QualityGateError):
        run.run()
    assert [s.status for s in run.steps if s.step == "data_quality"] == ["failed"]
    assert not [s for s in run.steps if s.step == "gold_aggregation"]
    assert run_log.read_run_log(spark, layout.audit).filter("status = 'failed'").count() == 1


def test_run_can_go_on_after_a_failed_step(spark, layout):
    run = MedallionRun(spark, layout, AS_OF, "r1", gate_mode="fail", fail_on_error=False)
    run.run()
    assert [s.status for s in run.steps if s.step == "data_quality"] == ["failed"]
    assert len([s for s in run.steps if s.step == "gold_aggregation"]) == 4


def test_bad_arguments(spark, layout):
    run = MedallionRun(spark, layout, AS_OF, "r1")
    with pytest.raises(ValueError, match="unknown mode"):
        run.run("partial")
    with pytest.raises(ValueError, match="batch date"):
        run.run("reprocess")


def test_rebuild_forgets_what_left_the_landing_files(spark, layout, raw_orders):
    MedallionRun(spark, layout, AS_OF, "r1").run()
    land_csv(raw_orders.filter("order_id <> 'O4'").withColumn("shipping_address", F.lit("x")), layout.landing("orders"), mode="overwrite")
    MedallionRun(spark, layout, AS_OF, "r2").run()
    assert counts(spark, layout) == EXPECTED | {"orders": 5}


def test_rejected_records_are_stored_and_tables_logged_one_by_one(spark, layout, raw_orders):
    bad = raw_orders.withColumn("customer_id", F.when(F.col("order_id") != "O1", F.col("customer_id")))
    land_csv(bad.withColumn("shipping_address", F.lit("x")), layout.landing("orders"), mode="overwrite")
    run = MedallionRun(spark, layout, AS_OF, "r1", on_ingest_error="continue")
    run.run()
    rejected = spark.read.parquet(layout.quarantine("orders")).collect()
    assert [(r["order_id"], r["_reject_reason"]) for r in rejected] == [("O1", "missing customer_id")]
    assert counts(spark, layout) == EXPECTED | {"orders": 5}
    assert len([s for s in run.steps if s.step == "bronze_ingestion"]) == 6


def test_incremental_after_full_reads_new_files_only(spark, layout, raw_orders):
    MedallionRun(spark, layout, AS_OF, "r1").run()
    bad = raw_orders.filter("order_id = 'O1'").withColumns({"total_amount": F.lit(-1.0), "shipping_address": F.lit("x")})
    land_csv(bad, layout.landing("orders"), mode="append")
    run = MedallionRun(spark, layout, AS_OF, "r2")
    run.run("incremental")
    assert {s.table_name: s.rows_processed for s in run.steps if s.step == "silver_transformation"}["orders"] == 1
    assert counts(spark, layout) == EXPECTED | {"orders": 5}  # its newest version is invalid


def star_keys(spark, layout, table, natural, surrogate):
    return {r[natural]: r[surrogate] for r in snapshot.read_snapshot(spark, layout.star(table)).collect()}


def test_star_schema_keeps_its_keys_and_marts_count_every_version_once(spark, layout, raw_customers, raw_orders):
    land_csv(raw_customers.filter("customer_id <> 'C1'").select(*SOURCES["customers"].schema.names), layout.landing("customers"), mode="overwrite")
    run = MedallionRun(spark, layout, AS_OF, "r1", reporting=True)
    run.run()
    assert [s.table_name for s in run.steps if s.step == "star_facts"] == ["fact_orders", "fact_order_items"]
    assert {s.status for s in run.steps} == {"success"} and len([s for s in run.steps if s.step == "marts"]) == 3
    first = star_keys(spark, layout, "dim_customer", "customer_id", "customer_key")
    assert "C1" not in first and first[None] == -1
    orders = star_keys(spark, layout, "fact_orders", "order_id", "order_key")
    land_csv(raw_customers.filter("customer_id = 'C1'").select(*SOURCES["customers"].schema.names), layout.landing("customers"), mode="append")
    more = raw_orders.filter("order_id = 'O5'").withColumns({"order_id": F.lit("A0"), "customer_id": F.lit("C1"), "shipping_address": F.lit("x")})
    land_csv(more, layout.landing("orders"), mode="append")
    MedallionRun(spark, layout, AS_OF, "r2", reporting=True).run("incremental")
    assert star_keys(spark, layout, "dim_customer", "customer_id", "customer_key") == first | {"C1": max(first.values()) + 1}
    assert star_keys(spark, layout, "fact_orders", "order_id", "order_key") == orders | {"A0": max(orders.values()) + 1}
    before = {r["sale_date"]: r for r in snapshot.read_snapshot(spark, layout.mart("mart_daily_sales")).collect()}
    day = more.select(F.to_date("order_date").alias("d")).head()["d"]
    # The day's rows that came as a new file are replaced with it; rebuilding takes in all files at once.
    for run_id, mode in (("r3", "reprocess"), ("r4", "full")):
        MedallionRun(spark, layout, AS_OF, run_id, reporting=True).run(mode, day if mode == "reprocess" else None)
        after = {r["sale_date"]: r for r in snapshot.read_snapshot(spark, layout.mart("mart_daily_sales")).collect()}
        assert after.keys() == before.keys()
        assert all(after[d]["gross_revenue"] == before[d]["gross_revenue"] and after[d]["total_orders"] == before[d]["total_orders"] for d in after)
        assert star_keys(spark, layout, "fact_orders", "order_id", "order_key")["A0"] == max(orders.values()) + 1


def test_failed_order_fact_stops_the_item_fact(spark, layout, monkeypatch):
    def broken(*rest, **options):
        raise RuntimeError("no orders")

    monkeypatch.setattr("tidemark.plans.run.star.fact_orders", broken)
    run = MedallionRun(spark, layout, AS_OF, "r1", reporting=True, fail_on_error=False)
    run.run()
    assert [(s.table_name, s.error_message) for s in run.steps if s.status == "failed"] == [("fact_orders", "no orders"), ("fact_order_items", "fact_orders failed")]


TEST_TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


class Landed(Exception):
    pass


@pytest.mark.skipif(not os.path.isdir(TEST_TABLES), reason="test tables are not here")
@pytest.mark.parametrize("name", ["run_rebuild", "run_reprocess_empty", "run_quarantine"])
def test_registered_runs_land_whole_tables(spark, monkeypatch, name):
    class Look:
        def __init__(self, spark, layout, *rest):
            self.layout = layout

        def run(self, *rest, **options):
            raise Landed({n: spark.read.option("multiLine", True).option("escape", '"').csv(self.layout.landing(n), header=True).count() for n in SOURCES})

    monkeypatch.setattr(storage, "MedallionRun", Look)
    with pytest.raises(Landed) as landed:
        QUERIES[name](spark, TEST_TABLES)
    given = Tables(spark, TEST_TABLES)
    assert landed.value.args[0] == {n: given.contract(n).count() for n in SOURCES}
