from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog.tables import land_csv
from tidemark.plans import silver
from tidemark.schemas import SOURCES
from tidemark.sources.keyed import read_keyed
from tidemark.streaming.ingest import drain_to_bronze, drain_to_silver


def contract(df):
    return df.withColumn("shipping_address", F.lit("here"))


def test_drain_reads_every_file_once(spark, tmp_path, raw_orders):
    landing, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land_csv(contract(raw_orders.filter("order_id < 'O4'")), landing)
    args = (spark, landing, "orders", target, state, SOURCES["orders"].schema)
    assert drain_to_bronze(*args).count() == 3
    assert drain_to_bronze(*args).count() == 3
    land_csv(contract(raw_orders.filter("order_id >= 'O4'")), landing, mode="append")
    table = drain_to_bronze(*args, max_files=1)
    assert table.count() == 8 and table.filter("_source_file IS NULL OR _ingestion_timestamp IS NULL").count() == 0


def test_inferred_schema_is_remembered(spark, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    land_csv(spark.createDataFrame([("a", 1)], "k STRING, n INT"), landing)
    drain_to_bronze(spark, landing, "t", target, state)
    land_csv(spark.createDataFrame([("b", "text")], "k STRING, n STRING"), landing, mode="append")
    table = drain_to_bronze(spark, landing, "t", target, state)
    assert dict(table.dtypes)["n"] == "int"
    assert {r["k"]: r["n"] for r in table.collect()} == {"a": 1, "b": None}


def test_stream_upsert_equals_batch(spark, tmp_path, raw_orders):
    landing, bronze, target, state = (str(tmp_path / n) for n in ("in", "bronze", "silver", "state"))
    args = (spark, landing, "orders", "order_id", silver.orders, bronze, target, state, SOURCES["orders"].schema)
    land_csv(contract(raw_orders), landing)
    assert drain_to_silver(*args) == 8
    changed = raw_orders.filter("order_id = 'O7'").withColumn("status", F.lit("delivered"))
    land_csv(contract(changed), landing, mode="append")
    assert drain_to_silver(*args) == 1
    assert drain_to_silver(*args) == 0
    late = raw_orders.withColumn("_ingestion_timestamp", F.lit(datetime(2024, 1, 1)))
    newer = changed.withColumn("_ingestion_timestamp", F.lit(datetime(2024, 1, 2)))
    batch = silver.orders(late.unionByName(newer))
    columns = ["order_id", "status", "total_amount", "net_amount", "order_date_key"]
    got = read_keyed(spark, target).select(columns).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch.select(columns).collect()))
    assert spark.read.parquet(f"{bronze}/_batch=00000000").count() == 8
