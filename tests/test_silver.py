from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.plans import silver, staging


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_customers(raw_customers):
    got = by(silver.customers(raw_customers), "customer_id")
    assert len(got) == 5
    assert got["C1"]["email"] == "ann@new.example" and got["C1"]["segment"] == "premium"
    assert {k: v["segment"] for k, v in got.items()} == {
        "C1": "premium", "C2": "standard", "C3": "unknown", "C4": "budget", "C5": "standard"
    }
    assert (got["C3"]["region"], got["C3"]["city"], got["C3"]["country"]) == ("unknown",) * 3
    assert got["C2"]["city"] == "oslo" and got["C2"]["full_name"] == "Bo"
    assert {k: v["email_valid"] for k, v in got.items()} == {"C1": True, "C2": False, "C3": None, "C4": True, "C5": True}
    assert got["C1"]["_silver_version"] == 1


def test_customers_reduced(raw_customers):
    got = by(silver.customers(raw_customers, **silver.REDUCED_OPTIONS["customers"]), "customer_id")
    assert got["C1"]["segment"] == "vip" and got["C3"]["segment"] is None
    assert got["C2"]["city"] == " Oslo" and got["C3"]["region"] == "unknown"


def test_load_time_only_on_request(raw_customers):
    assert "_silver_timestamp" not in silver.customers(raw_customers).columns
    assert "_silver_timestamp" in silver.customers(raw_customers, stamp=True).columns


def test_products(raw_products):
    got = by(silver.products(raw_products), "product_id")
    assert set(got) == {"P1", "P2", "P3", "P4"}
    assert [got[p]["price_tier"] for p in ("P1", "P2", "P3", "P4")] == ["budget", "mid-range", "premium", "luxury"]
    assert got["P2"]["profit_margin"] == Decimal("55.00") and got["P4"]["profit_margin"] == Decimal("-20.00")
    assert got["P1"]["category"] == "home" and got["P1"]["product_name"] == "Lamp "


def test_orders(raw_orders):
    got = by(silver.orders(raw_orders), "order_id")
    assert set(got) == {"O1", "O2", "O3", "O4", "O5", "O7"}  # negative and missing amounts leave
    assert {k: v["status"] for k, v in got.items()} == {
        "O1": "completed", "O2": "cancelled", "O3": "unknown", "O4": "unknown", "O5": "cancelled", "O7": "pending"
    }
    first = got["O1"]
    assert first["net_amount"] == Decimal("140.00") and got["O2"]["net_amount"] == Decimal("75.00")
    assert (first["order_date_key"], first["order_year"], first["order_month"], first["order_day"]) == (20240105, 2024, 1, 5)
    assert (first["order_dayofweek"], first["order_hour"], first["is_weekend"]) == (6, 10, False)
    assert got["O3"]["is_weekend"] is True


def test_orders_reduced_keeps_raw_status(raw_orders):
    got = by(silver.orders(raw_orders, **silver.REDUCED_OPTIONS["orders"]), "order_id")
    assert got["O3"]["status"] == "SHIPPED" and got["O4"]["status"] is None
    assert "order_hour" not in got["O1"]


def test_newest_version_decides_even_if_it_is_invalid(spark, raw_orders):
    """A valid old version does not come back when the newest one is dropped."""
    versions = raw_orders.filter("order_id = 'O1'").withColumn("_ingestion_timestamp", F.lit("2024-01-01").cast("timestamp"))
    bad = versions.withColumns({"total_amount": F.lit(-1.0), "_ingestion_timestamp": F.lit("2024-01-02").cast("timestamp")})
    assert silver.orders(versions.unionByName(bad)).count() == 0


def test_order_items(raw_items):
    got = by(silver.order_items(raw_items), "item_id")
    assert set(got) == {"I1", "I2", "I3", "I4", "I5", "I6", "I9"}
    assert got["I1"]["line_total"] == Decimal("49.98") and got["I1"]["discount"] == 0
    assert got["I2"]["line_total"] == Decimal("89.99")  # 89.991
    assert got["I6"]["line_total"] == Decimal("12.50")  # 12.495 rounds half up
    reduced = by(silver.order_items(raw_items, **silver.REDUCED_OPTIONS["order_items"]), "item_id")
    assert "I8" in reduced and "I7" not in reduced


def test_clickstream(raw_clicks):
    got = by(silver.clickstream(raw_clicks), "event_id")
    assert set(got) == {"E1", "E2", "E3", "E4", "E6"}
    assert {k: v["is_conversion"] for k, v in got.items()} == {"E1": False, "E2": True, "E3": True, "E4": True, "E6": False}
    assert got["E1"]["event_type"] == "page_view" and got["E1"]["event_hour"] == 7


def test_reviews(raw_reviews):
    got = by(silver.reviews(raw_reviews), "review_id")
    assert {k: v["sentiment"] for k, v in got.items()} == {"R1": "positive", "R2": "neutral", "R3": "negative"}
    assert got["R1"]["review_length"] == 4 and got["R2"]["review_length"] is None


def test_staging_differs_from_silver(raw_customers, raw_products, raw_orders, raw_items):
    customers = staging.stg_customers(raw_customers).collect()
    assert len(customers) == 6  # no deduplication
    c = {r["customer_id"]: r for r in customers}
    assert c["C5"]["segment"] == "normal" and c["C2"]["full_name"] is None and c["C2"]["city"] == "Oslo"
    products = by(staging.stg_products(raw_products), "product_id")
    assert products["P1"]["product_name"] == "Lamp" and len(products) == 4
    orders = by(staging.stg_orders(raw_orders), "order_id")
    assert orders["O2"]["shipping_cost"] == 0 and orders["O3"]["status"] == "unknown"
    items = by(staging.stg_order_items(raw_items), "item_id")
    assert items["I2"]["line_total"] == Decimal("89.99") and set(items) == {"I1", "I2", "I3", "I4", "I5", "I6", "I9"}


def test_staging_is_narrow(raw_orders):
    assert "Exchange" not in staging.stg_orders(raw_orders)._jdf.queryExecution().executedPlan().toString()


def test_rows_left_out_are_found_beside_the_cleaned_table_without_ordering_the_valid_ones(spark, tmp_path):
    from tidemark.sources import scratch

    columns = "order_id STRING, customer_id STRING, order_date TIMESTAMP, status STRING, total_amount DOUBLE, shipping_cost DOUBLE, payment_method STRING, _ingestion_timestamp TIMESTAMP"
    day, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(k, "C1", day, "pending", amount, None, "x", at) for k, amount, at in [
        ("valid", 1.0, day), ("bad", -1.0, day), ("mended", -1.0, day), ("mended", 2.0, late),
        ("spoiled", 2.0, day), ("spoiled", None, late), ("spoiled", -3.0, day), ("tied", -1.0, day), ("tied", 5.0, day), (None, -1.0, day),
    ]]
    raw = spark.createDataFrame(rows, columns)
    cleaned, _ = scratch.materialise(silver.orders(raw), "cleaned")
    made = []
    scratch._scopes.append(made)
    try:
        found = silver.rejected_beside(raw, "orders", cleaned)
    finally:
        scratch._scopes.remove(made)
    assert sorted(map(str, found.collect())) == sorted(map(str, silver.rejected(raw, "orders").collect()))
    assert found.columns == silver.rejected(raw, "orders").columns
    assert spark.read.parquet(made[0]).where("order_id = 'valid'").isEmpty()
    assert silver.rejected_beside(raw.where("order_id = 'valid'"), "orders", cleaned).count() == 0
