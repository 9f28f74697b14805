from decimal import Decimal

import pytest

from tidemark.plans import gold, marts, metrics, serving, silver, staging, star

AS_OF = "2024-02-10"


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture
def s(raw_customers, raw_products, raw_orders, raw_items, raw_clicks, raw_reviews):
    raw = {
        "customers": raw_customers, "products": raw_products, "orders": raw_orders, "order_items": raw_items,
        "clickstream": raw_clicks, "reviews": raw_reviews,
    }
    return {t: silver.BUILDERS[t](df) for t, df in raw.items()}


@pytest.fixture
def stg(raw_customers, raw_products, raw_orders, raw_items):
    return {
        "customers": staging.stg_customers(raw_customers),
        "products": staging.stg_products(raw_products),
        "orders": staging.stg_orders(raw_orders),
        "items": staging.stg_order_items(raw_items),
    }


def test_daily_sales(s):
    got = {str(k): v for k, v in by(gold.daily_sales(s["orders"]), "sale_date").items()}
    assert set(got) == {"2024-01-05", "2024-01-06", "2024-02-01", "2024-02-02"}
    assert got["2024-01-06"]["total_orders"] == 1 and got["2024-01-06"]["gross_revenue"] == Decimal("20.50")
    assert got["2024-02-02"]["ytd_revenue"] == Decimal("180.50") and got["2024-02-02"]["ytd_orders"] == 4
    assert got["2024-02-01"]["moving_avg_7d_revenue"] == pytest.approx(180.5 / 3)
    assert got["2024-01-05"]["total_shipping"] == Decimal("10.00")


def test_customer_360(s):
    got = by(gold.customer_360(s["customers"], s["orders"], s["order_items"], s["products"], s["reviews"], AS_OF), "customer_id")
    assert set(got) == {"C1", "C2", "C3", "C4", "C5"}
    c1, c2, c3 = got["C1"], got["C2"], got["C3"]
    assert (c1["total_orders"], c1["total_spend"], c1["days_since_last_order"]) == (1, Decimal("150.00"), 36)
    assert c1["lifetime_value_estimate"] == Decimal("180.00")
    assert (c1["rfm_recency_score"], c1["rfm_frequency_score"], c1["rfm_monetary_score"]) == (4, 1, 2)
    assert c1["customer_tier"] == "new_active"
    # Two home items and, in a cancelled order, one tech item; every line counts once.
    assert c1["favorite_category"] == "home" and c2["favorite_category"] == "home"
    assert (c1["total_reviews"], c1["avg_rating_given"]) == (2, 4.0)
    assert (c3["total_orders"], c3["total_spend"], c3["total_reviews"]) == (0, 0, 0)
    assert c3["avg_order_value"] is None and c3["lifetime_value_estimate"] is None and c3["favorite_category"] is None
    assert c3["rfm_recency_score"] == 1 and c3["customer_tier"] == "at_risk"


def test_simple_tier(s):
    got = by(gold.customer_tier_simple(s["customers"], s["orders"], s["reviews"], AS_OF), "customer_id")
    assert got["C1"]["customer_tier"] == "loyal" and got["C3"]["customer_tier"] == "at_risk"
    assert "rfm_monetary" not in got["C1"]


@pytest.mark.parametrize(
    ("r", "f", "m", "tier"),
    [(4, 4, 4, "champion"), (4, 4, 3, "loyal"), (3, 3, 1, "loyal"), (5, 2, 5, "new_active"), (2, 5, 5, "at_risk"), (3, 2, 5, "regular")],
)
def test_tier_rules(spark, r, f, m, tier):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(r, f, m)], "r INT, f INT, m INT")
    assert df.select(gold.rfm_tier(F.col("r"), F.col("f"), F.col("m"))).head()[0] == tier


def test_product_performance(s):
    df = gold.product_performance(s["products"], s["orders"], s["order_items"], s["reviews"])
    got = by(df, "product_id")
    p1, p2, p3, p4 = (got[p] for p in ("P1", "P2", "P3", "P4"))
    assert (p1["total_revenue"], p1["units_sold"], p1["order_count"]) == (Decimal("162.44"), 7, 2)
    assert (p3["order_count"], p3["cancelled_orders"], p3["cancellation_rate"]) == (1, 1, Decimal("50.00"))
    assert p3["total_revenue"] == Decimal("499.99")
    assert (p4["total_revenue"], p4["order_count"], p4["cancelled_orders"], p4["cancellation_rate"]) == (0, 0, None, 0)
    assert (p1["review_count"], p1["avg_rating"], p1["positive_reviews"], p1["negative_reviews"]) == (3, 3.0, 1, 1)
    assert p2["review_count"] == 0 and p2["positive_reviews"] is None
    assert [p["category_revenue_rank"] for p in (p1, p2, p3, p4)] == [1, 2, 1, 2]


def test_product_performance_with_cancelled(s):
    got = by(gold.product_performance_all(s["products"], s["order_items"], s["reviews"]), "product_id")
    assert got["P3"]["total_revenue"] == Decimal("874.98") and got["P3"]["order_count"] == 2
    assert got["P4"]["order_count"] is None and got["P4"]["total_revenue"] == 0


def test_product_sales_needs_no_expand(s):
    plan = gold.product_sales(s["order_items"], s["orders"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_hourly_traffic(s):
    got = by(gold.hourly_traffic(s["clickstream"]), "device_type")
    m, d = got["mobile"], got["desktop"]
    assert (m["total_events"], m["unique_sessions"], m["unique_users"]) == (4, 2, 1)
    assert (m["page_views"], m["add_to_carts"], m["purchases"], m["conversions"]) == (1, 1, 1, 3)
    assert m["conversion_rate"] == Decimal("150.00")
    assert d["unique_sessions"] == 0 and d["conversion_rate"] == 0


def test_mart_daily_sales(stg):
    rows = marts.mart_daily_sales(stg["orders"]).collect()
    assert [str(r["sale_date"]) for r in rows] == ["2024-01-05", "2024-01-06", "2024-02-01", "2024-02-02"]
    assert [r["dod_change"] for r in rows] == [None, Decimal("-129.50"), Decimal("-10.50"), Decimal("-10.00")]
    assert [r["month_revenue_rank"] for r in rows] == [1, 2, 1, 2]


def test_mart_customer_360(stg):
    df = marts.mart_customer_360(stg["customers"], stg["orders"], stg["items"], AS_OF)
    rows = df.collect()
    got = {r["customer_id"]: r for r in rows}
    assert len(rows) == 6  # both versions of C1
    assert (got["C1"]["total_items_purchased"], got["C1"]["unique_products"]) == (4, 2)
    assert got["C1"]["estimated_ltv"] == Decimal("180.00") and got["C1"]["days_since_last_order"] == 35
    c3 = got["C3"]
    assert (c3["avg_order_value"], c3["estimated_ltv"], c3["days_since_last_order"], c3["rfm_recency"]) == (0, 0, 9999, 1)


def test_mart_product_performance(stg):
    got = by(marts.mart_product_performance(stg["products"], stg["orders"], stg["items"]), "product_id")
    assert got["P1"]["avg_selling_price"] == pytest.approx(24.99) and got["P4"]["avg_selling_price"] == 500.0
    assert {p: r["overall_revenue_rank"] for p, r in got.items()} == {"P3": 1, "P1": 2, "P2": 3, "P4": 4}


def test_date_spine(spark):
    rows = star.date_spine(spark, "2023-12-30", "2024-01-02").orderBy("full_date").collect()
    assert [r["date_key"] for r in rows] == [20231230, 20231231, 20240101, 20240102]
    assert [r["week"] for r in rows] == [52, 52, 1, 1] and [r["day_of_week"] for r in rows] == [6, 0, 1, 2]
    assert rows[0]["month_name"] == "December" and rows[1]["day_name"] == "Sunday" and rows[1]["is_weekend"]
    dim = star.dim_date(star.date_spine(spark, "2024-06-30", "2024-07-01"), 7).orderBy("full_date").collect()
    assert [(r["fiscal_year"], r["fiscal_quarter"], r["is_holiday"]) for r in dim] == [(2024, 4, False), (2025, 1, False)]
    assert star.date_spine(spark, "2023-01-01", "2025-12-31").count() == 1096


def test_star_schema(s):
    tiers = gold.customer_360(s["customers"], s["orders"], s["order_items"], s["products"], s["reviews"], AS_OF)
    customers = star.dim_customer(s["customers"], tiers)
    products = star.dim_product(s["products"])
    orders = star.fact_orders(s["orders"], customers)
    items = by(star.fact_order_items(s["order_items"], orders, products), "item_id")
    assert {r["customer_id"]: r["customer_key"] for r in customers.collect()} == {f"C{i}": i for i in range(1, 6)} | {None: -1}
    facts = by(orders, "order_id")
    assert [facts[o]["order_key"] for o in sorted(o for o in facts if o)] == [1, 2, 3, 4, 5, 6] and facts[None]["order_key"] == -1
    assert by(products, "product_key")[-1]["category"] == "unknown"
    assert facts["O5"]["customer_key"] == star.UNKNOWN_KEY and facts["O1"]["customer_key"] == 1
    assert items["I9"]["order_key"] == -1 and items["I9"]["product_key"] == -1
    assert items["I4"]["order_key"] == facts["O3"]["order_key"] and items["I4"]["product_key"] == 1
    assert sorted(r["item_key"] for r in items.values()) == list(range(1, 8))


def test_serving(stg):
    days = serving.daily_sales(marts.mart_daily_sales(stg["orders"]), 2).collect()
    assert [str(r["sale_date"]) for r in days] == ["2024-02-02", "2024-02-01"]
    mart = marts.mart_customer_360(stg["customers"], stg["orders"], stg["items"], AS_OF)
    assert {r["customer_id"] for r in serving.top_customers(mart, "at_risk").collect()} == {"C3", "C5"}
    products = marts.mart_product_performance(stg["products"], stg["orders"], stg["items"])
    assert [r["product_id"] for r in serving.top_products(products, "tech", 1).collect()] == ["P3"]
    with pytest.raises(ValueError, match="between 1 and 365"):
        serving.daily_sales(days and marts.mart_daily_sales(stg["orders"]), 366)


def test_run_metrics(spark):
    from datetime import datetime

    t = lambda h: datetime(2024, 1, 1, h)
    rows = [
        ("r1", "etl", "bronze_ingestion", "orders", "success", 10, 5, None, t(1)),
        ("r1", "etl", "bronze_ingestion", "orders", "success", 12, 6, None, t(2)),
        ("r1", "etl", "data_quality", "all", "failed", 0, 1, "bad", t(3)),
        ("r2", "etl", "data_quality", "all", "success", 0, 1, None, t(4)),
        ("r3", "never", "data_quality", "all", "failed", 0, 1, "bad", t(4)),
    ]
    from tidemark.sources.run_log import RUN_LOG_DDL

    log = spark.createDataFrame(rows, RUN_LOG_DDL)
    summary = by(metrics.run_summary(log), "run_id")
    assert (summary["r1"]["steps"], summary["r1"]["successful"], summary["r1"]["failed"], summary["r1"]["total_seconds"]) == (3, 2, 1, 12)
    counts = metrics.layer_row_counts(log).collect()
    assert [(r["layer"], r["table_name"], r["row_count"]) for r in counts] == [("bronze", "orders", 12)]
    score = by(metrics.quality_score(log), "run_id")
    assert score["r1"]["score"] == 0 and score["r1"]["alert"] and score["r2"]["score"] == 100
    stale = by(metrics.run_staleness(log, "2024-01-02"), "pipeline_name")
    assert stale["etl"]["hours_since_success"] == 20 and not stale["etl"]["is_stale"] and stale["never"]["is_stale"]
    assert by(metrics.run_staleness(log, "2024-01-03"), "pipeline_name")["etl"]["is_stale"]
    recent = {r["step"]: r for r in metrics.run_metrics(log.filter("pipeline_name = 'etl'"), "2024-01-02").collect()}
    assert recent["data_quality"]["current_status"] == "success" and recent["data_quality"]["failure_rate"] == 50
    assert recent["bronze_ingestion"]["recent_rows"] == 22 and recent["bronze_ingestion"]["last_duration"] == 6


def test_repeated_order_versions_multiply_item_figures(stg):
    """Every staged version of an order counts in sums; distinct counts stay."""
    orders = stg["orders"].unionByName(stg["orders"].filter("order_id = 'O1'"))
    customers = by(marts.mart_customer_360(stg["customers"], orders, stg["items"], AS_OF), "customer_id")
    assert (customers["C1"]["total_items_purchased"], customers["C1"]["unique_products"]) == (8, 2)
    assert (customers["C1"]["total_orders"], customers["C1"]["total_spend"]) == (1, Decimal("300.00"))
    products = by(marts.mart_product_performance(stg["products"], orders, stg["items"]), "product_id")
    assert (products["P2"]["units_sold"], products["P2"]["order_count"]) == (2, 1)
    assert products["P2"]["total_revenue"] == Decimal("179.98") and products["P2"]["avg_selling_price"] == pytest.approx(99.99)


def test_tiers_need_the_orders_alone(spark, raw_customers, raw_orders, raw_items, raw_products, raw_reviews):
    customers, orders = silver.customers(raw_customers), silver.orders(raw_orders)
    whole = gold.customer_360(customers, orders, silver.order_items(raw_items), silver.products(raw_products), silver.reviews(raw_reviews), "2024-02-10")
    tiers = gold.customer_tiers(customers, orders, "2024-02-10")
    assert sorted(map(tuple, tiers.collect())) == sorted(map(tuple, whole.select("customer_id", "customer_tier").collect()))


def test_distinct_counts_copy_no_row(spark, s, raw_orders):
    for df in (gold.hourly_traffic(s["clickstream"]), marts.mart_daily_sales(staging.stg_orders(raw_orders))):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_days_of_stored_orders_shuffle_days_and_customers_alone(spark, s, raw_orders):
    """Cancelled orders, orders without a day or a customer: the same days, and no sum travels with a customer."""
    odd = s["orders"].unionByName(s["orders"].selectExpr("* EXCEPT (order_date, customer_id, order_id)", "order_id || 'x' AS order_id", "CAST(NULL AS TIMESTAMP) AS order_date", "CAST(NULL AS STRING) AS customer_id"))
    once, twice = gold.sales_per_day(odd), gold.sales_per_day(odd, stored=True)
    assert once.columns == twice.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    plan = gold.daily_sales(s["orders"], stored=True)._jdf.queryExecution().optimizedPlan().toString()
    counted = [line for line in plan.splitlines() if "Aggregate" in line and "customer_id" in line]
    assert counted and not any("sum(" in line for line in counted)
