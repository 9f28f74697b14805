import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_customers(spark):
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [
        ("C1", "Ann", "Lee", "ann@example.com", "+1", "premium", "East", "Rome", "IT", datetime(2023, 1, 1), first),
        ("C1", "Ann", "Lee", "ann@new.example", "+1", "VIP", "West", "Rome", "IT", datetime(2023, 1, 1), second),
        ("C2", "Bo", None, "not-an-address", None, "  Regular ", "north", " Oslo", "NO", datetime(2023, 2, 1), first),
        ("C3", "Cy", "Ek", None, None, None, None, None, None, datetime(2023, 3, 1), first),
        ("C4", "Di", "Fo", "di@x.io", None, "budget", "south", "Bern", "CH", datetime(2023, 4, 1), first),
        ("C5", "Ed", "Go", "ed@x.io", None, "normal", "south", "Bern", "CH", datetime(2023, 4, 1), first),
    ]
    return spark.createDataFrame(
        rows,
        "customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING, segment STRING, "
        "region STRING, city STRING, country STRING, created_at TIMESTAMP, _ingestion_timestamp TIMESTAMP",
    )


@pytest.fixture
def raw_products(spark):
    rows = [
        ("P1", "Lamp ", " Home ", "Light", "Acme", 24.99, 10.0, 0.5),
        ("P2", "Desk", "HOME", "Office", "Acme", 99.99, 45.0, 20.0),
        ("P3", "Phone", "tech", "Mobile", "Bell", 499.99, 250.0, 0.2),
        ("P4", "Laptop", "Tech", "Mobile", "Bell", 500.0, 600.0, 2.0),
        ("P5", "Broken", "tech", "Mobile", "Bell", -5.0, -2.0, 0.1),
        ("P6", "No cost", "tech", "Mobile", "Bell", 5.0, None, 0.1),
    ]
    return spark.createDataFrame(
        rows,
        "product_id STRING, product_name STRING, category STRING, subcategory STRING, brand STRING, price DOUBLE, "
        "cost DOUBLE, weight_kg DOUBLE",
    )


@pytest.fixture
def raw_orders(spark):
    rows = [
        ("O1", "C1", datetime(2024, 1, 5, 10, 30), "completed", 150.0, 10.0, "card"),
        ("O2", "C1", datetime(2024, 1, 6), "canceled", 75.0, None, "card"),
        ("O3", "C2", datetime(2024, 1, 6, 23, 59, 59), "SHIPPED", 20.5, 0.5, "cash"),
        ("O4", "C2", datetime(2024, 2, 1), None, 10.0, 1.0, "cash"),
        ("O5", "C9", datetime(2024, 2, 1), "refunded", 99.0, 1.0, "cash"),
        ("O6", "C4", datetime(2024, 2, 2), "pending", -1.0, 1.0, "cash"),
        ("O7", "C4", datetime(2024, 2, 2), "pending", 0.0, 1.0, "cash"),
        ("O8", "C4", datetime(2024, 2, 2), "pending", None, 1.0, "cash"),
    ]
    return spark.createDataFrame(
        rows,
        "order_id STRING, customer_id STRING, order_date TIMESTAMP, status STRING, total_amount DOUBLE, "
        "shipping_cost DOUBLE, payment_method STRING",
    )


@pytest.fixture
def raw_items(spark):
    rows = [
        ("I1", "O1", "P1", 2, 24.99, None),
        ("I2", "O1", "P2", 1, 99.99, 0.1),
        ("I3", "O2", "P3", 1, 499.99, 0.25),
        ("I4", "O3", "P1", 4, 24.99, 0.0),
        ("I5", "O3", "P3", 1, 499.99, 0.0),
        ("I6", "O1", "P1", 1, 24.99, 0.5),
        ("I7", "O4", "P1", 0, 24.99, 0.0),
        ("I8", "O4", "P1", 1, 0.0, 0.0),
        ("I9", "O99", "P99", 1, 1.0, 0.0),
    ]
    return spark.createDataFrame(
        rows, "item_id STRING, order_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, discount DOUBLE"
    )


@pytest.fixture
def raw_clicks(spark):
    at = datetime(2024, 1, 1, 7, 15)
    rows = [
        ("E1", "S1", "C1", " Page_View", "Mobile", at),
        ("E2", "S1", "C1", "purchase", "mobile ", at),
        ("E3", "S1", None, "add_to_cart", "mobile", at),
        ("E4", "S2", None, "checkout", "mobile", at),
        ("E5", "S2", None, None, "mobile", at),
        ("E6", None, "C2", "page_view", "desktop", at),
    ]
    return spark.createDataFrame(
        rows,
        "event_id STRING, session_id STRING, customer_id STRING, event_type STRING, device_type STRING, timestamp TIMESTAMP",
    )


@pytest.fixture
def raw_reviews(spark):
    rows = [
        ("R1", "P1", "C1", 5, "good", 3),
        ("R2", "P1", "C1", 3, None, 0),
        ("R3", "P1", "C2", 1, "bad", 1),
        ("R4", "P2", "C2", 0, "out of range", 1),
        ("R5", "P2", "C2", 6, "out of range", 1),
        ("R6", "P2", "C2", None, "no rating", 1),
    ]
    return spark.createDataFrame(
        rows,
        "review_id STRING, product_id STRING, customer_id STRING, rating INT, review_text STRING, helpful_votes BIGINT",
    )
