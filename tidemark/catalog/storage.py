"""Queries about files: reading, writing, upserting and streaming tables derived from the given data."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.sql_views import AS_OF, VIEWS
from tidemark.catalog.tables import Tables, land_csv
from tidemark.operators.dedup import latest_of
from tidemark.operators.merge import upsert
from tidemark.operators.quality import SILVER_RULES
from tidemark.plans import gold, metrics, silver
from tidemark.plans.run import MedallionRun
from tidemark.schemas import INGESTED_AT, PARTITION_DATE, SOURCES, Layout
from tidemark.sources import run_log, snapshot, warehouse
from tidemark.sources.bronze import ingest_all, ingest_from_config, read_quarantine, with_partition_date, write_bronze
from tidemark.sources.keyed import read_keyed, upsert_keyed
from tidemark.sources.files import REASON, ingest_csv, ingest_csv_checked, ingest_json, ingest_parquet
from tidemark.streaming.ingest import drain_to_bronze, drain_to_silver

_CUSTOMER_COLUMNS = "customer_id, first_name, last_name, email, phone, segment, region, city, country, created_at"

# Scans


@query("scan_csv", f"SELECT {_CUSTOMER_COLUMNS}, 'csv/customers' AS _source_system FROM raw_customers")
def scan_csv(t: Tables) -> DataFrame:
    path = t.scratch("landing")
    land_csv(t.contract("customers"), path)
    read = ingest_csv(t.spark, path, "customers", SOURCES["customers"].schema)
    return read.drop(INGESTED_AT, "_source_file")


@query(
    "scan_csv_infer",
    """SELECT product_id, product_name, category, subcategory, brand, CAST(price AS DOUBLE) AS price, CAST(cost AS DOUBLE) AS cost,
      weight_kg, 'batch-1' AS _batch_id FROM raw_products""",
)
def scan_csv_infer(t: Tables) -> DataFrame:
    path = t.scratch("landing")
    land_csv(t.contract("products").drop("created_at"), path)
    read = ingest_csv(t.spark, path, "products", batch_id="batch-1")
    return read.drop(INGESTED_AT, "_source_file", "_source_system")


@query("scan_json", f"SELECT {_CUSTOMER_COLUMNS}, 'json/customers' AS _source_system FROM raw_customers")
def scan_json(t: Tables) -> DataFrame:
    """One JSON array per file; rows are numbered in reading order, so a file holds at most 10,000 of them."""
    path = t.scratch("landing")
    rows = t.contract("customers")
    part = F.floor(F.monotonically_increasing_id() / 10_000)
    documents = (
        rows.withColumn("part", part)
        .groupBy("part")
        .agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    )
    documents.write.partitionBy("part").text(path)
    read = ingest_json(t.spark, path, "customers", SOURCES["customers"].schema)
    return read.select(*rows.columns, "_source_system")


@query("scan_parquet", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def scan_parquet(t: Tables) -> DataFrame:
    return t.given("orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "audit_columns",
    """SELECT order_id, status, 'parquet/orders' AS _source_system, 'batch-7' AS _batch_id, true AS has_time, true AS has_file
    FROM raw_orders""",
)
def audit_columns(t: Tables) -> DataFrame:
    path = t.scratch("landing")
    t.raw("orders").write.parquet(path)
    return ingest_parquet(t.spark, path, "orders", "batch-7").select(
        "order_id",
        "status",
        "_source_system",
        "_batch_id",
        F.col(INGESTED_AT).isNotNull().alias("has_time"),
        F.col("_source_file").endswith(".parquet").alias("has_file"),
    )


# Lost orders land with a text amount, cancelled paypal orders without a customer.
_DAMAGED = """SELECT *, CASE WHEN status = 'lost' THEN 'malformed record'
  WHEN customer_id IS NULL OR (status = 'canceled' AND payment_method = 'paypal') THEN 'missing customer_id' END AS fault FROM raw_orders"""


def _damaged(orders: DataFrame) -> DataFrame:
    status = F.col("status")
    amount = F.when(status == "lost", F.lit("n/a")).otherwise(F.col("total_amount").cast("string"))
    nobody = (status == "canceled") & (F.col("payment_method") == "paypal")
    return orders.withColumns({"total_amount": amount, "customer_id": F.when(~nobody, F.col("customer_id"))})


@query("quarantine", f"SELECT order_id, coalesce(fault, 'valid') AS reason, CASE WHEN fault IS NULL THEN total_amount END AS total_amount FROM ({_DAMAGED}) d")
def quarantine(t: Tables) -> DataFrame:
    path = t.scratch("landing")
    land_csv(_damaged(t.contract("orders")), path)
    read = ingest_csv_checked(t.spark, path, "orders", SOURCES["orders"].schema)
    amount = F.col("total_amount").cast("decimal(12,2)").alias("total_amount")
    valid = read.valid.select("order_id", F.lit("valid").alias("reason"), amount)
    return valid.unionByName(read.rejected.select("order_id", F.col(REASON).alias("reason"), F.lit(None).cast("decimal(12,2)").alias("total_amount")))


@query("scan_csv_multiline", "SELECT review_id, rating, review_text, helpful_votes FROM raw_reviews")
def scan_csv_multiline(t: Tables) -> DataFrame:
    """Review texts with their line breaks, as they land."""
    path = t.scratch("landing")
    land_csv(t.contract("reviews"), path)
    read = ingest_csv(t.spark, path, "reviews", SOURCES["reviews"].schema, multi_line=SOURCES["reviews"].multi_line)
    return read.select("review_id", "rating", "review_text", "helpful_votes")


# Bronze


@query(
    "bronze_partition_overwrite",
    """SELECT event_id, CASE WHEN CAST(timestamp AS DATE) = (SELECT min(CAST(timestamp AS DATE)) FROM raw_clickstream)
      THEN 'again' ELSE 'first' END AS load, CAST(timestamp AS DATE) AS _partition_date FROM raw_clickstream""",
)
def bronze_partition_overwrite(t: Tables) -> DataFrame:
    """All dates are written, then the first date once more; the other dates stay."""
    path = t.scratch("bronze")
    rows = with_partition_date(t.raw("clickstream"), SOURCES["clickstream"])
    write_bronze(rows.withColumn("load", F.lit("first")), path, [PARTITION_DATE])
    first = rows.agg(F.min(PARTITION_DATE)).head()[0]
    write_bronze(rows.filter(F.col(PARTITION_DATE) == first).withColumn("load", F.lit("again")), path, [PARTITION_DATE])
    return t.spark.read.parquet(path).select("event_id", "load", PARTITION_DATE)


def _land_all(t: Tables, packed: bool = True, **others: DataFrame) -> Layout:
    """All six landing folders, whole and with texts as they are; ``others`` in place of the given ones."""
    layout = Layout(t.scratch("lake"))
    for name in SOURCES:
        land_csv(others.get(name, t.contract(name)), layout.landing(name), packed=packed)
    return layout


# What of each table is compared, with the type that gives both engines the same text.
_CONTENT = {
    "customers": {"email": "", "segment": "", "region": "", "city": "", "phone": ""},
    "products": {"product_name": "", "category": "", "brand": "", "price": "DECIMAL(12,2)", "cost": "DECIMAL(12,2)"},
    "orders": {"customer_id": "", "status": "", "total_amount": "DECIMAL(12,2)", "shipping_cost": "DECIMAL(12,2)", "payment_method": ""},
    "order_items": {"order_id": "", "product_id": "", "quantity": "", "unit_price": "DECIMAL(12,2)", "discount": "DECIMAL(5,4)"},
    "clickstream": {"session_id": "", "customer_id": "", "event_type": "", "device_type": ""},
    "reviews": {"product_id": "", "rating": "", "review_text": "", "helpful_votes": ""},
}
_SILVER_CONTENT = {
    "customers": {"email": "", "segment": "", "full_name": "", "email_valid": ""},
    "products": {"category": "", "price": "DECIMAL(12,2)", "profit_margin": "", "price_tier": ""},
    "orders": {"customer_id": "", "status": "", "net_amount": "DECIMAL(13,2)", "order_date_key": ""},
    "order_items": {"order_id": "", "quantity": "", "line_total": ""},
    "clickstream": {"event_type": "", "event_hour": "", "is_conversion": ""},
    "reviews": {"sentiment": "", "review_length": "", "review_text": ""},
}
_GOLD_CONTENT = {
    "daily_sales": ("sale_date", {"total_orders": "", "unique_customers": "", "gross_revenue": "DECIMAL(22,2)", "ytd_revenue": "DECIMAL(22,2)"}),
    "customer_360": ("customer_id", {"total_orders": "", "total_spend": "DECIMAL(22,2)", "customer_tier": "", "favorite_category": ""}),
    "product_performance": ("product_id", {"total_revenue": "DECIMAL(22,2)", "units_sold": "", "category_revenue_rank": ""}),
}
_HOURLY = ("event_date || ' ' || event_hour || ' ' || device_type", {"total_events": "", "unique_sessions": "", "conversions": "", "conversion_rate": ""})


def _digest(name: str, key: str, content: dict[str, str], source: str = "") -> str:
    """SELECT of table, key and md5 of the compared columns; the same text for Spark and DuckDB but for the source."""
    values = ", ".join(f"coalesce(CAST({f'CAST({c} AS {kind})' if kind else c} AS {{text}}), '~')" for c, kind in content.items())
    return f"SELECT '{name}' AS table_name, CAST({key} AS {{text}}) AS key, md5(concat_ws('|', {values})) AS digest" + (f" FROM {source}" if source else "")


def _digests_sql(parts: list[str]) -> str:
    return "\nUNION ALL ".join(p.replace("{text}", "VARCHAR") for p in parts)


def _digests(frames: dict[str, DataFrame], contents: dict[str, tuple[str, dict[str, str]]]) -> DataFrame:
    """One row per row of each table: its key and the digest of what is compared."""
    result = None
    for name, df in frames.items():
        statement = _digest(name, *contents[name], "{frame}").replace("{text}", "STRING")
        part = df.sparkSession.sql(statement, frame=df)
        result = part if result is None else result.unionByName(part)
    return result


_RAW_KEYED = {n: (s.key, _CONTENT[n]) for n, s in SOURCES.items()}
_RAW_DIGESTS = _digests_sql([_digest(n, *_RAW_KEYED[n], f"raw_{n}") for n in SOURCES])


@query("ingest_all", _RAW_DIGESTS)
def ingest_all_tables(t: Tables) -> DataFrame:
    layout = _land_all(t)
    ingest_all(t.spark, layout, "batch-1")
    return _digests({n: t.spark.read.parquet(layout.bronze(n)) for n in SOURCES}, _RAW_KEYED)


@query("ingest_from_config", _RAW_DIGESTS)
def ingest_config(t: Tables) -> DataFrame:
    layout = _land_all(t, packed=False)
    config = t.scratch("config")
    items = [(n, n) for n in SOURCES]
    t.spark.createDataFrame(items, "tableName STRING, sourcePath STRING").coalesce(1).write.json(config)
    bronze = t.scratch("bronze")
    ingest_from_config(t.spark, t.spark.read.json(config), f"{layout.base}/landing", bronze, date.fromisoformat(AS_OF))
    return _digests({n: t.spark.read.parquet(f"{bronze}/{n}/{AS_OF.replace('-', '/')}") for n in SOURCES}, _RAW_KEYED)


# Snapshots


@query("write_snapshot", "SELECT * FROM silver_products")
def write_snapshot(t: Tables) -> DataFrame:
    return snapshot.write_snapshot(t.silver("products"), t.scratch("products"))


@query("scan_snapshot", "SELECT review_id, product_id, rating, sentiment FROM silver_reviews")
def scan_snapshot(t: Tables) -> DataFrame:
    """The second version replaces the first and brings a new schema."""
    path = t.scratch("reviews")
    snapshot.write_snapshot(t.raw("reviews"), path)
    snapshot.write_snapshot(t.silver("reviews"), path)
    return snapshot.read_snapshot(t.spark, path).select("review_id", "product_id", "rating", "sentiment")


@query("compact", "SELECT * FROM silver_products")
def compact(t: Tables) -> DataFrame:
    path = t.scratch("products")
    snapshot.write_snapshot(t.silver("products").repartition(16), path)
    return snapshot.compact(t.spark, path)


@query(
    "upsert",
    """SELECT order_id, customer_id, CASE WHEN status = 'pending' THEN 'shipped' ELSE status END AS status, total_amount FROM newest_orders
    UNION ALL SELECT 'N' || order_id, customer_id, 'processing', total_amount FROM newest_orders WHERE status = 'lost'""",
)
def upsert_orders(t: Tables) -> DataFrame:
    """Pending orders become shipped, and every lost order is placed again; the same source is applied twice."""
    path = t.scratch("orders")
    newest = latest_of(t.raw("orders"), SOURCES["orders"])
    orders = newest.select("order_id", "customer_id", "status", "total_amount")
    upsert(orders, path, "order_id")
    shipped = orders.filter(F.col("status") == "pending").withColumn("status", F.lit("shipped"))
    again = orders.filter(F.col("status") == "lost").withColumns(
        {"order_id": F.concat(F.lit("N"), "order_id"), "status": F.lit("processing")}
    )
    changes = shipped.unionByName(again)
    upsert(changes, path, "order_id")
    upsert(changes, path, "order_id")
    return read_keyed(t.spark, path)


_REDUCED = ("customers", "products", "orders", "order_items")
_REDUCED_KEYED = {
    "customers": ("customer_id", {"email": "", "segment": "", "full_name": "", "email_valid": ""}),
    "products": ("product_id", {"category": "", "price": "DECIMAL(12,2)", "profit_margin": "", "price_tier": ""}),
    "orders": ("order_id", {"status": "", "net_amount": "DECIMAL(13,2)", "order_year": ""}),
    "order_items": ("item_id", {"order_id": "", "quantity": "", "line_total": ""}),
}


@query("silver_upsert", _digests_sql([_digest(n, *_REDUCED_KEYED[n], f"reduced_{n}") for n in _REDUCED]))
def silver_upsert(t: Tables) -> DataFrame:
    """The four tables of the interactive run arrive in two batches by key; each batch is cleaned and upserted."""
    frames = {}
    for name in _REDUCED:
        path, key, raw = t.scratch(name), SOURCES[name].key, t.raw(name)
        second = F.pmod(F.xxhash64(key), F.lit(5)) == 0
        for batch in (raw.filter(~second), raw.filter(second), raw.filter(second)):
            upsert_keyed(silver.BUILDERS[name](batch, **silver.REDUCED_OPTIONS[name]), path, key, replaces=batch)
        frames[name] = read_keyed(t.spark, path)
    return _digests(frames, _REDUCED_KEYED)


@query("warehouse_load", _digests_sql([_digest(n, *_GOLD_CONTENT[n], f"gold_{n}") for n in warehouse.WAREHOUSE_TABLES]))
def warehouse_load(t: Tables) -> DataFrame:
    """Loaded twice; the second load replaces the first."""
    path = t.scratch("warehouse")
    s = t.silver_set
    orders, items = t.stored("orders"), t.stored("order_items")
    tables = {
        "daily_sales": gold.daily_sales(orders),
        "customer_360": gold.customer_360(s["customers"], orders, items, s["products"], s["reviews"], AS_OF),
        "product_performance": gold.product_performance(s["products"], orders, items, s["reviews"]),
    }
    sink = warehouse.ParquetSink(path)
    warehouse.load_warehouse(tables, sink)
    stored = {n: t.spark.read.parquet(f"{path}/{n}") for n in warehouse.WAREHOUSE_TABLES}
    warehouse.load_warehouse(stored, warehouse.ParquetSink(f"{path}-copy"))
    warehouse.load_warehouse(stored, warehouse.ParquetSink(f"{path}-copy"))
    return _digests({n: t.spark.read.parquet(f"{path}-copy/{n}") for n in warehouse.WAREHOUSE_TABLES}, _GOLD_CONTENT)


@query("audit_append", "SELECT * FROM raw_run_log")
def audit_append(t: Tables) -> DataFrame:
    path = t.scratch("run_log")
    steps = t.raw("run_log")
    run_log.append_frame(steps.filter(F.col("status") == "success"), path)
    run_log.append_frame(steps.filter(F.col("status") != "success"), path)
    return run_log.read_run_log(t.spark, path)


# Streams


def _orders_in_two_parts(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.contract("orders")
    return rows.filter(F.col("payment_method") == "paypal"), rows.filter(F.col("payment_method") != "paypal")


_ORDER_FACTS = "order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount"


@query("stream_ingest", f"SELECT {_ORDER_FACTS}, 'csv/orders' AS _source_system FROM raw_orders")
def stream_ingest(t: Tables) -> DataFrame:
    """Two arrivals with the schema inferred on the first and remembered for the second."""
    landing, target, checkpoint = t.scratch("landing"), t.scratch("bronze"), t.scratch("checkpoint")
    for part in _orders_in_two_parts(t):
        land_csv(part, landing, mode="append")
        table = drain_to_bronze(t.spark, landing, "orders", target, checkpoint)
    return table.select("order_id", "customer_id", "order_date", "status", "total_amount", "_source_system")


@query(
    "stream_exactly_once",
    """SELECT 1 AS run, count(*) AS row_count FROM raw_orders WHERE payment_method = 'paypal'
    UNION ALL SELECT 2, count(*) FROM raw_orders WHERE payment_method = 'paypal'
    UNION ALL SELECT 3, count(*) FROM raw_orders UNION ALL SELECT 4, count(*) FROM raw_orders""",
)
def stream_exactly_once(t: Tables) -> DataFrame:
    """Rows in the table after each of four runs; runs two and four find no new file."""
    landing, target, checkpoint = t.scratch("landing"), t.scratch("bronze"), t.scratch("checkpoint")
    counts = []
    for part in _orders_in_two_parts(t):
        land_csv(part, landing, mode="append")
        for _ in range(2):
            table = drain_to_bronze(t.spark, landing, "orders", target, checkpoint, SOURCES["orders"].schema)
            counts.append((len(counts) + 1, table.count()))
    return t.spark.createDataFrame(counts, "run INT, row_count BIGINT")


@query(
    "stream_upsert",
    """SELECT order_id, CASE WHEN status = 'pending' THEN 'shipped' ELSE status END AS status, total_amount, net_amount FROM silver_orders""",
)
def stream_upsert(t: Tables) -> DataFrame:
    """All orders arrive, then the pending ones again as shipped; silver holds the newest version of each."""
    landing, bronze, target, checkpoint = (t.scratch(n) for n in ("landing", "bronze", "silver", "checkpoint"))
    orders = t.contract("orders")
    shipped = latest_of(orders, SOURCES["orders"]).filter(F.col("status") == "pending").withColumn("status", F.lit("shipped"))
    for part in (orders, shipped):
        land_csv(part, landing, mode="append")
        drain_to_silver(
            t.spark, landing, "orders", "order_id", silver.orders, bronze, target, checkpoint, SOURCES["orders"].schema
        )
    return read_keyed(t.spark, target).select("order_id", "status", "total_amount", "net_amount")


# Whole runs

# Landing files carry no load time, so versions of an item that land together differ by their content alone.
_LANDED = {"raw_order_items": f"SELECT * EXCLUDE (_ingestion_timestamp), CAST(NULL AS TIMESTAMP) AS _ingestion_timestamp FROM ({VIEWS['raw_order_items']}) i"}
_RUN_KEYED = {n: (s.key, _SILVER_CONTENT[n]) for n, s in SOURCES.items()}
_RUN_GOLD = _GOLD_CONTENT | {"hourly_traffic": _HOURLY}
_RUN_PARTS = [_digest(n, *_RUN_KEYED[n], f"silver_{n}") for n in SOURCES] + [_digest(n, *c, f"gold_{n}") for n, c in _RUN_GOLD.items()]
_RUN_SQL = _digests_sql(_RUN_PARTS)


def _landed_orders(condition: str, source: str = VIEWS["raw_orders"]) -> dict[str, str]:
    """What has landed, with the orders that satisfy a condition."""
    return _LANDED | {"raw_orders": f"SELECT * FROM ({source}) o WHERE {condition}"}


def _run_digests(t: Tables, layout: Layout) -> DataFrame:
    """All six silver and all four gold tables."""
    frames = {n: read_keyed(t.spark, layout.silver(n)) for n in SOURCES}
    frames |= {n: snapshot.read_snapshot(t.spark, layout.gold(n)) for n in _RUN_GOLD}
    return _digests(frames, _RUN_KEYED | _RUN_GOLD)


@query("full_run", _RUN_SQL, _LANDED)
def full_run(t: Tables) -> DataFrame:
    """All stages, the warehouse load included."""
    layout = _land_all(t)
    run = MedallionRun(t.spark, layout, AS_OF, "run-1", warehouse=warehouse.ParquetSink(layout.base + "/warehouse"))
    run.run("full")
    return _run_digests(t, layout)


@query("run_modes", _RUN_SQL, _LANDED)
def run_modes(t: Tables) -> DataFrame:
    """An incremental run takes in damaged amounts of the last day; reprocessing the day after a correction mends them."""
    orders = t.contract("orders")
    last_day = orders.agg(F.max(F.to_date("order_date"))).head()[0]
    wrong = F.when(F.to_date("order_date") == F.lit(last_day), F.lit(1.0)).otherwise(F.col("total_amount"))
    layout = _land_all(t, orders=orders.withColumn("total_amount", wrong))
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("incremental")
    land_csv(orders, layout.landing("orders"), mode="overwrite", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("reprocess", batch_date=last_day)
    return _run_digests(t, layout)


@query("run_rebuild", _RUN_SQL, _landed_orders("order_date > TIMESTAMP '1995-06-30'"))
def run_rebuild(t: Tables) -> DataFrame:
    """Dates that leave the landing files leave bronze, silver and gold with the next rebuild."""
    orders = t.contract("orders")
    layout = _land_all(t, orders=orders)
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("full")
    land_csv(orders.filter("order_date > TIMESTAMP '1995-06-30'"), layout.landing("orders"), mode="overwrite", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("full")
    return _run_digests(t, layout)


_LAST_DAY = f"(SELECT max(CAST(order_date AS DATE)) FROM ({VIEWS['raw_orders']}) l)"


@query("run_reprocess_empty", _RUN_SQL, _landed_orders(f"CAST(order_date AS DATE) <> {_LAST_DAY}"))
def run_reprocess_empty(t: Tables) -> DataFrame:
    """A date that has become empty is empty after it is reprocessed."""
    orders = t.contract("orders")
    layout = _land_all(t, orders=orders)
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("full")
    last_day = orders.agg(F.max(F.to_date("order_date"))).head()[0]
    land_csv(orders.filter(F.to_date("order_date") != F.lit(last_day)), layout.landing("orders"), mode="overwrite", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("reprocess", batch_date=last_day)
    return _run_digests(t, layout)


# Star schema and marts of a run

_REPORTING = {
    "dim_date": ("full_date", {"date_key": "", "quarter": "", "month_name": "", "week": "", "day_of_week": "", "is_weekend": "", "fiscal_year": ""}),
    "dim_customer": ("customer_id", {"customer_key": "", "full_name": "", "segment": "", "customer_tier": "", "is_active": ""}),
    "dim_product": ("product_id", {"product_key": "", "product_name": "", "category": "", "price": "DECIMAL(12,2)", "is_active": ""}),
    "fact_orders": ("order_id", {"order_key": "", "customer_key": "", "order_date_key": "", "status": "", "net_amount": "DECIMAL(13,2)"}),
    "fact_order_items": ("item_id", {"item_key": "", "order_key": "", "product_key": "", "quantity": "", "line_total": ""}),
    "mart_daily_sales": ("sale_date", {"total_orders": "", "unique_customers": "", "gross_revenue": "DECIMAL(22,2)", "ytd_revenue": "DECIMAL(22,2)", "month_revenue_rank": ""}),
    "mart_customer_360": ("customer_id", {"total_orders": "", "total_spend": "DECIMAL(22,2)", "unique_products": "", "customer_tier": ""}),
    "mart_product_performance": ("product_id", {"total_revenue": "DECIMAL(22,2)", "units_sold": "", "order_count": "", "overall_revenue_rank": ""}),
}
_FIRST_CUSTOMERS, _FIRST_ORDERS = "right(customer_id, 1) <> '3'", "right(order_id, 1) <> '7'"


def _kept_numbers(view: str, key: str, first: str) -> str:
    """The view with numbers that the first arrival got, and numbers behind them for the second."""
    plain = f"row_number() OVER (ORDER BY {key})"
    first = first.replace(key.split(".")[-1], key)
    number = f"row_number() OVER (PARTITION BY {first} ORDER BY {key}) + CASE WHEN {first} THEN 0 ELSE count(*) FILTER ({first}) OVER () END"
    return VIEWS[view].replace(plain, number)


_SECOND_LOAD = _LANDED | {
    "date_spine": VIEWS["date_spine"].replace("o_orderdate", "order_date").replace("FROM orders)", "FROM silver_orders)"),
    "dim_customer": _kept_numbers("dim_customer", "customer_id", _FIRST_CUSTOMERS),
    "keyed_customers": _kept_numbers("keyed_customers", "customer_id", _FIRST_CUSTOMERS),
    "fact_orders": _kept_numbers("fact_orders", "o.order_id", _FIRST_ORDERS),
}


@query("run_reporting", _digests_sql([_digest(n, *c, n) for n, c in _REPORTING.items()]), _SECOND_LOAD)
def run_reporting(t: Tables) -> DataFrame:
    """Star schema and marts over two arrivals: keys of the full run before stay, facts meet what has arrived since.

    The last day is reprocessed after its orders came as new files, so its streamed rows must not count twice.
    """
    firsts = {"customers": F.expr(_FIRST_CUSTOMERS), "orders": F.expr(_FIRST_ORDERS)}
    options = {"reporting": True, "fiscal_start_month": 7}
    layout = _land_all(t, **{name: t.contract(name).filter(first) for name, first in firsts.items()})
    MedallionRun(t.spark, layout, AS_OF, "run-1", **options).run("full")
    for name, first in firsts.items():
        land_csv(t.contract(name).filter(~first), layout.landing(name), mode="append", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("incremental")
    last_day = t.contract("orders").agg(F.max(F.to_date("order_date"))).head()[0]
    MedallionRun(t.spark, layout, AS_OF, "run-3", **options).run("reprocess", batch_date=last_day)
    frames = {n: snapshot.read_snapshot(t.spark, (layout.mart if n.startswith("mart_") else layout.star)(n)) for n in _REPORTING}
    return _digests(frames, _REPORTING)


# Bad records

_ALL_DAMAGED = _DAMAGED.replace("raw_orders", f"({VIEWS['raw_orders']}) r")
_REFUSED = ("order_id", {"fault": "", "status": ""})


def _refused_sql(condition: str) -> str:
    return _digests_sql([*_RUN_PARTS, _digest("quarantine", *_REFUSED, f"({_ALL_DAMAGED}) d WHERE {condition}")])


def _with_refused(t: Tables, layout: Layout) -> DataFrame:
    refused = read_quarantine(t.spark, layout, "orders").withColumnRenamed(REASON, "fault")
    return _run_digests(t, layout).unionByName(_digests({"quarantine": refused}, {"quarantine": _REFUSED}))


@query("run_quarantine", _refused_sql("fault IS NOT NULL"), _landed_orders("fault IS NULL", _ALL_DAMAGED))
def run_quarantine(t: Tables) -> DataFrame:
    """A run stores the records it rejects with the reason, and cleans the others."""
    layout = _land_all(t, orders=_damaged(t.contract("orders")))
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("full")
    return _with_refused(t, layout)


@query("run_incremental_quarantine", _refused_sql("fault IS NOT NULL"), _landed_orders("fault IS NULL", _ALL_DAMAGED))
def run_incremental_quarantine(t: Tables) -> DataFrame:
    """Damaged orders that arrive after a full run are judged like those that were there."""
    damaged = _damaged(t.contract("orders"))
    first = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    layout = _land_all(t, orders=damaged.filter(first))
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("full")
    land_csv(damaged.filter(~first), layout.landing("orders"), mode="append", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("incremental")
    return _with_refused(t, layout)


_DAMAGED_LAST_DAY = f"fault IS NOT NULL AND CAST(order_date AS DATE) = {_LAST_DAY}"


@query("run_reprocess_quarantine", _refused_sql(_DAMAGED_LAST_DAY), _landed_orders(f"NOT ({_DAMAGED_LAST_DAY})", _ALL_DAMAGED))
def run_reprocess_quarantine(t: Tables) -> DataFrame:
    """All orders are damaged in the landing files, and one date is reprocessed: its bad records are stored."""
    orders = t.contract("orders")
    layout = _land_all(t, orders=orders)
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("full")
    last_day = orders.agg(F.max(F.to_date("order_date"))).head()[0]
    land_csv(_damaged(orders), layout.landing("orders"), mode="overwrite", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("reprocess", batch_date=last_day)
    return _with_refused(t, layout)


# What a run reports

_STATES = _landed_orders("fault IS NULL", _ALL_DAMAGED)
_REFUSED_ORDERS = f"(SELECT count(*) FROM ({_ALL_DAMAGED}) d WHERE fault IS NOT NULL)"


def _without_reviews(t: Tables) -> Layout:
    """All landing folders but that of the reviews; some orders are damaged."""
    layout = Layout(t.scratch("lake"))
    for name in SOURCES:
        if name != "reviews":
            land_csv(_damaged(t.contract(name)) if name == "orders" else t.contract(name), layout.landing(name), packed=True)
    return layout


def _step_sql(step: str, layer: str, tables: tuple[str, ...], missing: tuple[str, ...]) -> str:
    done = [f"SELECT '{step}' AS step, '{n}' AS table_name, 'success' AS status, count(*) AS rows_processed FROM {layer}_{n}" for n in tables if n not in missing]
    return " UNION ALL ".join([*done, *[f"SELECT '{step}', '{n}', 'failed', 0" for n in missing]])


_LOG_SQL = " UNION ALL ".join(
    [
        _step_sql("bronze_ingestion", "raw", tuple(SOURCES), ("reviews",)),
        _step_sql("silver_transformation", "silver", tuple(SOURCES), ("reviews",)),
        f"SELECT 'data_quality', 'silver', 'success', {len(SILVER_RULES)}",
        _step_sql("gold_aggregation", "gold", tuple(_RUN_GOLD), ("customer_360", "product_performance")),
    ]
)


@query(
    "ingest_continue",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, {_REFUSED_ORDERS if n == 'orders' else 0} AS rejected, false AS failed FROM raw_{n}" for n in SOURCES if n != "reviews"
    )
    + " UNION ALL SELECT 'reviews', 0, 0, true",
    _STATES,
)
def ingest_continue(t: Tables) -> DataFrame:
    """One table has no landing files: the others are loaded, and the failure is told with its cause."""
    layout = _without_reviews(t)
    loaded = ingest_all(t.spark, layout, "batch-1", on_error="continue")
    told = t.spark.createDataFrame([(o.table, o.rejected, o.error is not None) for o in loaded], "table_name STRING, rejected BIGINT, failed BOOLEAN")
    sizes = [
        t.spark.read.parquet(layout.bronze(o.table)).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(o.table).alias("table_name"), "row_count")
        for o in loaded
        if o.error is None
    ]
    counted = reduce(DataFrame.unionByName, sizes)
    return told.join(counted, "table_name", "left").select("table_name", F.coalesce("row_count", F.lit(0).cast("long")).alias("row_count"), "rejected", "failed")


def _logged(t: Tables) -> DataFrame:
    layout = _without_reviews(t)
    run = MedallionRun(t.spark, layout, AS_OF, "run-1", on_ingest_error="continue", fail_on_error=False)
    run.run("full")
    return run_log.read_run_log(t.spark, layout.audit)


@query("run_log_of_run", f"SELECT 'run-1' AS run_id, l.*, status = 'failed' AS has_error FROM ({_LOG_SQL}) l", _STATES)
def run_log_of_run(t: Tables) -> DataFrame:
    """The log of a run in which one source is missing: what needs it fails, with an error each, and the rest is built."""
    return _logged(t).select("run_id", "step", "table_name", "status", "rows_processed", F.col("error_message").isNotNull().alias("has_error"))


@query(
    "run_outcome",
    f"""SELECT 'run-1' AS run_id, 'failed' AS outcome, count(*) AS steps, count(*) FILTER (status = 'failed') AS failed_steps,
      sum(rows_processed)::BIGINT AS rows_processed,
      string_agg(step || '.' || table_name, ', ' ORDER BY step || '.' || table_name) FILTER (status = 'failed') AS failures
    FROM ({_LOG_SQL}) l""",
    _STATES,
)
def run_outcome(t: Tables) -> DataFrame:
    return metrics.outcomes(_logged(t))


_NEWEST_LEFT_OUT = """
SELECT 'products' AS table_name, product_id AS key, CASE WHEN price > 0 THEN 'cost is not positive' ELSE 'price is not positive' END AS reason
FROM raw_products WHERE product_id NOT IN (SELECT product_id FROM silver_products)
UNION ALL SELECT 'orders', order_id, 'total_amount is missing or negative' FROM newest_orders WHERE NOT coalesce(total_amount >= 0, false)
UNION ALL SELECT 'clickstream', event_id, 'event_type is missing' FROM raw_clickstream WHERE event_type IS NULL
UNION ALL SELECT 'reviews', review_id, 'rating is not from 1 to 5' FROM raw_reviews WHERE NOT coalesce(rating BETWEEN 1 AND 5, false)
"""


@query("silver_rejected", _NEWEST_LEFT_OUT, _LANDED)
def silver_rejected(t: Tables) -> DataFrame:
    """What a run leaves out of the cleaned tables, with the reason; half of the orders and clicks arrive later."""
    def later(name: str) -> Column:
        return F.pmod(F.xxhash64(SOURCES[name].key), F.lit(2)) == 1

    layout = _land_all(t, **{name: t.contract(name).filter(~later(name)) for name in ("orders", "clickstream")})
    MedallionRun(t.spark, layout, AS_OF, "run-1").run("full")
    for name in ("orders", "clickstream"):
        land_csv(t.contract(name).filter(later(name)), layout.landing(name), mode="append", packed=True)
    MedallionRun(t.spark, layout, AS_OF, "run-2").run("incremental")
    found = None
    for name, source in SOURCES.items():
        rows = t.spark.read.parquet(layout.rejected(name)).select(F.lit(name).alias("table_name"), F.col(source.key).alias("key"), F.col(REASON).alias("reason"))
        found = rows if found is None else found.unionByName(rows)
    return found
