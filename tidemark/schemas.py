"""The six source tables: column contract, business key and how duplicates are ordered."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

INGESTED_AT = "_ingestion_timestamp"
PARTITION_DATE = "_partition_date"


@dataclass(frozen=True)
class SourceTable:
    """Contract of one source table.

    ``ties`` lists the columns that order two versions of a key which arrived in the same batch, so
    that the surviving version never depends on row order.  ``hashed_ties`` are long text columns
    that take part through a 64-bit hash: the sort and the shuffle then carry eight bytes, not the text.
    ``multi_line`` says that quoted fields may hold line breaks; such files are read whole, one task each.
    """

    name: str
    ddl: str
    key: str
    ties: tuple[str, ...]
    hashed_ties: tuple[str, ...] = ()
    event_time: str | None = None
    multi_line: bool = False

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


SOURCES: dict[str, SourceTable] = {
    t.name: t
    for t in (
        SourceTable(
            "customers",
            "customer_id STRING NOT NULL, first_name STRING, last_name STRING, email STRING, phone STRING, "
            "segment STRING, region STRING, city STRING, country STRING, created_at TIMESTAMP",
            key="customer_id",
            ties=("created_at", "email", "phone", "segment", "region", "city", "country", "first_name", "last_name"),
        ),
        SourceTable(
            "products",
            "product_id STRING NOT NULL, product_name STRING, category STRING, subcategory STRING, brand STRING, "
            "price DOUBLE, cost DOUBLE, weight_kg DOUBLE, created_at TIMESTAMP",
            key="product_id",
            ties=("created_at", "price", "cost", "category", "subcategory", "brand", "product_name", "weight_kg"),
        ),
        SourceTable(
            "orders",
            "order_id STRING NOT NULL, customer_id STRING NOT NULL, order_date TIMESTAMP, status STRING, "
            "total_amount DOUBLE, shipping_cost DOUBLE, payment_method STRING, shipping_address STRING",
            key="order_id",
            ties=("order_date", "status", "total_amount", "customer_id", "shipping_cost", "payment_method"),
            hashed_ties=("shipping_address",),
            event_time="order_date",
        ),
        SourceTable(
            "order_items",
            "item_id STRING NOT NULL, order_id STRING NOT NULL, product_id STRING NOT NULL, quantity INT, "
            "unit_price DOUBLE, discount DOUBLE",
            key="item_id",
            ties=("order_id", "product_id", "quantity", "unit_price", "discount"),
        ),
        SourceTable(
            "clickstream",
            "event_id STRING NOT NULL, session_id STRING, customer_id STRING, event_type STRING, page_url STRING, "
            "referrer STRING, device_type STRING, browser STRING, timestamp TIMESTAMP",
            key="event_id",
            ties=("timestamp", "session_id", "customer_id", "event_type", "device_type", "browser"),
            hashed_ties=("page_url", "referrer"),
            event_time="timestamp",
        ),
        SourceTable(
            "reviews",
            "review_id STRING NOT NULL, product_id STRING NOT NULL, customer_id STRING NOT NULL, rating INT, "
            "review_text STRING, helpful_votes BIGINT, created_at TIMESTAMP",
            key="review_id",
            ties=("created_at", "rating", "helpful_votes", "product_id", "customer_id"),
            hashed_ties=("review_text",),
            multi_line=True,
        ),
    )
}


@dataclass(frozen=True)
class Layout:
    """Folder of every table of every layer below one base path."""

    base: str

    def landing(self, table: str) -> str:
        return f"{self.base}/landing/{table}"

    def bronze(self, table: str) -> str:
        return f"{self.base}/bronze/{table}"

    def bronze_streaming(self, table: str) -> str:
        return f"{self.base}/bronze/{table}_streaming"

    def quarantine(self, table: str) -> str:
        return f"{self.base}/quarantine/{table}"

    def quarantine_streaming(self, table: str) -> str:
        return f"{self.base}/quarantine/{table}_streaming"

    def quarantine_reprocessed(self, table: str) -> str:
        return f"{self.base}/quarantine/{table}_reprocessed"

    def rejected(self, table: str) -> str:
        """Rows that reached bronze and that the cleaned table leaves out."""
        return f"{self.base}/rejected/{table}"

    def silver(self, table: str) -> str:
        return f"{self.base}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.base}/gold/{table}"

    def star(self, table: str) -> str:
        return f"{self.base}/star/{table}"

    def mart(self, table: str) -> str:
        return f"{self.base}/marts/{table}"

    def warehouse(self, table: str) -> str:
        return f"{self.base}/warehouse/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.base}/_checkpoints/{table}"

    @property
    def audit(self) -> str:
        return f"{self.base}/audit/run_log"

    @property
    def quality(self) -> str:
        return f"{self.base}/audit/quality_results"
