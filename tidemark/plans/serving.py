"""Report queries: bounded top rows of the marts and of the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.topk import top_rows


def daily_sales(mart: DataFrame, limit: int = 30) -> DataFrame:
    """Latest days first."""
    columns = mart.select(
        "sale_date", "total_orders", "unique_customers", "gross_revenue", "net_revenue", "avg_order_value",
        "ytd_revenue", "moving_avg_7d_revenue",
    )
    return top_rows(columns, "sale_date", [], limit, 365)


def top_customers(mart: DataFrame, tier: str | None = None, limit: int = 50) -> DataFrame:
    rows = mart.filter(mart["customer_tier"] == tier) if tier else mart
    columns = rows.select(
        "customer_id", "full_name", "segment", "region", "total_orders", "total_spend", "avg_order_value",
        "customer_tier", "rfm_recency", "rfm_frequency", "rfm_monetary",
    )
    return top_rows(columns, "total_spend", ["customer_id", "full_name", "segment", "region"], limit, 500)


def top_products(mart: DataFrame, category: str | None = None, limit: int = 50) -> DataFrame:
    rows = mart.filter(mart["category"] == category) if category else mart
    columns = rows.select(
        "product_id", "product_name", "category", "brand", "total_revenue", "units_sold", "order_count",
        "category_revenue_rank", "overall_revenue_rank",
    )
    return top_rows(columns, "total_revenue", ["product_id", "product_name", "category", "brand"], limit, 500)


def latest_runs(run_log: DataFrame, limit: int = 10) -> DataFrame:
    columns = run_log.select(
        "pipeline_name", "table_name", "rows_processed", "status", "execution_time", "created_at"
    )
    return top_rows(
        columns, "created_at", ["pipeline_name", "table_name", "status", "rows_processed", "execution_time"], limit, 100
    )
