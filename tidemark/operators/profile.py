"""Table profiles: sizes, missing values, summary figures, value distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, NumericType, StringType

from tidemark.functions.numbers import mean_of, percent


def _unfold(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn one wide row into one row per struct."""
    return df.select(F.inline(F.array(*rows)))


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column count of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with nulls, their number and share; one scan per table."""
    parts = []
    for name, df in tables.items():
        counted = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"_missing_{i}") for i, c in enumerate(df.columns)],
        )
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col(f"_missing_{i}").alias("null_count"),
                percent(F.col(f"_missing_{i}"), F.col("_rows")).alias("null_percent"),
            )
            for i, c in enumerate(df.columns)
        ]
        parts.append(_unfold(counted, rows).filter(F.col("null_count") > 0))
    return reduce(DataFrame.unionByName, parts)


def summary_figures(df: DataFrame, decimals: int = 4) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of every text and number column, in one scan.

    Decimal columns use exact sums, so the figures do not depend on the order of rows.
    """
    columns = [f for f in df.schema.fields if isinstance(f.dataType, (NumericType, StringType))]
    aggregates: list[Column] = []
    rows: list[Column] = []
    for i, field in enumerate(columns):
        value = F.col(field.name)
        aggregates += [
            F.count(value).alias(f"_n_{i}"),
            F.min(value).cast("string").alias(f"_lo_{i}"),
            F.max(value).cast("string").alias(f"_hi_{i}"),
        ]
        mean, deviation = F.lit(None).cast("double"), F.lit(None).cast("double")
        if isinstance(field.dataType, NumericType):
            if isinstance(field.dataType, DecimalType):
                number = value
            else:
                number = value.cast("double")
            aggregates += [F.sum(number).alias(f"_s_{i}"), F.stddev(number.cast("double")).alias(f"_d_{i}")]
            mean = F.round(F.try_divide(F.col(f"_s_{i}").cast("double"), F.col(f"_n_{i}").cast("double")), decimals)
            deviation = F.round(F.col(f"_d_{i}"), decimals)
        rows.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col(f"_n_{i}").alias("value_count"),
                mean.alias("mean"),
                deviation.alias("stddev"),
                F.col(f"_lo_{i}").alias("min_value"),
                F.col(f"_hi_{i}").alias("max_value"),
            )
        )
    return _unfold(df.agg(*aggregates), rows)


def segment_distribution(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customer_count"), F.count_distinct("region").alias("regions"))
        .orderBy(F.col("customer_count").desc(), F.col("segment").asc_nulls_last())
    )


def region_distribution(customers: DataFrame, top: int = 20) -> DataFrame:
    return (
        customers.groupBy("region", "country")
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .orderBy(F.col("customer_count").desc(), F.col("region").asc_nulls_last(), F.col("country").asc_nulls_last())
        .limit(top)
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("total_amount").alias("total_revenue"),
        mean_of("total_amount").alias("avg_order_value"),
    )


def daily_trend(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.to_date("order_date").alias("order_date"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
        .orderBy(F.col("order_date").asc_nulls_last())
    )


def preview(df: DataFrame, rows: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Some rows, or with ``by`` the first in that order: each task sends ``rows`` rows at most, nothing is sorted whole."""
    return (df.orderBy(*by) if by else df).limit(rows)
