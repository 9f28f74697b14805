"""Declarative quality rules.

All rules of a table that look at one row at a time share one scan (one global aggregate).  Rules about
distinct values get one aggregation of the key column each, because carrying the other counters through a
per-key aggregation would make every key row wider.  The result is a lazy frame with one row per rule;
nothing is collected until a gate asks for the verdict.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent
from tidemark.sources.parallel import run_parallel
from tidemark.sources.scratch import materialise

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    """Rows beyond the first of each value.  Nulls count as one value unless ``ignore_nulls``."""

    table: str
    column: str
    ignore_nulls: bool = False


@dataclass(frozen=True)
class InRange:
    """Inclusive bounds; nulls pass.  A rule without bounds checks nothing and is not reported."""

    table: str
    column: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Allowed:
    """Values outside the list; nulls pass."""

    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class References:
    """Distinct keys without a partner.  A null key has none, unless ``ignore_nulls``."""

    table: str
    column: str
    to_table: str
    to_column: str
    ignore_nulls: bool = False


@dataclass(frozen=True)
class Fresh:
    """Newest timestamp within ``max_hours`` of ``as_of``; an empty table fails."""

    table: str
    column: str
    as_of: str
    max_hours: int = 24


Rule = NotNull | Unique | InRange | Allowed | References | Fresh


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _outcome(name: str, table: str, details: Column, checked: Column, failed: Column, verdict: Column | None = None) -> Column:
    """One rule's figures; without a verdict the rule passes when nothing failed."""
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        details.alias("details"),
        checked.alias("rows_checked"),
        failed.alias("rows_failed"),
        (F.lit(None).cast("boolean") if verdict is None else verdict).alias("verdict"),
    )


def _judged(figures: DataFrame, layer: str) -> DataFrame:
    checked, failed = F.col("rows_checked"), F.col("rows_failed")
    rate = F.when(checked == 0, F.lit(100).cast("decimal(18,2)")).otherwise(percent(checked - failed, checked))
    return figures.select(
        "check_name",
        "table_name",
        F.lit(layer).alias("layer"),
        F.coalesce("verdict", failed == 0).alias("passed"),
        "details",
        "rows_checked",
        "rows_failed",
        rate.alias("pass_rate"),
    )


def _row_failure(rule: Rule) -> Column | None:
    """The rows a row-level rule counts as failed; None for every other kind of rule."""
    match rule:
        case NotNull(column=c):
            return F.col(c).isNull()
        case InRange(column=c, low=low, high=high):
            bounds = [F.col(c) < F.lit(low)] if low is not None else []
            bounds += [F.col(c) > F.lit(high)] if high is not None else []
            return reduce(or_, bounds) if bounds else F.lit(False)
        case Allowed(column=c, values=values):
            return ~F.col(c).isin(*values)
        case _:
            return None


def _row_level(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame | None:
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    structs: list[Column] = []
    for i, rule in enumerate(rules):
        checked, failed = F.col("_rows"), F.col(f"_v{i}")
        match rule:
            case InRange(low=None, high=None):
                continue
            case NotNull(column=c):
                name, details = f"not_null:{c}", _text(failed, f" null values found in '{c}'")
            case InRange(column=c, low=low, high=high):
                name = f"range:{c}[{low},{high}]"
                details = _text(failed, f" values out of range [{low}, {high}]")
            case Allowed(column=c):
                name, details = f"allowed_values:{c}", _text(failed, f" rows with invalid values in '{c}'")
            case Fresh(column=c, as_of=as_of, max_hours=hours):
                cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
                latest = F.col(f"_v{i}")
                aggregates.append(F.max(c).alias(f"_v{i}"))
                name = f"freshness:{c}(<{hours}h)"
                shown = F.date_format(latest, "yyyy-MM-dd HH:mm:ss")
                details = F.when(latest.isNull(), F.lit("No data found")).otherwise(_text("Latest record: ", shown))
                structs.append(
                    _outcome(
                        name, table, details, checked, F.lit(0).cast("bigint"),
                        verdict=F.coalesce(latest >= cutoff, F.lit(False)),
                    )
                )
                continue
            case _:
                continue
        aggregates.append(F.count_if(_row_failure(rule)).alias(f"_v{i}"))
        structs.append(_outcome(name, table, details, checked, failed))
    if not structs:
        return None
    return df.agg(*aggregates).select(F.inline(F.array(*structs)))


def _unique(df: DataFrame, rule: Unique) -> DataFrame:
    c = rule.column
    rows = df.filter(F.col(c).isNotNull()) if rule.ignore_nulls else df
    counted = (
        rows.groupBy(c)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"), F.count(F.lit(1)).alias("_values"))
    )
    failed = F.col("_rows") - F.col("_values")
    details = _text(failed, f" duplicate values found in '{c}'")
    return counted.select(F.inline(F.array(_outcome(f"unique:{c}", rule.table, details, F.col("_rows"), failed))))


def _references(df: DataFrame, reference: DataFrame, rule: References) -> DataFrame:
    c = rule.column
    keys = df.select(c).distinct()
    if rule.ignore_nulls:
        keys = keys.filter(F.col(c).isNotNull())
    known = reference.select(F.col(rule.to_column).alias(c)).distinct().withColumn("_known", F.lit(True))
    counted = keys.join(known, c, "left").agg(
        F.count(F.lit(1)).alias("_keys"), F.count_if(F.col("_known").isNull()).alias("_orphans")
    )
    name, orphans = f"ref_integrity:{c}→{rule.to_column}", F.col("_orphans")
    details = _text(orphans, " orphan records found")
    return counted.select(F.inline(F.array(_outcome(name, rule.table, details, F.col("_keys"), orphans))))


def evaluate(rules: Sequence[Rule], tables: Mapping[str, DataFrame], layer: str) -> DataFrame:
    """One result row per reported rule."""
    parts: list[DataFrame] = []
    for table in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == table]
        row_level = _row_level(tables[table], own, table)
        if row_level is not None:
            parts.append(row_level)
        for rule in own:
            if isinstance(rule, Unique):
                parts.append(_unique(tables[table], rule))
            elif isinstance(rule, References):
                parts.append(_references(tables[table], tables[rule.to_table], rule))
    if not parts:
        raise ValueError("no rule to evaluate")
    return _judged(reduce(DataFrame.union, parts), layer)


def staged_columns(rules: Sequence[Rule], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The checked tables cut down to the columns the rules read, each written once.

    Use it when the tables are views: several rules read the same table, and a stored table is scanned again
    instead of being derived again.  Tables read from files need no staging.
    """
    wanted: dict[str, set[str]] = {}
    for rule in rules:
        wanted.setdefault(rule.table, set()).add(rule.column)
        if isinstance(rule, References):
            wanted.setdefault(rule.to_table, set()).add(rule.to_column)
    spark = next(iter(tables.values())).sparkSession
    jobs = [
        partial(materialise, tables[t].select(*sorted(columns)), f"checked-{t}") for t, columns in wanted.items()
    ]
    return {t: stored for t, (stored, _) in zip(wanted, run_parallel(spark, jobs), strict=True)}


def summarise(results: DataFrame) -> DataFrame:
    """Totals and the failed checks in name order; the input has one row per rule."""
    failure = F.when(~F.col("passed"), F.concat_ws(" | ", "check_name", "table_name", "details"))
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(failure)), "; ").alias("failures"),
    ).select(
        "total_checks",
        "passed",
        "failed",
        F.coalesce(percent(F.col("passed"), F.col("total_checks")), F.lit(0).cast("decimal(18,2)")).alias("pass_rate"),
        "failures",
    )


class QualityGateError(RuntimeError):
    """Raised when checks fail and the gate is set to stop the run."""


def gate(results: DataFrame, mode: str = "warn") -> bool:
    """Log the report; stop the run in ``fail`` mode.  Collects one row per rule."""
    if mode not in ("warn", "fail"):
        raise ValueError(f"unknown gate mode: {mode}")
    rows = results.select("check_name", "table_name", "passed", "details").collect()
    failures = [r for r in rows if not r["passed"]]
    for line in report_lines(rows):
        log.info("%s", line)
    if failures and mode == "fail":
        listed = "; ".join(f"{r['table_name']}.{r['check_name']}: {r['details']}" for r in failures)
        raise QualityGateError(f"{len(failures)} quality checks failed: {listed}")
    return not failures


def report_lines(rows: Sequence[Row]) -> list[str]:
    """All checks, passed and failed, by table; a line for each and the total at the end."""
    ordered = sorted(rows, key=lambda r: (r["table_name"], r["check_name"]))
    lines = [f"{'pass' if r['passed'] else 'FAIL'}  {r['table_name']}.{r['check_name']}: {r['details']}" for r in ordered]
    passed = sum(bool(r["passed"]) for r in rows)
    return [*lines, f"{passed} of {len(rows)} checks passed"]


def report(results: DataFrame) -> DataFrame:
    """The lines of ``report_lines`` as rows (``line``, ``text``), for results that are kept as a table; one row per rule."""
    mark = F.when(F.col("passed"), "pass").otherwise("FAIL")
    text = F.concat(mark, F.lit("  "), "table_name", F.lit("."), "check_name", F.lit(": "), "details")
    total = F.concat(F.count_if("passed").cast("string"), F.lit(" of "), F.count(F.lit(1)).cast("string"), F.lit(" checks passed"))
    line = F.struct("table_name", "check_name", text.alias("text"))
    gathered = results.agg(F.sort_array(F.collect_list(line)).alias("lines"), total.alias("total"))
    texts = F.concat(F.col("lines.text"), F.array("total"))
    return gathered.select(F.posexplode(texts).alias("line", "text")).select((F.col("line") + 1).cast("long").alias("line"), "text")


# The statuses a cleaned order may have, and the tiers of a customer.
ORDER_STATUSES = ("completed", "delivered", "shipped", "pending", "processing", "cancelled", "unknown")
CUSTOMER_TIERS = ("champion", "loyal", "new_active", "at_risk", "regular")

SILVER_RULES: tuple[Rule, ...] = (
    NotNull("orders", "order_id"),
    Unique("orders", "order_id"),
    InRange("orders", "total_amount", low=0),
    Allowed("orders", "status", ORDER_STATUSES),
    References("orders", "customer_id", "customers", "customer_id"),
    NotNull("customers", "customer_id"),
    Unique("customers", "customer_id"),
    NotNull("products", "product_id"),
    Unique("products", "product_id"),
    InRange("products", "price", low=0),
    InRange("products", "profit_margin", low=-100, high=100),
    NotNull("order_items", "item_id"),
    InRange("order_items", "quantity", low=1),
    References("order_items", "order_id", "orders", "order_id"),
    References("order_items", "product_id", "products", "product_id"),
)

# The shorter rule list of the interactive runs; it also wants every customer to have a region.
SHORT_SILVER_RULES: tuple[Rule, ...] = (
    NotNull("orders", "order_id"),
    Unique("orders", "order_id"),
    InRange("orders", "total_amount", low=0),
    Allowed("orders", "status", ORDER_STATUSES),
    NotNull("customers", "customer_id"),
    Unique("customers", "customer_id"),
    NotNull("customers", "region"),
    References("orders", "customer_id", "customers", "customer_id"),
    References("order_items", "order_id", "orders", "order_id"),
)

# Tests declared next to the SQL models; these leave nulls to the not-null rules.
SOURCE_MODEL_RULES: tuple[Rule, ...] = (
    NotNull("customers", "customer_id"),
    Unique("customers", "customer_id", ignore_nulls=True),
    NotNull("products", "product_id"),
    Unique("products", "product_id", ignore_nulls=True),
    NotNull("orders", "order_id"),
    Unique("orders", "order_id", ignore_nulls=True),
    NotNull("order_items", "item_id"),
)
STAGING_MODEL_RULES: tuple[Rule, ...] = (
    NotNull("stg_customers", "customer_id"),
    Unique("stg_customers", "customer_id", ignore_nulls=True),
    Allowed("stg_customers", "segment", ("premium", "standard", "unknown")),
    NotNull("stg_orders", "order_id"),
    Unique("stg_orders", "order_id", ignore_nulls=True),
    NotNull("stg_orders", "customer_id"),
    References("stg_orders", "customer_id", "stg_customers", "customer_id", ignore_nulls=True),
    NotNull("stg_orders", "total_amount"),
    NotNull("stg_products", "product_id"),
    Unique("stg_products", "product_id", ignore_nulls=True),
    NotNull("stg_products", "price"),
    NotNull("stg_order_items", "item_id"),
    References("stg_order_items", "order_id", "stg_orders", "order_id", ignore_nulls=True),
)
MART_MODEL_RULES: tuple[Rule, ...] = (
    NotNull("mart_daily_sales", "sale_date"),
    Unique("mart_daily_sales", "sale_date", ignore_nulls=True),
    NotNull("mart_daily_sales", "gross_revenue"),
    NotNull("mart_customer_360", "customer_id"),
    Unique("mart_customer_360", "customer_id", ignore_nulls=True),
    Allowed("mart_customer_360", "customer_tier", CUSTOMER_TIERS),
    NotNull("mart_product_performance", "product_id"),
    Unique("mart_product_performance", "product_id", ignore_nulls=True),
    NotNull("mart_product_performance", "total_revenue"),
)
