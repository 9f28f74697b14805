"""Quality queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.catalog.sql_views import AS_OF, pct
from tidemark.catalog.tables import Tables
from tidemark.operators import quality
from tidemark.operators.quality import Allowed, Fresh, InRange, NotNull, References, Rule, Unique
from tidemark.plans import marts
from tidemark.sources.parallel import run_parallel
from tidemark.sources.scratch import materialise


def _row(name: str, table: str, layer: str, details: str, checked: str, failed: str, source: str, passed: str = "") -> str:
    return (
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{layer}' AS layer, {passed or f'{failed} = 0'} AS passed, "
        f"{details} AS details, CAST({checked} AS BIGINT) AS rows_checked, CAST({failed} AS BIGINT) AS rows_failed, "
        f"CASE WHEN {checked} = 0 THEN 100 ELSE {pct(f'({checked} - {failed})', checked)} END AS pass_rate FROM ({source})"
    )


def rule_sql(rule: Rule, layer: str, prefix: str) -> str:
    """The rule as one SQL row; ``prefix`` turns table names into view names."""
    view, c = prefix + rule.table, rule.column

    def counted(failed: str) -> str:
        return f"SELECT count(*) AS n, count(*) FILTER (WHERE {failed}) AS bad FROM {view}"

    match rule:
        case NotNull():
            return _row(f"not_null:{c}", rule.table, layer, f"bad || ' null values found in ''{c}'''", "n", "bad", counted(f"{c} IS NULL"))
        case InRange(low=low, high=high):
            parts = ([f"{c} < {low}"] if low is not None else []) + ([f"{c} > {high}"] if high is not None else [])
            details = f"bad || ' values out of range [{low}, {high}]'"
            return _row(f"range:{c}[{low},{high}]", rule.table, layer, details, "n", "bad", counted(" OR ".join(parts)))
        case Allowed(values=values):
            listed = ", ".join(f"'{v}'" for v in values)
            details = f"bad || ' rows with invalid values in ''{c}'''"
            return _row(f"allowed_values:{c}", rule.table, layer, details, "n", "bad", counted(f"{c} NOT IN ({listed})"))
        case Unique(ignore_nulls=ignore):
            where = f"WHERE {c} IS NOT NULL" if ignore else ""
            source = (
                f"SELECT coalesce(sum(k), 0) AS n, coalesce(sum(k), 0) - count(*) AS bad FROM "
                f"(SELECT {c}, count(*) AS k FROM {view} {where} GROUP BY {c})"
            )
            details = f"CAST(bad AS BIGINT) || ' duplicate values found in ''{c}'''"
            return _row(f"unique:{c}", rule.table, layer, details, "n", "bad", source)
        case References(to_table=to, to_column=key, ignore_nulls=ignore):
            where = f"WHERE {c} IS NOT NULL" if ignore else ""
            source = (
                f"SELECT count(*) AS n, count(*) FILTER (WHERE orphan) AS bad FROM (SELECT d.{c}, NOT EXISTS "
                f"(SELECT 1 FROM {prefix}{to} r WHERE r.{key} = d.{c}) AS orphan FROM (SELECT DISTINCT {c} FROM {view} {where}) d)"
            )
            return _row(f"ref_integrity:{c}→{key}", rule.table, layer, "bad || ' orphan records found'", "n", "bad", source)
        case Fresh(as_of=as_of, max_hours=hours):
            source = f"SELECT count(*) AS n, 0 AS bad, max({c}) AS latest FROM {view}"
            return _row(
                f"freshness:{c}(<{hours}h)", rule.table, layer,
                "coalesce('Latest record: ' || strftime(latest, '%Y-%m-%d %H:%M:%S'), 'No data found')", "n", "bad", source,
                passed=f"coalesce(latest >= TIMESTAMP '{as_of} 00:00:00' - INTERVAL {hours} HOUR, false)",
            )
    raise TypeError(f"unknown rule: {rule}")


def rules_sql(rules: Sequence[Rule], layer: str, prefix: str = "") -> str:
    return "\nUNION ALL ".join(rule_sql(r, layer, prefix) for r in rules)


def _raw_check(name: str, rules: Sequence[Rule]) -> None:
    """A query that applies rules to the raw views."""
    tables = {r.table for r in rules} | {r.to_table for r in rules if isinstance(r, References)}

    def body(t: Tables) -> DataFrame:
        return quality.evaluate(rules, {n: t.raw(n) for n in tables}, "bronze")

    query(name, rules_sql(rules, "bronze", "raw_"))(body)


_raw_check("dq_not_null", [NotNull("customers", "customer_id"), NotNull("customers", "region"), NotNull("orders", "shipping_cost")])
_raw_check("dq_unique", [Unique("customers", "customer_id"), Unique("order_items", "item_id"), Unique("clickstream", "customer_id")])
_raw_check(
    "dq_range",
    [InRange("orders", "total_amount", low=0), InRange("reviews", "rating", low=1, high=5), InRange("products", "price", high=100)],
)
_raw_check(
    "dq_referential",
    [References("order_items", "order_id", "orders", "order_id"), References("clickstream", "customer_id", "orders", "customer_id"),
     References("reviews", "product_id", "products", "product_id")],
)
_raw_check("dq_freshness", [Fresh("orders", "order_date", AS_OF, 24), Fresh("customers", "created_at", AS_OF, 24)])
_raw_check(
    "dq_allowed_values",
    [Allowed("orders", "status", ("delivered", "pending", "processing", "canceled")), Allowed("customers", "segment", ("budget", "Gold"))],
)


def _silver_results(t: Tables, rules: Sequence[Rule]) -> DataFrame:
    return quality.evaluate(rules, quality.staged_columns(rules, t.silver_set), "silver")


query("dq_silver_suite", rules_sql(quality.SILVER_RULES, "silver", "silver_"))(
    lambda t: _silver_results(t, quality.SILVER_RULES)
)
query("dq_silver_suite_short", rules_sql(quality.SHORT_SILVER_RULES, "silver", "silver_"))(
    lambda t: _silver_results(t, quality.SHORT_SILVER_RULES)
)

_FAILING_RULES = (
    *quality.SILVER_RULES,
    InRange("products", "price", low=0, high=500),
    Allowed("customers", "segment", ("premium", "standard", "unknown")),
)


_FAILING_SQL = rules_sql(_FAILING_RULES, "silver", "silver_")


@query(
    "dq_report",
    f"""SELECT row_number() OVER (ORDER BY table_name, check_name, details) AS line,
      CASE WHEN passed THEN 'pass' ELSE 'FAIL' END || '  ' || table_name || '.' || check_name || ': ' || details AS text FROM ({_FAILING_SQL})
    UNION ALL SELECT count(*) + 1, count(*) FILTER (passed) || ' of ' || count(*) || ' checks passed' FROM ({_FAILING_SQL})""",
)
def dq_report(t: Tables) -> DataFrame:
    return quality.report(_silver_results(t, _FAILING_RULES))


@query(
    "dq_summary",
    f"""SELECT *, {pct("passed", "total_checks")} AS pass_rate FROM (SELECT count(*) AS total_checks,
      count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
      coalesce(string_agg(check_name || ' | ' || table_name || ' | ' || details, '; '
        ORDER BY check_name || ' | ' || table_name || ' | ' || details) FILTER (WHERE NOT passed), '') AS failures
    FROM ({rules_sql(_FAILING_RULES, "silver", "silver_")}))""",
)
def dq_summary(t: Tables) -> DataFrame:
    return quality.summarise(_silver_results(t, _FAILING_RULES))


@query(
    "dq_gate",
    f"""SELECT check_name, table_name, passed, 'stopped' AS verdict FROM ({rules_sql(_FAILING_RULES, "silver", "silver_")})
    WHERE NOT passed""",
)
def dq_gate(t: Tables) -> DataFrame:
    """Failed checks with the verdict of a gate that stops the run."""
    results = _silver_results(t, _FAILING_RULES)
    try:
        quality.gate(results, "fail")
        verdict = "passed"
    except quality.QualityGateError:
        verdict = "stopped"
    return results.filter(~F.col("passed")).select("check_name", "table_name", "passed", F.lit(verdict).alias("verdict"))


_MODEL_SQL = "\nUNION ALL ".join(
    [
        rules_sql(quality.SOURCE_MODEL_RULES, "source", "raw_"),
        rules_sql(quality.STAGING_MODEL_RULES, "staging"),
        rules_sql(quality.MART_MODEL_RULES, "mart"),
    ]
)


@query("dq_model_tests", _MODEL_SQL)
def dq_model_tests(t: Tables) -> DataFrame:
    """The staged tables are written once, for their own rules and for the marts, which are built side by side."""
    names = ("customers", "products", "orders", "order_items")
    sources = {n: t.raw(n) for n in names}
    stage = [partial(materialise, t.staging(n), f"stg-{n}") for n in names]
    checked, *written = run_parallel(t.spark, [partial(quality.staged_columns, quality.SOURCE_MODEL_RULES, sources), *stage])
    customers, products, orders, items = staged = [df for df, _ in written]
    builders = {
        "mart_daily_sales": partial(marts.mart_daily_sales, orders),
        "mart_customer_360": partial(marts.mart_customer_360, customers, orders, items, AS_OF),
        "mart_product_performance": partial(marts.mart_product_performance, products, orders, items),
    }
    built = dict(zip(builders, run_parallel(t.spark, list(builders.values())), strict=True))
    results = [
        quality.evaluate(quality.SOURCE_MODEL_RULES, checked, "source"),
        quality.evaluate(quality.STAGING_MODEL_RULES, {f"stg_{n}": df for n, df in zip(names, staged, strict=True)}, "staging"),
        quality.evaluate(quality.MART_MODEL_RULES, quality.staged_columns(quality.MART_MODEL_RULES, built), "mart"),
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])
