import threading

import pytest

from tidemark.catalog import checks
from tidemark.operators import quality
from tidemark.operators.quality import Allowed, Fresh, InRange, NotNull, References, Unique, evaluate
from tidemark.plans import staging


@pytest.fixture
def t(spark):
    rows = [("a", 1, "x"), ("a", 5, "y"), (None, None, None), (None, 9, "z"), ("b", 0, "x")]
    df = spark.createDataFrame(rows, "k STRING, n INT, c STRING").selectExpr("*", "timestamp'2024-01-01 12:00:00' AS at")
    ref = spark.createDataFrame([("a",), (None,)], "id STRING")
    return {"t": df, "ref": ref, "empty": df.limit(0)}


def outcome(tables, rule):
    rows = evaluate([rule], tables, "test").collect()
    assert len(rows) == 1
    r = rows[0]
    return r["passed"], r["rows_checked"], r["rows_failed"], float(r["pass_rate"])


@pytest.mark.parametrize(
    ("rule", "expected"),
    [
        (NotNull("t", "k"), (False, 5, 2, 60.0)),
        (NotNull("t", "at"), (True, 5, 0, 100.0)),
        (NotNull("empty", "k"), (True, 0, 0, 100.0)),
        (Unique("t", "k"), (False, 5, 2, 60.0)),  # nulls are one value
        (Unique("t", "k", ignore_nulls=True), (False, 3, 1, 66.67)),
        (Unique("t", "n"), (True, 5, 0, 100.0)),
        (Unique("empty", "k"), (True, 0, 0, 100.0)),
        (InRange("t", "n", low=1), (False, 5, 1, 80.0)),
        (InRange("t", "n", high=5), (False, 5, 1, 80.0)),
        (InRange("t", "n", low=0, high=9), (True, 5, 0, 100.0)),  # bounds are inclusive, nulls pass
        (InRange("t", "n", low=1, high=5), (False, 5, 2, 60.0)),
        (Allowed("t", "c", ("x", "y")), (False, 5, 1, 80.0)),  # nulls pass
        (References("t", "k", "ref", "id"), (False, 3, 2, 33.33)),  # a null key is an orphan
        (References("t", "k", "ref", "id", ignore_nulls=True), (False, 2, 1, 50.0)),
        (Fresh("t", "at", "2024-01-02 12:00:00", 24), (True, 5, 0, 100.0)),
        (Fresh("t", "at", "2024-01-02 12:00:01", 24), (False, 5, 0, 100.0)),
        (Fresh("empty", "at", "2024-01-02", 24), (False, 0, 0, 100.0)),
    ],
)
def test_rules(t, rule, expected):
    assert outcome(t, rule) == expected


def test_range_without_bounds_is_not_reported(t):
    assert evaluate([InRange("t", "n"), NotNull("t", "k")], t, "test").count() == 1
    with pytest.raises(ValueError, match="no rule"):
        evaluate([InRange("t", "n")], t, "test")


def test_names_and_details(t):
    rules = [NotNull("t", "k"), InRange("t", "n", low=1), References("t", "k", "ref", "id"), Unique("t", "k"), Fresh("t", "at", "2024-01-02")]
    got = {r["check_name"]: r["details"] for r in evaluate(rules, t, "test").collect()}
    assert got["not_null:k"] == "2 null values found in 'k'"
    assert got["range:n[1,None]"] == "1 values out of range [1, None]"
    assert got["ref_integrity:k→id"] == "2 orphan records found"
    assert got["unique:k"] == "2 duplicate values found in 'k'"
    assert got["freshness:at(<24h)"] == "Latest record: 2024-01-01 12:00:00"


def test_row_rules_of_a_table_share_one_scan(spark, t, tmp_path):
    t["t"].write.parquet(str(tmp_path / "t"))
    stored = {"t": spark.read.parquet(str(tmp_path / "t"))}
    rules = [NotNull("t", "k"), NotNull("t", "n"), InRange("t", "n", low=0), Allowed("t", "c", ("x",)), Fresh("t", "at", "2024-01-02")]
    plan = evaluate(rules, stored, "test")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_summary(t):
    s = quality.summarise(evaluate([NotNull("t", "k"), Unique("t", "n"), InRange("t", "n", low=1)], t, "test")).head()
    assert (s["total_checks"], s["passed"], s["failed"], float(s["pass_rate"])) == (3, 1, 2, 33.33)
    assert s["failures"] == "not_null:k | t | 2 null values found in 'k'; range:n[1,None] | t | 1 values out of range [1, None]"


def test_gate(t):
    bad = evaluate([NotNull("t", "k")], t, "test")
    good = evaluate([Unique("t", "n")], t, "test")
    assert quality.gate(bad, "warn") is False and quality.gate(good, "fail") is True
    with pytest.raises(quality.QualityGateError, match="t.not_null:k: 2 null values"):
        quality.gate(bad, "fail")
    with pytest.raises(ValueError, match="gate mode"):
        quality.gate(good, "stop")


def test_rule_sets_have_the_published_size():
    assert len(quality.SILVER_RULES) == 15 and len(quality.SHORT_SILVER_RULES) == 9


def test_staged_columns_keep_only_what_rules_read(t):
    staged = quality.staged_columns([NotNull("t", "k"), References("t", "k", "ref", "id")], t)
    assert staged["t"].columns == ["k"] and staged["ref"].columns == ["id"]


def test_report_rows_are_the_logged_lines(spark):
    results = spark.createDataFrame(
        [("unique:k", "t", True, "ok"), ("not_null:k", "t", False, "2 null values"), ("range:v", "a", True, "fine")],
        "check_name STRING, table_name STRING, passed BOOLEAN, details STRING",
    )
    rows = quality.report(results).orderBy("line").collect()
    assert [r["text"] for r in rows] == quality.report_lines(results.collect()) and [r["line"] for r in rows] == [1, 2, 3, 4]
    assert [r["text"] for r in quality.report(results.limit(0)).collect()] == ["0 of 0 checks passed"]


def test_marts_of_the_model_tests_are_built_side_by_side(spark, monkeypatch, raw_customers, raw_products, raw_orders, raw_items):
    """Every mart waits until all three have begun; they read staged tables that are stored."""
    together, plans = threading.Barrier(3), []

    class Given:
        raw = {"customers": raw_customers, "products": raw_products, "orders": raw_orders, "order_items": raw_items}.get

        def staging(self, name):
            return getattr(staging, f"stg_{name}")(Given.raw(name))

    def begun(build):
        def wait(*frames):
            plans.extend(f._jdf.queryExecution().analyzed().toString() for f in frames if not isinstance(f, str))
            together.wait(60)
            return build(*frames)

        return wait

    for name in ("mart_daily_sales", "mart_customer_360", "mart_product_performance"):
        monkeypatch.setattr(checks.marts, name, begun(getattr(checks.marts, name)))
    given = Given()
    given.spark = spark
    found = checks.dq_model_tests(given).collect()
    assert len(found) == 29 and {r["layer"] for r in found} == {"source", "staging", "mart"}
    assert len(plans) == 7 and all(p.strip().startswith("Relation") for p in plans)
