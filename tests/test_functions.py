from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text


def one(df, column):
    return df.select(column.alias("x")).head()["x"]


@pytest.fixture
def row(spark):
    return spark.createDataFrame(
        [("  MiXed ", None, 5, 0, "12.345", "abc", datetime(2024, 2, 29, 23, 0))],
        "s STRING, n STRING, five INT, zero INT, num STRING, word STRING, ts TIMESTAMP",
    )


def test_tidy_keeps_null(row):
    assert one(row, text.tidy("s")) == "mixed"
    assert one(row, text.tidy("n")) is None


def test_standardize_skips_absent_columns(row):
    assert text.standardize_strings(row, ["s", "missing"]).head()["s"] == "mixed"


@pytest.mark.parametrize(
    ("address", "valid"),
    [("a@b.co", True), ("a.b+c%d@x-y.org", True), ("a@b", False), ("@b.co", False), ("a b@c.de", False), ("", False)],
)
def test_email(spark, address, valid):
    assert one(spark.createDataFrame([(address,)], "e STRING"), text.is_email("e")) is valid


def test_email_null_stays_null(row):
    assert one(row, text.is_email("n")) is None


def test_relabel_first_match_and_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "v STRING")
    labels = {"first": ("a",), "second": ("a", "b")}
    got = [r[0] for r in df.select(text.relabel(F.col("v"), labels, F.lit("other"))).collect()]
    assert got == ["first", "second", "other", "other"]


def test_money_rounds_and_rejects(row):
    assert one(row, numbers.money("num")) == Decimal("12.35")
    assert one(row, numbers.money("word")) is None


def test_percent_guards_zero(row):
    assert one(row, numbers.percent(F.col("five"), F.col("zero"))) is None
    assert one(row, numbers.percent(F.lit(1), F.lit(3))) == Decimal("33.33")


def test_percent_of_extreme_amounts_does_not_overflow(row):
    assert one(row, numbers.percent(F.lit(-9_999_999_999.0), F.lit(0.01))) == Decimal("-99999999990000.00")


def test_average_of_no_values_is_null(spark):
    df = spark.createDataFrame([(None,)], "v DECIMAL(12,2)")
    assert df.agg(numbers.mean_of("v").alias("x")).head()["x"] is None


@pytest.mark.parametrize(("price", "tier"), [(24.99, "a"), (25.0, "b"), (99.99, "b"), (100.0, "c"), (None, "c")])
def test_below_is_exclusive(spark, price, tier):
    df = spark.createDataFrame([(price,)], "p DOUBLE")
    assert one(df, numbers.below(F.col("p"), ((25, "a"), (100, "b")), "c")) == tier


@pytest.mark.parametrize(("days", "score"), [(30, 5), (31, 4), (366, 1), (None, 1)])
def test_at_most_is_inclusive(spark, days, score):
    df = spark.createDataFrame([(days,)], "d INT")
    assert one(df, numbers.at_most(F.col("d"), ((30, 5), (90, 4), (180, 3), (365, 2)), 1)) == score


def test_date_helpers(row):
    assert one(row, dates.date_key("ts")) == 20240229
    assert one(row, dates.weekend("ts")) is False
    assert one(row, dates.weekend(F.lit(date(2024, 3, 3)))) is True
    assert one(row, dates.weekend(F.lit(None).cast("date"))) is False


def test_calendar_days_and_full_days_differ(row):
    """One hour before midnight: one calendar day ago, but no full day."""
    assert one(row, dates.days_since(F.col("ts"), "2024-03-01")) == 1
    assert one(row, dates.full_days_since(F.col("ts"), "2024-03-01")) == 0
