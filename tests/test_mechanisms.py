"""Event-time streams, sessions, as-of joins and grouping sets on rows that are hard for them."""

import math
import random
from bisect import bisect_right
from collections import defaultdict
from contextlib import contextmanager
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.catalog.tables import land_csv
from tidemark.functions.documents import typed_fields
from tidemark.operators import grouping
from tidemark.operators.asof import asof_join
from tidemark.operators.changes import apply_to_history, table_changes
from tidemark.operators.frames import moving_sum
from tidemark.operators.intervals import BUNDLE, _bundled, interval_join
from tidemark.operators.quantiles import exact_quantiles, ntile
from tidemark.operators.sessions import sessions
from tidemark.sources.bronze import setting
from tidemark.streaming import event_time

DAY = datetime(2024, 3, 1)
CLICK = "event_id STRING, session_id STRING, customer_id STRING, event_type STRING, page_url STRING, referrer STRING, device_type STRING, browser STRING, timestamp TIMESTAMP"


def clicks(spark, rows):
    """(event id, session, type, hours after midnight)"""
    full = [(e, s, None, kind, None, None, " Mobile", None, DAY + timedelta(hours=h) if h is not None else None) for e, s, kind, h in rows]
    return spark.createDataFrame(full, CLICK)


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / n) for n in ("landing", "out", "state")]


def arrive(spark, rows, folders, build):
    landing, target, state = folders
    if rows:
        land_csv(clicks(spark, rows), landing, mode="append")
    return event_time.drain(build(event_time.click_stream(spark, landing), "2 hours"), target, state)


def test_hours_are_written_once_complete_and_late_events_are_dropped(spark, folders):
    arrive(spark, [("1", "a", "page_view", 0.5), ("2", "a", "purchase", 0.6), ("3", "b", "page_view", 5.0)], folders, event_time.hourly_windows)
    hours = spark.read.parquet(folders[1])
    assert [tuple(r)[2:] for r in hours.collect()] == [("mobile", 2, 1, 1, 1, 1)]
    # The watermark is 03:00: an event of 03:10 is late but in time, one of 02:30 is too late.
    arrive(spark, [("4", "a", "checkout", 3.2), ("5", "a", "page_view", 2.5), ("6", None, "page_view", 9.0), ("7", "x", None, 8.0), ("8", "x", "page_view", None)], folders, event_time.hourly_windows)
    found = {(r["window_start"].hour, r["total_events"], r["unique_sessions"], r["conversions"]) for r in spark.read.parquet(folders[1]).collect()}
    assert found == {(0, 2, 1, 1), (3, 1, 1, 1), (5, 1, 1, 0)}
    assert arrive(spark, [], folders, event_time.hourly_windows).read == 0
    assert spark.read.parquet(folders[1]).count() == 3


def test_state_is_bounded_by_the_delay(spark, folders):
    """A thousand hours pass through; what is held are the hours behind the watermark."""
    for k in range(2):
        done = arrive(spark, [(f"{k}-{h}", f"s{h}", "page_view", 500 * k + h + 0.5) for h in range(500)], folders, event_time.hourly_windows)
    assert done.held <= 8
    assert spark.read.parquet(folders[1]).agg(F.sum("total_events")).head()[0] >= 995


def test_repeated_events_appear_once_over_restarts(spark, folders):
    first = [(str(i), "a", "page_view", i / 10) for i in range(20)]
    arrive(spark, first + first[:5], folders, event_time.distinct_events)
    arrive(spark, first[10:] + [("n", "b", "page_view", 6.0)], folders, event_time.distinct_events)
    done = arrive(spark, [*first, ("n", "b", "page_view", 6.0), ("late", "b", "page_view", 3.9), ("in time", "b", "page_view", 4.1)], folders, event_time.distinct_events)
    ids = [r["event_id"] for r in spark.read.parquet(folders[1]).collect()]
    assert sorted(ids) == sorted([*(str(i) for i in range(20)), "n", "in time"])
    assert done.late > 0 and done.held <= 3


# Sessions


@contextmanager
def in_ranges(spark, ranges):
    """So many ranges, however few the rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def brute_sessions(rows, gap):
    by_visitor = defaultdict(list)
    for v, at in rows:
        if v is not None and at is not None:
            by_visitor[v].append(at)
    found = []
    for v, times in by_visitor.items():
        times.sort()
        start = last = times[0]
        n = 0
        for at in times:
            if (at - last).total_seconds() > gap:
                found.append((v, start, last, n))
                start, n = at, 0
            last, n = at, n + 1
        found.append((v, start, last, n))
    return sorted(found)


def visitor_rows(seed, n=1500):
    """A third of the events and most of the ties belong to one visitor; one is there without a pause."""
    rng = random.Random(seed)
    rows = [("hot", DAY + timedelta(seconds=rng.randrange(60_000))) for _ in range(n // 3)]
    rows += [("steady", DAY + timedelta(seconds=20 * i)) for i in range(n // 4)]
    rows += [("tied", DAY)] * 200
    rows += [(f"v{rng.randrange(80)}", DAY + timedelta(seconds=rng.randrange(100_000))) for _ in range(n // 3)]
    rows += [(None, DAY), ("no time", None), ("edge", DAY), ("edge", DAY + timedelta(seconds=60)), ("edge", DAY + timedelta(seconds=120, microseconds=1))]
    return rows


@pytest.mark.parametrize(("gap", "ranges"), [(60, 4), (60, 40), (1, 16), (100_000, 16)])
def test_sessions_match_plain_python(spark, gap, ranges):
    rows = visitor_rows(gap)
    df = spark.createDataFrame([(v, at, i, 1) for i, (v, at) in enumerate(rows)], "v string, at timestamp, n int, _slot int")
    with in_ranges(spark, ranges):
        found = sessions(df, "v", "at", gap, {"ones": F.lit(1)}, ["n"]).collect()
    assert sorted(tuple(r)[:4] for r in found) == brute_sessions(rows, gap)
    assert all(r["ones"] == r["events"] for r in found)


def test_a_hot_visitor_lies_in_several_ranges(spark):
    from tidemark.operators.ranking import number_in_ranges

    df = spark.createDataFrame([(v, at, i) for i, (v, at) in enumerate(visitor_rows(1)) if v and at], "v string, at timestamp, n int")
    with in_ranges(spark, 16):
        placed = number_in_ranges(df, [F.col("v"), F.col("at"), F.col("n")])
        assert placed.where("v = 'hot'").select("_slot").distinct().count() > 3


def test_sessions_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "v string, at timestamp")
    assert sessions(empty, "v", "at", 60).count() == 0


# As-of join


def test_asof_matches_plain_python(spark):
    rng = random.Random(4)
    keys = ["hot"] * 6 + [f"k{i}" for i in range(12)] + ["unknown", None]
    rows = [(i, rng.choice(keys), DAY + timedelta(hours=rng.randrange(400)) if i % 50 else None, f"p{i}") for i in range(2000)]
    rows += [rows[0]] * 3 + [(9000 + i, "hot", DAY + timedelta(hours=200), "same time") for i in range(500)]
    versions = [(k, DAY + timedelta(hours=rng.randrange(20, 380)), float(i), f"name{i}") for i, k in enumerate(["hot"] * 40 + [f"k{i % 12}" for i in range(30)])]
    versions += [(None, DAY, 1.0, "no key"), ("hot", None, 2.0, "no time"), ("hot", DAY + timedelta(hours=200), 3.5, "b"), ("hot", DAY + timedelta(hours=200), 3.5, "a"), ("other", DAY, 0.0, "x")]
    left = spark.createDataFrame(rows, "id int, key string, at timestamp, payload string").repartition(5)
    right = spark.createDataFrame(versions, "key string, since timestamp, price double, name string").repartition(3)
    with in_ranges(spark, 12):
        found = asof_join(left, right, "key", "at", "since", ["price", "name", "since"]).collect()

    newest = {}
    for k, since, price, name in versions:
        if k is not None and since is not None:
            newest[k, since] = max(newest.get((k, since), (price, name)), (price, name))
    times = defaultdict(list)
    for k, since in sorted(newest):
        times[k].append(since)
    expected = []
    for i, k, at, payload in rows:
        place = bisect_right(times[k], at) if k is not None and at is not None else 0
        expected.append((i, k, at, payload, *(newest[k, times[k][place - 1]] + (times[k][place - 1],) if place else (None, None, None))))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def test_asof_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", DAY)], "id int, key string, at timestamp")
    right = spark.createDataFrame([("a", DAY, 1)], "key string, since timestamp, price int")
    assert [tuple(r) for r in asof_join(left, right.limit(0), "key", "at", "since", ["price"]).collect()] == [(1, "a", DAY, None)]
    assert asof_join(left.limit(0), right, "key", "at", "since", ["price"]).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_asof_pairs_nothing(spark):
    left = spark.createDataFrame([(1, "a", DAY)], "id int, key string, at timestamp")
    right = spark.createDataFrame([("a", DAY, 1)], "key string, since timestamp, price int")
    text = plan_of(asof_join(left, right, "key", "at", "since", ["price"]))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SinglePartition" not in text


# Grouping sets

SALES = [("a", "x", 1, 10), ("a", "x", 1, 5), ("a", "y", 2, 7), ("b", "x", 1, 1), ("b", None, None, 2), (None, "x", 3, 4), (None, None, 3, 4)] * 3


def brute_level(keep):
    groups = defaultdict(list)
    for *dims, who, amount in SALES:
        groups[tuple(d if k else None for d, k in zip(dims, keep, strict=True))].append((who, amount))
    number = sum(1 << (1 - i) for i, k in enumerate(keep) if not k)
    return {(*g, number, sum(a for _, a in v), len(v), len({w for w, _ in v if w is not None})) for g, v in groups.items()}


def test_rollup_and_cube(spark):
    df = spark.createDataFrame(SALES, "a string, b string, who int, amount int")
    levels = [(True, True), (True, False), (False, False)]
    found = grouping.rollup(df, ["a", "b"], {"total": F.col("amount")}, ("people", "who"))
    assert found.columns == ["a", "b", "grouping_id", "total", "row_count", "people"]
    assert {tuple(r) for r in found.collect()} == set().union(*map(brute_level, levels))
    whole = grouping.cube(df, ["a", "b"], {"total": F.col("amount")}, ("people", "who"))
    assert {tuple(r) for r in whole.collect()} == set().union(*map(brute_level, [*levels, (False, True)]))
    assert "Expand" not in plan_of(whole) and "Expand" not in plan_of(found)
    assert grouping.cube(df.limit(0), ["a", "b"], {"total": F.col("amount")}, ("people", "who")).count() == 0


def test_pivot(spark):
    df = spark.createDataFrame(SALES, "a string, b string, who int, amount int")
    found = {r["a"]: (r["x"], r["none"]) for r in grouping.pivot(df, ["a"], "b", {"x": "x", "none": None}, F.col("amount")).collect()}
    assert found == {"a": (45, 0), "b": (3, 6), None: (12, 12)}


# Intervals


def test_intervals_meet_once(spark):
    rng = random.Random(9)

    def side(n, long):
        starts = [rng.randrange(-500, 3000) for _ in range(n)]
        return [(i, s, s + (rng.randrange(long) if i % 7 else rng.randrange(2000))) for i, s in enumerate(starts)]

    a = [*side(150, 20), (900, 5, 4), (901, None, 3), (902, 3, None), (903, 64, 64), (903, 64, 64), (904, -8, -1), (905, 0, 1023)]
    b = [*side(120, 60), (900, 64, 64), (901, 63, 63), (902, 65, 70), (903, -100_000, 100_000), (904, None, None)]
    left, right = spark.createDataFrame(a, "i int, s long, e long"), spark.createDataFrame(b, "j int, f long, t long")
    found = sorted((r["i"], r["j"]) for r in interval_join(left, right, ("s", "e"), ("f", "t")).collect())
    known = [(i, s, e) for i, s, e in a if s is not None and e is not None and s <= e]
    assert found == sorted((i, j) for i, s, e in known for j, f, t in b if f is not None and t is not None and s <= t and f <= e)
    text = plan_of(interval_join(left, right, ("s", "e"), ("f", "t")))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert interval_join(left.limit(0), right, ("s", "e"), ("f", "t")).count() == 0


def test_rows_of_one_interval_stay_together(spark):
    """Pairs come as one right row beside a run of left rows, so what does not change between rows takes no room."""
    left = spark.range(6000).selectExpr("id AS i", "id % 3 * 10 AS s", "id % 3 * 10 + 1 AS e")
    right = spark.range(400).selectExpr("id AS j", "id % 2 * 10 + 1 AS f", "id % 2 * 10 + 5 AS t")
    joined = interval_join(left, right, ("s", "e"), ("f", "t"))
    parts = joined.select("i", "j").rdd.glom().collect()
    pairs = [(r["i"], r["j"]) for rows in parts for r in rows]
    assert len(pairs) == len(set(pairs)) == 2 * 2000 * 200
    assert all(i % 3 == j % 2 for i, j in pairs)
    runs = sum(1 + sum(a["j"] != b["j"] for a, b in zip(rows, rows[1:])) for rows in parts if rows)
    assert len(pairs) / runs > 100
    # A run is bounded: an interval with many rows has several bundles.
    assert max(len(b) for b in _bundles(left)) <= 2 * BUNDLE


def test_a_crowded_bin_is_met_by_several_tasks(spark, monkeypatch):
    """Most pairs lie in one bin of the level of the long intervals; both sides reach the join by a shuffle."""
    monkeypatch.setattr("tidemark.operators.intervals.PAIRS", 2000, raising=False)
    left = spark.range(4000).selectExpr("id AS i", "id % 400 AS s", "id % 400 + 1 AS e")
    right = spark.range(30).selectExpr("id AS j", "id AS f", "id + 400 AS t")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        parts = interval_join(left, right, ("s", "e"), ("f", "t")).select("i", "j").rdd.glom().collect()
    pairs = [(r["i"], r["j"]) for rows in parts for r in rows]
    assert sorted(pairs) == sorted((i, j) for i in range(4000) for j in range(30) if i % 400 + 1 >= j)
    assert max(len(rows) for rows in parts) < 0.6 * len(pairs)


def _bundles(left):
    spans = left.select(F.struct("i").alias("_a"), F.col("s").alias("_as"), F.col("e").alias("_ae"))
    return [r["_a"] for r in _bundled(spans, "a").collect()]


# Quantiles


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_quantiles_are_exact(spark, bins):
    rng = random.Random(bins)
    values = [rng.randrange(-(10**6), 10**6) for _ in range(300)] + [77] * 250 + [2**62, -(2**62)]
    if bins == 2:
        values = values[:-2]
    shares = ["0", "0.001", "0.333", "0.5", "0.5", "0.75", "0.999", "1"]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v long")
    ordered = sorted(values)
    expected = [ordered[max(math.ceil(Decimal(q) * len(values)), 1) - 1] for q in shares]
    assert exact_quantiles(df, "v", shares, bins) == expected
    assert exact_quantiles(df.where("v IS NULL"), "v", shares) == [None] * 8
    assert exact_quantiles(df.where("v = 77"), "v", ["0", "1"]) == [77, 77]


@pytest.mark.parametrize(("n", "groups"), [(10, 4), (3, 5), (40, 8), (1, 1)])
def test_ntile_sizes(spark, n, groups):
    found = ntile(spark.range(n).select((F.col("id") * 7 % n).alias("k")), ["k"], groups).orderBy("k").collect()
    expected = [i for i in range(1, groups + 1) for _ in range(n // groups + (i <= n % groups))]
    assert [r["ntile"] for r in found] == expected


# Calendar frames


@pytest.mark.parametrize("stretch", [7, 16, 128])
def test_moving_sums_reach_over_stretches(spark, stretch):
    rng = random.Random(stretch)
    rows = [(rng.choice(["hot", "hot", "b"]), (DAY + timedelta(days=rng.randrange(-40, 60))).date(), rng.randrange(9)) for _ in range(150)] + [("b", None, 5)]
    df = spark.createDataFrame(rows, "k string, day date, v int")
    found = sorted(map(repr, (tuple(r) for r in moving_sum(df, "k", "day", "v", 7, "s", stretch).collect())))
    assert found == sorted(repr((k, d, v, None if d is None else sum(w for j, e, w in rows if j == k and e is not None and d - timedelta(days=6) <= e <= d))) for k, d, v in rows)
    with pytest.raises(ValueError, match="stretch"):
        moving_sum(df, "k", "day", "v", 8, "s", 7)


# Changes


def test_changes_of_a_multiset(spark):
    before = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3), ("d", None), (None, 1)], "k string, v int")
    after = spark.createDataFrame([("a", 1), ("b", 20), ("e", 5), ("e", 5), ("d", None), (None, 2)], "k string, v int")
    found = {tuple(r) for r in table_changes(before, after, "k").collect()}
    assert found == {
        ("a", 1, -1, "updated"), ("b", 2, -1, "updated"), ("b", 20, 1, "updated"), ("c", 3, -1, "deleted"), ("e", 5, 2, "inserted"),
        (None, 1, -1, "updated"), (None, 2, 1, "updated"),
    }
    assert table_changes(before, before, "k").count() == 0


def test_history_takes_late_changes_between(spark, tmp_path):
    path = str(tmp_path / "history")
    day = {i: (DAY + timedelta(days=i)).date() for i in range(10)}

    def batch(*rows):
        df = spark.createDataFrame([(k, day.get(d), v) for k, d, v in rows], "k string, at date, v string")
        return sorted(map(repr, (tuple(r) for r in apply_to_history(df, path, "k", "at", ["v"], buckets=4).collect())))

    def versions(*rows):
        return sorted(repr((k, day[a], day.get(b), v)) for k, a, b, v in rows)

    assert batch(("a", 1, "x"), ("a", 5, "x"), ("b", 2, "x"), (None, 1, "x"), ("c", 99, "x")) == versions(("a", 1, None, "x"), ("b", 2, None, "x"))
    late = [("a", 3, "y"), ("b", 1, None)]
    expected = versions(("a", 1, 3, "x"), ("a", 3, 5, "y"), ("a", 5, None, "x"), ("b", 1, 2, None), ("b", 2, None, "x"))
    assert batch(*late) == expected and batch(*late) == expected
    # A correction of a day, and of two contents of one day the greater.
    assert batch(("a", 3, "x"), ("b", 4, "m"), ("b", 4, "n")) == versions(("a", 1, None, "x"), ("b", 1, 2, None), ("b", 2, 4, "x"), ("b", 4, None, "n"))


# Documents and sketches


def test_fields_of_documents(spark):
    texts = ['{"k": 1, "s": "a"}', '{"k": "x", "s": "b"}', "{", None, "[1]", '{"k": 2}', '{"k": 1.5, "s": "c"}']
    found = typed_fields(spark.createDataFrame([(t,) for t in texts], "props string"), "props", {"k": "bigint", "s": "string"}).collect()
    assert [(r["k"], r["s"]) for r in found][:6] == [(1, "a"), (None, "b"), (None, None), (None, None), (None, None), (2, None)]
    assert [r["fault"] for r in found][:6] == [None, "k is no number", "no document", None, "k is no number", "s is missing"]
    assert [r["bad_props"] for r in found][:3] == [None, texts[1], texts[2]]


@pytest.mark.parametrize("n", [50, 3000, 60_000])
def test_merged_sketches_stay_within_their_error(spark, n):
    rows = spark.range(n * 2).select((F.col("id") % n).alias("user"), (F.col("id") % 24).alias("hour"))
    hours = rows.groupBy("hour").agg(F.hll_sketch_agg("user", F.lit(12)).alias("s"))
    merged = hours.agg(F.hll_sketch_estimate(F.hll_union_agg("s"))).head()[0]
    whole = rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg("user", F.lit(12)))).head()[0]
    assert abs(merged - n) <= math.ceil(0.05 * n) and abs(merged - whole) <= math.ceil(0.02 * n)
