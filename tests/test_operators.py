import random
from collections import Counter, defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, joins, profile, running, topk
from tidemark.operators.ranking import dense_numbers, rank_by


def test_dedup_prefers_newest_then_ties(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [("a", 2, old), ("a", 9, new), ("a", 3, new), ("b", 1, None), ("b", 5, old), (None, 7, old), (None, 6, old)]
    df = spark.createDataFrame(rows, "k STRING, v INT, _ingestion_timestamp TIMESTAMP")
    expected = {("a", 3), ("b", 5), (None, 6)}
    for seed in range(3):  # the result does not depend on row order
        shuffled = df.orderBy(F.rand(seed))
        got = {(r["k"], r["v"]) for r in dedup.latest_per_key(shuffled, ["k"]).collect()}
        assert got == expected


def test_dedup_hashed_ties_are_stable(spark):
    df = spark.createDataFrame([("a", "long text one"), ("a", "long text two")], "k STRING, t STRING")
    picks = {dedup.latest_per_key(df.orderBy(F.rand(s)), ["k"], [], ["t"]).head()["t"] for s in range(4)}
    assert len(picks) == 1


def test_dedup_prunes_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = dedup.latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salts", [1, 7])
def test_salted_lookup_equals_plain_join(spark, how, salts):
    rng = random.Random(1)
    facts = [(i, "hot" if i % 3 else f"k{rng.randrange(20)}") for i in range(900)] + [(1000, None), (1001, "absent")]
    f = spark.createDataFrame(facts, "id INT, k STRING")
    d = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"v{i}") for i in range(15)], "k STRING, v STRING")
    got = joins.salted_lookup(f, d, "k", ["id"], how, salts)
    expected = f.join(d, "k", how)
    assert sorted(map(str, got.select("id", "k", "v").collect())) == sorted(map(str, expected.select("id", "k", "v").collect()))


def test_salted_lookup_spreads_a_hot_key(spark):
    f = spark.range(4000).select("id", F.lit("hot").alias("k"))
    d = spark.createDataFrame([("hot", 1)], "k STRING, v INT")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_lookup(f, d, "k", ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 3000


def test_heavy_keys_are_found_and_few(spark):
    """A third of the rows, half a per cent and a tail of single rows; keys sorted over the partitions or mixed."""
    rows = spark.range(0, 60_000, 1, 12).select(
        F.when(F.col("id") < 20_000, "hot").when(F.col("id") < 20_300, "warm").when(F.col("id") < 20_600, F.lit(None)).otherwise(F.concat(F.lit("k"), "id")).alias("k")
    )
    for df in (rows, rows.repartition(9)):
        found = {r[0] for r in joins.heavy_keys(df, "k", 500).collect()}
        assert {"hot", "warm"} <= found and len(found) <= 1000 and None not in found
    assert joins.heavy_keys(rows.limit(0), "k").count() == 0
    assert joins.heavy_keys(spark.sql("SELECT CAST(null AS INT) AS k"), "k").count() == 0


def test_salted_lookup_copies_heavy_dimension_rows_alone(spark):
    f = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    d = f.select("k").distinct().withColumn("v", F.col("k") * 2)
    held = (joins.heavy_keys(f, "k").collect(), joins.salted_lookup(f, d, "k", ["id"]))
    assert [r[0] for r in held[0]] == [-1]
    assert held[1].where("v = k * 2").count() == 30_000
    plan = held[1]._jdf.queryExecution().executedPlan().toString()
    assert "sequence(0, CASE WHEN isnotnull(_heavy_key" in plan


def test_salted_lookup_rejects_other_join_types(spark):
    df = spark.createDataFrame([("a",)], "k STRING")
    with pytest.raises(ValueError, match="lookup type"):
        joins.salted_lookup(df, df, "k", ["k"], "full")


def test_orphans_count_null_keys(spark):
    f = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "k STRING")
    d = spark.createDataFrame([("a",), (None,)], "id STRING")
    assert {r["k"] for r in joins.orphan_keys(f, "k", d, "id").collect()} == {"x", None}


def brute_rank(rows, groups, value):
    """Rank by definition: one more than the rows of the group with a higher value; nulls come last."""
    by_group = defaultdict(list)
    for r in rows:
        by_group[tuple(r[g] for g in groups)].append(r[value])
    result = Counter()
    for r in rows:
        values = by_group[tuple(r[g] for g in groups)]
        mine = r[value]
        if mine is None:
            above = sum(v is not None for v in values)
        else:
            above = sum(v is not None and v > mine for v in values)
        result[(r["id"], above + 1)] += 1
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_rank_forms_match_the_definition(spark, seed):
    rng = random.Random(seed)
    values = [0] * 120 + [rng.randrange(15) for _ in range(150)] + [rng.random() * 100 for _ in range(60)] + [None] * 9
    cats = ["hot"] * 200 + [f"c{rng.randrange(6)}" for _ in range(120)] + [None] * 19
    rng.shuffle(values)
    rows = [{"id": i, "cat": c, "v": None if v is None else float(v)} for i, (c, v) in enumerate(zip(cats, values))]
    df = spark.createDataFrame([(r["id"], r["cat"], r["v"]) for r in rows], "id INT, cat STRING, v DOUBLE")
    got = rank_by(df, [("in_cat", ["cat"], "v"), ("overall", [], "v")]).collect()
    assert Counter((r["id"], r["in_cat"]) for r in got) == brute_rank(rows, ["cat"], "v")
    assert Counter((r["id"], r["overall"]) for r in got) == brute_rank(rows, [], "v")


def test_large_rank_never_sorts_in_one_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("cat"), (F.col("id") % 50).alias("v"))
    ranked = rank_by(df, [("in_cat", ["cat"], "v")])
    assert "SinglePartition" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_dense_numbers(spark):
    keys = [f"k{i:04d}" for i in range(500)]
    random.Random(3).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k STRING").repartition(7)
    got = {r["k"]: r["n"] for r in dense_numbers(df, ["k"], "n").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_dense_numbers_of_nothing(spark):
    df = spark.createDataFrame([], "k STRING")
    assert dense_numbers(df, ["k"], "n").count() == 0


def test_numbered_rows_keep_their_columns_and_pass_one_range_shuffle(spark):
    df = spark.range(200).select((F.lit(199) - F.col("id")).alias("k"), (F.col("id") % 3).alias("v"))
    numbered = dense_numbers(df, ["k"], "n", after=10)
    assert numbered.columns == ["n", "k", "v"]
    assert {(r["n"], r["k"], r["v"]) for r in numbered.collect()} == {(k + 11, k, (199 - k) % 3) for k in range(200)}
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning(k" not in plan


def test_beside_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1, 5), (1, None, 6), (2, 2, 7)], "a INT, b INT, x INT")
    right = spark.createDataFrame([(None, 1, 8), (1, None, 9)], "a INT, b INT, y INT")
    assert {(r["x"], r["y"]) for r in joins.beside(left, right, ["a", "b"]).collect()} == {(5, 8), (6, 9), (7, None)}


def test_running_figures_are_over_rows_present(spark):
    days = [("2024-12-30", 1), ("2024-12-31", 2), ("2025-01-05", 4)]
    df = spark.createDataFrame(days, "d STRING, v INT").select(F.to_date("d").alias("d"), "v").withColumn("y", F.year("d"))
    got = df.select(
        "d",
        running.year_to_date("v", "y", "d").alias("ytd"),
        running.moving_average("v", "d", 2).alias("ma2"),
        running.change_from_previous("v", "d").alias("change"),
    ).orderBy("d").collect()
    assert [r["ytd"] for r in got] == [1, 3, 4]
    assert [r["ma2"] for r in got] == [1.0, 1.5, 3.0]
    assert [r["change"] for r in got] == [None, 1, 2]


def test_topk_breaks_ties_and_checks_the_limit(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 2), ("d", None)], "k STRING, v INT")
    assert [r["k"] for r in topk.top_rows(df, "v", ["k"], 3, 10).collect()] == ["c", "a", "b"]
    for bad in (0, 11):
        with pytest.raises(ValueError, match="row limit"):
            topk.top_rows(df, "v", ["k"], bad, 10)


def test_topk_plan_keeps_k_rows_per_task(spark):
    df = spark.range(100).select("id")
    plan = topk.top_rows(df, "id", [], 5, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_profiles(spark, raw_customers, raw_orders):
    missing = {(r["column_name"]): (r["null_count"], float(r["null_percent"])) for r in profile.missing_values({"c": raw_customers}).collect()}
    assert missing["phone"] == (4, 66.67) and "customer_id" not in missing
    sizes = profile.table_sizes({"c": raw_customers, "o": raw_orders}).collect()
    assert {(r["table_name"], r["row_count"], r["column_count"]) for r in sizes} == {("c", 6, 11), ("o", 8, 7)}
    figures = {r["column_name"]: r for r in profile.summary_figures(raw_orders).collect()}
    assert figures["total_amount"]["value_count"] == 7
    assert figures["total_amount"]["mean"] == pytest.approx(353.5 / 7, abs=1e-4)
    spread = raw_orders.agg(F.stddev("total_amount").alias("s")).head()["s"]
    assert figures["total_amount"]["stddev"] == pytest.approx(spread, abs=1e-3)
    assert figures["status"]["mean"] is None and figures["status"]["max_value"] == "refunded"
    assert profile.preview(raw_orders, 3).count() == 3


def test_missing_values_scan_each_table_once(spark, raw_orders, tmp_path):
    raw_orders.write.parquet(str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    plan = profile.missing_values({"o": stored})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
