"""Hot keys: adaptive execution must be able to split them (both join sides come straight from a shuffle)."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import folded_lookup, salted_lookup
from tidemark.operators.ranking import dense_numbers, rank_by
from tidemark.plans import gold, silver, star

# Thresholds so low that the little data below counts as skewed; broadcasts are off.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200B",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def eager_splitting(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def items(spark):
    """A third of the items belong to one order, and a third of the rest to one product."""
    n = F.col("id")
    return spark.range(0, 6000, 1, 6).select(
        F.concat(F.lit("I"), n).alias("item_id"),
        F.when(n % 3 == 0, "O7").otherwise(F.concat(F.lit("O"), n % 500)).alias("order_id"),
        F.when(n % 3 == 1, "P3").otherwise(F.concat(F.lit("P"), n % 90)).alias("product_id"),
        (n % 7 + 1).cast("int").alias("quantity"),
        F.lit(2.5).alias("unit_price"),
        F.lit(0.0).alias("discount"),
        F.xxhash64("id").alias("noise"),
    )


def skewed_joins(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "Join(skew=true)" in line]


def test_order_lookup_of_items_is_split(spark, eager_splitting, items):
    orders = dense_numbers(items.select("order_id").distinct(), ["order_id"], "order_key")
    joined = silver.order_items(items).join(orders.select("order_id", "order_key"), "order_id", "left")
    assert any("order_id" in line for line in skewed_joins(joined))


def test_salted_lookup_is_split_further(spark, eager_splitting, items):
    products = items.select("product_id").distinct().withColumn("product_key", F.xxhash64("product_id"))
    found = salted_lookup(items, products, "product_id", ["item_id"], "left")
    assert any("_salt" in line for line in skewed_joins(found))


def test_rank_of_a_shared_value_is_split(spark, eager_splitting, items):
    rows = items.select("item_id", "noise", F.when(F.col("quantity") < 6, 0).otherwise(F.col("noise")).alias("v"))
    assert skewed_joins(rank_by(rows, [("r", [], "v")]))


def test_items_are_folded_before_they_meet_orders(spark, items):
    """6,000 items become one row per order and product, so the hot order brings at most one row per product."""
    folded = gold.items_per_order_product(items.withColumn("line_total", F.lit(1).cast("decimal(22,2)")))
    hot = folded.filter("order_id = 'O7'").count()
    assert hot <= items.select("product_id").distinct().count()


def test_fact_items_are_whole_under_skew(spark, eager_splitting, items):
    cleaned = silver.order_items(items)
    orders = dense_numbers(items.select("order_id").distinct(), ["order_id"], "order_key")
    products = dense_numbers(items.select("product_id").distinct(), ["product_id"], "product_key")
    facts = star.fact_order_items(cleaned, orders, products)
    got = facts.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("item_key").alias("keys"), F.max("item_key").alias("top"),
        F.count_if((F.col("order_key") < 0) | (F.col("product_key") < 0)).alias("unknown"),
    ).head()
    assert tuple(got) == (6000, 6000, 6000, 0)


def test_items_are_dealt_by_order_once(spark, eager_splitting, items):
    """Fold and join share the shuffle of the items: it is by order, and the other one is of the orders."""
    orders = items.select("order_id").distinct().withColumn("status", F.lit("shipped"))
    priced = items.withColumn("line_total", F.lit(1).cast("decimal(22,2)"))
    sold = gold.product_sales(priced.localCheckpoint(), orders.localCheckpoint())
    plan = sold._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(order_id" in line]
    assert len(dealt) == 2 and all("_salt" in line and "product_id" not in line.split("hashpartitioning(")[1].split(")")[0] for line in dealt)


def test_folded_lookup_is_the_fold_beside_the_dimension(spark, items):
    """A hot order, items without an order or a product, and orders that are missing or there twice."""
    orders = items.where("order_id <> 'O8'").select("order_id").distinct().withColumn("status", F.lit("shipped"))
    orders = orders.unionByName(orders.where("order_id IN ('O7', 'O9')")).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS order_id, 'lost' AS status"))
    n = F.col("quantity")
    odd = items.withColumn("order_id", F.when(n != 3, F.col("order_id"))).withColumn("product_id", F.when(n != 4, F.col("product_id")))
    sums = [F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("lines")]
    want = odd.groupBy("order_id", "product_id").agg(*sums).join(orders, "order_id")
    got = folded_lookup(odd, orders, "order_id", "product_id", sums)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
