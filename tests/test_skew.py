"""One key holding a large share of the rows: whole results, without multiplying or collecting the key."""

import random
import re
from contextlib import contextmanager
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from tradewind.functions.ranges import make_range
from tradewind.operators import matching
from tradewind.operators.matching import overlap_join, trigram_match
from tradewind.operators.profiling import mode_per_group
from tradewind.operators.topk import nested_top
from tradewind.plans import catalog as C
from tradewind.plans import reports as R

HOT_ITEMS, HOT_REVIEWS = 20_000, 20_000


@pytest.fixture(scope="module")
def hot(spark):
    """Ten thousand ordinary orders, and one with 20,000 items of one product and 20,000 reviews."""
    time = F.timestamp_seconds(F.lit(1_520_000_000))
    order = spark.range(10_001).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        time.alias("order_purchase_timestamp"),
    )
    item = spark.range(HOT_ITEMS + 10_000).select(
        F.when(F.col("id") < HOT_ITEMS, 0).otherwise(F.col("id") - HOT_ITEMS + 1).alias("order_id"),
        time.alias("order_purchase_timestamp"),
        F.when(F.col("id") < HOT_ITEMS, 0).otherwise(F.col("id") % 50).alias("product_id"),
        (F.col("id") % 3).alias("seller_id"),
        F.lit("1.00").cast("decimal(10,2)").alias("price"),
        F.lit("0.50").cast("decimal(10,2)").alias("freight_value"),
    )
    review = spark.range(HOT_REVIEWS).select(
        F.col("id").alias("review_id"), (F.col("id") * 0).alias("order_id"), time.alias("order_purchase_timestamp"),
        (1 + F.col("id") % 5).cast("smallint").alias("review_score"),
    )
    seller = spark.range(3).select(F.col("id").alias("seller_id"), F.lit("x").alias("seller_city"), F.lit("y").alias("seller_state"))
    product = spark.range(50).select(F.col("id").alias("product_id"), (F.col("id") % 2).cast("string").alias("category_name"))
    category = spark.createDataFrame([("0", "even"), ("1", "odd")], "category_name string, name_english string")
    return {"order": order, "order_item": item, "review": review, "seller": seller, "product": product, "product_category": category}


@contextmanager
def settings(spark, **conf):
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_order_is_not_multiplied(hot):
    """Its items and reviews would meet in 400 million rows."""
    out = R.seller_performance(hot["seller"], hot["order_item"], hot["order"], hot["review"]).collect()
    assert sum(r["total_revenue"] for r in out) == HOT_ITEMS * HOT_REVIEWS + 10_000
    assert {r["avg_freight"] for r in out} == {Decimal("0.50")} and {r["avg_review"] for r in out} == {Decimal("3.00")}
    worst = R.worst_reviewed_products(hot["product"], hot["product_category"], hot["order_item"], hot["order"], hot["review"])
    assert [(r["product_id"], r["review_count"]) for r in worst.collect()] == [(0, HOT_ITEMS * HOT_REVIEWS)]


def test_hot_product_is_split_at_run_time(spark, hot):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        items = spark.range(60_000).select(
            (F.col("id") % 10_001).alias("order_id"),
            F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("product_id"),
            F.lit("1.00").cast("decimal(10,2)").alias("price"),
        )
        reviews = hot["review"].withColumn("order_id", F.col("review_id") % 10_001)
        df = R.sales_by_category(hot["order"], items, hot["product"], hot["product_category"], reviews, "2018-01-01", "2019-01-01")
        got = df.collect()
        assert "SortMergeJoin(skew=true) [product_id" in re.sub(r"#\d+L?", "", plan_of(df))
    per_order = [60_000 // 10_001 + (o < 60_000 % 10_001) for o in range(10_001)]
    per_review = [HOT_REVIEWS // 10_001 + (o < HOT_REVIEWS % 10_001) for o in range(10_001)]
    assert sum(r["gross_revenue"] for r in got) == sum(i * max(n, 1) for i, n in zip(per_order, per_review))


def test_nested_top_drops_rows_before_the_shuffle(spark):
    df = spark.range(50_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"), "id")
    top = nested_top(df, ["k"], [F.col("id").desc()], 3, [F.col("id")], "best")
    plan = plan_of(top)
    assert plan.count("WindowGroupLimit") == 2  # in every task, then per key
    assert [r["id"] for r in top.where("k = 'hot'").first()["best"]] == [49_999, 49_997, 49_996]


def test_complete_lists_stay_rows(spark):
    products = spark.range(30_000).select(
        F.col("id").alias("product_id"), F.lit("hot").alias("product_category_name"),
        F.lit(25).alias("product_weight_g"), F.lit(1).alias("product_height_cm"),
    )
    events = spark.createDataFrame([("hot", "search")], "category string, event_type string")
    df = C.category_weights_early_products(products, events, "hot")
    assert df.count() == 30_000 and df.first()["sample_count"] == 30_000
    assert "collect_list(product_id" not in plan_of(df)


def test_mode_counts_before_a_key_comes_together(spark):
    df = spark.range(30_000).select(F.lit("z").alias("k"), (F.col("id") % 2000).cast("string").alias("v"))
    assert mode_per_group(df, ["k"], ["v"]).first()["v"] == "0"
    assert "mode(" not in plan_of(mode_per_group(df, ["k"], ["v"]))


def test_common_trigrams_form_no_pairs(spark):
    """Every text contains the word "shop"; only equal numbers are similar enough."""
    left = spark.range(3000).select(F.concat(F.lit("shop "), F.sha2(F.col("id").cast("string"), 256).substr(1, 12)).alias("l"))
    right = spark.range(2990, 6000).select(F.concat(F.lit("shop "), F.sha2(F.col("id").cast("string"), 256).substr(1, 12)).alias("r"))
    copies = left.unionByName(left).unionByName(left)
    assert trigram_match(copies, right, "l", "r", 0.9).count() == 10


def test_crowded_period_forms_few_pairs(spark):
    """Twenty thousand seconds of one day on each side, next to one range that never ends."""
    at = lambda shift: F.timestamp_millis(F.col("id") * 4000 + shift)
    left = spark.range(20_000).select(F.col("id").alias("a"), make_range(at(0), at(1000)).alias("p"))
    forever = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("b"), make_range(at(0), F.lit(None).cast("timestamp")).alias("q")
    )
    right = spark.range(20_000).select(F.col("id").alias("b"), make_range(at(500), at(1500)).alias("q")).unionByName(forever)
    pairs = overlap_join(left, right, "p", "q")
    assert pairs.count() == 40_000
    assert pairs.where("b >= 0 and a <> b").count() == 0


def test_open_ranges_are_spread(spark):
    """A third of the ranges on each side are open, many start at one moment: as many pairs are formed as match, in even blocks."""
    rng = random.Random(12)

    def make(n):
        out = []
        for i in range(n):
            lo = 500 if i % 4 == 0 else rng.randint(0, 100_000)
            out.append((i, lo if i % 6 else None, None if i % 6 in (0, 1) else lo + rng.choice([1, 5, 50])))
        return out

    def frame(data, names):
        at = lambda c: F.when(F.col(c).isNotNull(), F.timestamp_seconds(F.col(c)))
        df = spark.createDataFrame(data, "i long, lo long, hi long")
        return df.select(F.col("i").alias(names[0]), make_range(at("lo"), at("hi")).alias(names[1]))

    left, right = make(3000), make(3000)
    a, b = frame(left, ("a", "p")), frame(right, ("b", "q"))
    low = lambda rows: np.array([-1e9 if r[1] is None else r[1] for r in rows])
    high = lambda rows: np.array([1e9 if r[2] is None else r[2] for r in rows])
    want = ((low(left)[:, None] < high(right)) & (low(right) < high(left)[:, None])).sum()
    assert overlap_join(a, b, "p", "q").count() == want
    swept = matching._swept(matching._with_ends(a, "p", "a"), matching._with_ends(b, "q", "b"))
    pairs = matching._starts_within(swept, "a", "b").unionByName(matching._starts_within(swept, "b", "a"))
    assert pairs.count() < 1.1 * want
    starts = swept.where("kind = 'start' and side = 'a'").groupBy(F.shiftright("before_a", 8)).count()
    assert starts.agg(F.max("count")).first()[0] <= 256


def test_approximate_distinct_counts(hot):
    items = hot["order_item"]
    exact = R.monthly_sales_trend(hot["order"], items).first()["total_orders"]
    rough = R.monthly_sales_trend(hot["order"], items, approximate_distinct=True).first()["total_orders"]
    assert exact == 10_001 and abs(rough - exact) < 0.05 * exact
