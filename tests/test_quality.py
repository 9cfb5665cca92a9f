import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import seeds
from helpers import plan_of, rows
from tradewind.operators import profiling as P
from tradewind.operators import quality as Q
from tradewind.operators import quantiles
from tradewind.plans import explore as E
from tradewind.schemas import DOCUMENT_FIELDS, NOT_NULL, REFERENCES, required, row_rules


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    assert rows(Q.duplicate_keys(df, ["k", "n"])) == [("a", 1, 2)]


def test_orphans_and_actions(spark):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, ref string")
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    assert [r["id"] for r in Q.orphans(child, parent, ["ref"], ["key"]).collect()] == [2]
    actions = {r.on_delete for r in REFERENCES}
    assert actions == {"set null", "restrict", "cascade"}
    from dataclasses import replace

    ref = replace(REFERENCES[0], columns=["ref"], parent_columns=["key"])
    gone = parent.where("key = 'a'")
    assert rows(Q.on_parent_delete(child, gone, replace(ref, on_delete="set null"))) == [(1, None), (2, "x"), (3, None)]
    assert rows(Q.on_parent_delete(child, gone, replace(ref, on_delete="cascade"))) == [(2, "x"), (3, None)]
    assert rows(Q.on_parent_delete(child, gone, replace(ref, on_delete="restrict"))) == [(1, "a")]
    with pytest.raises(ValueError):
        Q.on_parent_delete(child, gone, replace(ref, on_delete="ignore"))


def test_row_rules_and_quarantine(spark):
    df = spark.createDataFrame([("p1", -1, 1.0), ("p2", 3, None), ("p3", 1, -2.0)], "id string, review_score int, price double")
    rules = [*row_rules("review"), required("price")]
    good, bad = Q.split_valid(df, rules)
    assert rows(good) == [("p3", 1, -2.0)]
    assert {r["id"]: r["failed_rules"] for r in bad.collect()} == {
        "p1": ["review_score_between_1_and_5"], "p2": ["price_required"]}
    assert rows(Q.rule_summary(df, rules)) == [("price_required", 1), ("review_score_between_1_and_5", 1)]
    assert set(NOT_NULL["order"]) >= {"order_id", "customer_id"}


def violations(spark, collection, docs):
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "i int, doc string")
    return [r["violations"] for r in Q.validate_documents(df, "doc", DOCUMENT_FIELDS[collection]).orderBy("i").collect()]


def test_session_documents(spark):
    ok = {"_id": "s", "cart": [{"product_id": "p", "quantity": 1, "unit_price": 2.5}], "created_at": "2024-01-01T00:00:00Z", "expires_at": "2024-01-02T00:00:00Z"}
    got = violations(spark, "user_sessions", [
        ok,
        {**ok, "cart": []},
        {**ok, "cart": [{"product_id": 1, "quantity": 0}, "x"]},
        {**ok, "_id": None},
        {k: v for k, v in ok.items() if k != "created_at"},
        {**ok, "cart": [{"product_id": "p", "quantity": 1.5, "unit_price": 2}]},
        "[1]",
        "{broken",
    ])
    assert got == [
        [], [],
        ["cart[].product_id: not string", "cart[].quantity: below 1", "cart[].unit_price: missing", "cart[]: not object"],
        ["_id: not string"],
        ["created_at: missing"],
        ["cart[].quantity: not int", "cart[].unit_price: not double"],
        ["not an object"], ["not an object"],
    ]


def test_catalogue_documents_from_files_fail_their_schema(spark):
    loaded = {"product_id": "p", "product_category_name": "x", "product_weight_g": 0}
    full = {**loaded, "name": "n", "avg_review_score": 5.5, "tags": ["a", 1], "created_at": "2024-01-01", "updated_at": "soon"}
    got = violations(spark, "products_catalog", [loaded, full])
    assert got[0] == ["created_at: missing", "name: missing", "updated_at: missing"]
    assert got[1] == ["avg_review_score: above 5", "tags[]: not string", "updated_at: not date"]


def test_reconcile_and_dependencies(spark):
    a, b = spark.range(3), spark.range(2)
    assert rows(Q.reconcile({"x": a, "y": a}, {"x": a, "y": b, "z": b})) == [
        ("x", 3, 3, True), ("y", 3, 2, False), ("z", None, 2, False)]
    df = spark.createDataFrame([("z", "a"), ("z", "b"), ("y", "a"), ("y", None)], "zip string, city string")
    assert rows(Q.dependency_violations(df, ["zip"], "city")) == [("z", 2)]


def test_versions(spark):
    v1 = spark.createDataFrame([("a",)], "id string")
    v2 = spark.createDataFrame([("b", 2, "t")], "id string, schema_version int, tags string")
    assert rows(Q.read_versions([v1, v2]).select("id", "schema_version", "tags")) == [("a", 1, None), ("b", 2, "t")]
    assert Q.read_versions([v1]).first()["schema_version"] == 1


# --- profiling ---


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
@pytest.mark.parametrize("kind", ["spread", "few", "skewed"])
def test_exact_quantiles(spark, n, kind, monkeypatch):
    rng = random.Random(n)
    draw = {"spread": lambda: rng.uniform(-5, 5), "few": lambda: float(rng.randint(0, 3)), "skewed": lambda: 7.0 if rng.random() < 0.4 else rng.gauss(7, 1)}[kind]
    data = [draw() for _ in range(n)]
    monkeypatch.setattr(quantiles, "PER_OCTAVE", 2)  # coarse buckets
    df = spark.createDataFrame([(x, 1) for x in data] + [(None, 1)], "x double, y int")
    got = {(r[0], r[1]): r[2] for r in P.exact_quantiles(df, ["x", "y"], [0.0, 0.25, 0.5, 0.99, 1.0]).collect()}
    for p in (0.0, 0.25, 0.5, 0.99, 1.0):
        assert math.isclose(got["x", p], np.quantile(data, p), abs_tol=1e-9)
        assert got["y", p] == 1.0


@pytest.mark.parametrize("kind", ["spread", "ties", "wide"])
def test_quantiles_when_brackets_miss_or_are_large(spark, kind, monkeypatch):
    rng = random.Random(8)
    draw = {
        "spread": lambda: rng.gauss(0, 1),
        "ties": lambda: 3.0 if rng.random() < 0.7 else float(rng.randint(0, 9)),
        "wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
    }[kind]
    data = [draw() for _ in range(5000)]
    monkeypatch.setattr(quantiles, "PER_OCTAVE", 1)
    monkeypatch.setattr(quantiles, "PARTS", 16)
    monkeypatch.setattr(quantiles, "INSIDE", 20)
    df = spark.createDataFrame([(x,) for x in data], "x double")
    got = {r[1]: r[2] for r in P.exact_quantiles(df, ["x"], [0.1, 0.37, 0.75]).collect()}
    for p, value in got.items():
        assert math.isclose(value, np.quantile(data, p), rel_tol=1e-9, abs_tol=1e-300)


def test_infinite_values(spark):
    """Infinity is a value, NaN is none."""
    data = [-math.inf, 1.0, 2.0, 4.0, math.inf]
    df = spark.createDataFrame([(x,) for x in [*data, math.nan, None]], "x double")
    got = {r[1]: r[2] for r in P.exact_quantiles(df, ["x"], [0.0, 0.1, 0.5, 0.75, 0.9, 1.0]).collect()}
    assert got == {0.0: -math.inf, 0.1: -math.inf, 0.5: 2.0, 0.75: 4.0, 0.9: math.inf, 1.0: math.inf}


def test_tables_are_profiled_in_few_jobs(spark):
    """The number of jobs is the same for two columns and for twelve columns of three tables."""
    df = spark.range(5000).select(*(((F.col("id") * (7 + i)) % 1009 + F.col("id") / 7).alias(f"c{i}") for i in range(4)))
    tracker, counts = spark.sparkContext.statusTracker(), []
    for tables in ({"a": df.select("c0", "c1")}, {"a": df, "b": df.where("c0 > 20"), "c": df.where("c1 > 500")}):
        group = f"profile-{len(counts)}"
        spark.sparkContext.setJobGroup(group, group)
        found = P.describe_tables(tables)
        counts.append(len(tracker.getJobIdsForGroup(group)))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        by = {(r["table_name"], r["column_name"]): r["q50"] for r in found.collect()}
        for name, table in tables.items():
            for c in table.columns:
                assert math.isclose(by[name, c], float(np.median([r[0] for r in table.select(c).collect()])))
    assert counts[0] == counts[1]


def test_outliers(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(100)] + [(100, 500.0)], "order_item_id int, price double")
    out = P.outliers(df, E.IDENTIFIERS).collect()
    assert [(r["column_name"], r["outliers"]) for r in out] == [("price", 1)]
    assert [r["price"] for r in P.outlier_rows(df, "price").collect()] == [500.0]
    assert P.outliers(df.select("order_item_id"), E.IDENTIFIERS).count() == 0
    assert P.outliers(df, E.IDENTIFIERS, approximate=True).first()["outliers"] == 1


def test_a_join_is_made_once_for_all_passes(spark):
    """Quantiles and counts read what is stored; the joins of a table are not made again for each pass."""
    a = spark.range(2000).select("id", (F.col("id") * 37 % 1009 / 7).alias("x"))
    joined = a.join(spark.range(2000).withColumnRenamed("id", "other"), F.col("id") == F.col("other")).select("x", F.col("id").cast("string").alias("s"))
    for report in (lambda: P.outliers_of_tables({"t": joined, "u": a}), lambda: P.outliers(joined), lambda: P.describe_tables({"t": joined, "u": a})):
        plan = plan_of(report())
        assert "profiled" in plan and "other" not in plan
    same = joined.localCheckpoint()
    assert rows(P.outliers_of_tables({"t": joined, "u": a})) == rows(P.outliers_of_tables({"t": same, "u": a}))
    assert rows(P.describe_tables({"t": joined, "u": a}).drop("mean", "std")) == rows(P.describe_tables({"t": same, "u": a}).drop("mean", "std"))


def test_describe_and_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("a", None), (None, 5)], "s string, n int")
    got = {r["column_name"]: r for r in P.describe(df).collect()}
    assert (got["s"]["count"], got["s"]["unique"], got["s"]["top"], got["s"]["freq"]) == (3, 2, "a", 2)
    assert (got["n"]["count"], got["n"]["mean"], got["n"]["q50"], got["n"]["std"]) == (3, 3.0, 3.0, 2.0)
    assert rows(P.null_counts(df)) == [("n", 1), ("s", 1)]
    assert rows(E.null_report({"t": df})) == [("t", "n", 1), ("t", "s", 1)]
    assert [tuple(r) for r in P.type_report({"t": df}).collect()] == [("t", "s", "string"), ("t", "n", "int")]


def test_mode_takes_the_lowest_on_ties(spark):
    df = spark.createDataFrame([("z", "b", 10), ("z", "a", 9), ("z", None, 11), ("y", None, 3)], "k string, c string, n int")
    assert rows(P.mode_per_group(df, ["k"], ["c", "n"])) == [("y", None, 3), ("z", "a", 9)]


def test_shared_columns(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    b = spark.createDataFrame([(1, 1)], "id int, other int")
    assert P.shared_columns([("a", a, "b", b)]) == [("a", "b", "id")]
    assert rows(P.inclusion([("a", a, "b", b)])) == [("a", "b", "id", 2, 1)]


def test_wide_fact_and_back(spark):
    t = seeds.orders(spark)
    geo = spark.createDataFrame(
        [("01001", -23.0, -46.0, "sao paulo", "SP"), ("01001", -24.0, -46.0, "sp", "SP"), ("01001", -25.0, -46.0, "sp", "SP")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    )
    fact = E.orders_full(t["order"], t["customer"], t["payment"], t["review"], t["order_item"], t["product"], t["product_category"], t["seller"], geo)
    assert fact.count() == 2 * 2 * 2 + 1 + 1
    c1 = fact.where("customer_id = 'c1'").first()
    assert (c1["customer_geolocation_lat"], c1["customer_geolocation_city"]) == (-24.0, "sp")
    back = E.decompose(fact)
    assert len(back) == 9
    keys = lambda df, *c: rows(df.select(*c))
    assert keys(back["order_item"], "order_id", "order_item_id") == keys(t["order_item"], "order_id", "order_item_id")
    assert keys(back["payment"], "order_id", "payment_value") == keys(t["payment"], "order_id", "payment_value")
    assert keys(back["review"], "review_id") == keys(t["review"], "review_id")
    assert back["order"].count() == 3 and back["product"].count() == 2
    tagged = E.tagged_rows(fact)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*table_name", plan_of(tagged))) == 1
    digests = {r["table_name"]: tuple(r) for r in E.row_digests(tagged).collect()}
    shuffled = {r["table_name"]: tuple(r) for r in E.row_digests(tagged.repartition(5)).collect()}
    changed = E.tagged_rows(fact.withColumn("price", F.col("price") + 1))
    assert digests == shuffled and {r["table_name"] for r in E.row_digests(changed).collect() if tuple(r) != digests[r["table_name"]]} == {"order_item"}
    slim = E.order_summary(t["order"], t["customer"], t["payment"], t["review"])
    assert slim.count() == 6 and "price" not in slim.columns
    assert E.largest_order_rows(t["order_item"]).count() == 2
    assert E.review_score_by_category(t["order_item"], t["product"], t["review"]).count() == 2
    assert E.monthly_sales_by_state_and_payment(t["order"], t["customer"], t["payment"]).count() == 4


def test_pairs_are_made_distinct_apart_from_the_join(spark):
    """No table of pairs is held beside the sorts of the join with products: the pairs are dealt first."""
    t = seeds.orders(spark)
    plan = plan_of(E.review_score_by_category(t["order_item"], t["product"], t["review"]))
    dealt = re.search(r"Exchange hashpartitioning\(order_id#\d+, product_category_name#\d+[^)]*\)[^\n]*\n([^\n]*)", plan)
    assert dealt and "Aggregate" not in dealt.group(1)
    twice = E.review_score_by_category(t["order_item"].union(t["order_item"]), t["product"], t["review"])
    assert rows(twice) == rows(E.review_score_by_category(t["order_item"], t["product"], t["review"]))


def test_dimensions_join_before_orders_are_multiplied(spark):
    t = seeds.orders(spark)
    geo = spark.createDataFrame(
        [("01001", -23.0, -46.0, "sp", "SP")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
    )
    fact = E.orders_full(t["order"], t["customer"], t["payment"], t["review"], t["order_item"], t["product"], t["product_category"], t["seller"], geo)
    joins = [x for x in fact._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    # the last joins, on top, are those of the order's children
    assert len(joins) == 9 and all(x.count("order_id") == 2 for x in joins[:3])
    # keys come first, as of joins made one after the other
    keys = ["seller_zip_code_prefix", "customer_zip_code_prefix", "seller_id", "product_category_name", "product_id", "customer_id", "order_id"]
    assert fact.columns[:7] == keys and len(set(fact.columns)) == len(fact.columns)
    # a table of the decomposition is made distinct apart from the others, here with a key that has two different rows
    broken = fact.unionByName(fact.withColumn("seller_city", F.lit("other")))
    back = E.decompose(broken)
    assert "table_name" not in plan_of(back["seller"])
    assert back["seller"].count() == 2 * fact.where("seller_id is not null").select("seller_id").distinct().count()
    assert rows(back["order"]) == rows(E.decompose(fact)["order"])


def test_quantiles_shuffle_no_python(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    plan = plan_of(P.exact_quantiles(df, ["x"], [0.5]))
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_values(spark):
    df = spark.createDataFrame([("SP",), ("SP",), ("RJ",), ("MG",), (None,)], "s string")
    assert [tuple(r) for r in E.top_values(df, "s", 2).collect()] == [("SP", 2), ("MG", 1)]
    assert P.value_counts(df, "s").agg(F.sum("count")).first()[0] == 4
