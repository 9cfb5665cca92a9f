"""Rules the reports must keep, on tables small enough to check by hand."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import seeds
from helpers import plan_of, rows
from tradewind.plans import reports as R


@pytest.fixture(scope="module")
def t(spark):
    return seeds.orders(spark)


def test_customer_keys(t):
    args = (t["order"], t["customer"], t["order_item"], t["product"], t["product_category"], t["payment"])
    assert R.order_detail(*args, "o1", "customer_unique_id").count() == 0
    assert R.order_detail(*args, "o1").count() == 4  # two items x two payments
    assert R.top_customers(t["customer"], t["order"], t["order_item"], "customer_unique_id").count() == 0
    assert [r[0] for r in R.top_customers(t["customer"], t["order"], t["order_item"]).collect()] == ["c1", "c2"]


def test_reports_keep_the_multiplicity_of_reviews(t):
    args = (t["seller"], t["order_item"], t["order"], t["review"])
    base = {r["seller_id"]: r for r in R.seller_performance(*args).collect()}
    once = {r["seller_id"]: r for r in R.seller_performance_once(*args).collect()}
    assert base["s1"]["total_revenue"] == Decimal("300.00")  # two items, each once per review
    assert once["s1"]["total_revenue"] == Decimal("150.00")
    assert base["s1"]["avg_review"] == once["s1"]["avg_review"] == Decimal("3.50")
    assert base["s2"]["total_revenue"] == Decimal("30.00") and base["s2"]["avg_review"] is None


def test_product_forms_differ_only_where_they_should(t):
    args = (t["product"], t["product_category"], t["order_item"], t["order"], t["review"])
    by = lambda df: {r["product_id"]: (r["review_count"], r["total_sales"]) for r in df.collect()}
    assert by(R.worst_reviewed_products(*args, min_reviews=1)) == {
        "p1": (2, Decimal("200.00")), "p2": (2, Decimal("100.00"))}
    assert by(R.worst_reviewed_products_once(*args, min_reviews=1)) == {
        "p1": (2, Decimal("130.00")), "p2": (2, Decimal("50.00"))}
    assert by(R.worst_reviewed_products_outer(*args, min_reviews=1)) == {
        "p1": (2, Decimal("230.00")), "p2": (2, Decimal("100.00"))}


def test_sums_equal_the_multiplied_join(t):
    """The weighted form against the join it stands for."""
    joined = (
        R.delivered_items(t["order"], t["order_item"], "customer_id")
        .join(t["review"], R.ORDER_KEY, "left")
        .join(t["customer"], "customer_id")
        .groupBy("customer_state")
        .agg(F.count_distinct("order_id").alias("total_orders"), F.sum("price").alias("total_revenue"))
    )
    report = R.geographic_distribution(t["customer"], t["order"], t["order_item"], t["review"], t["seller"])
    assert rows(report.select("customer_state", "total_orders", "total_revenue")) == rows(joined)


def test_repeated_customer_rows_count_as_in_the_join(t):
    twice = t["customer"].unionByName(t["customer"])
    got = {r[0]: r["total_spent"] for r in R.top_customers(twice, t["order"], t["order_item"]).collect()}
    assert got == {"c1": Decimal("300.00"), "c2": Decimal("60.00")}


def test_closed_range_drops_the_last_afternoon(t):
    assert R.monthly_revenue(t["order"], t["order_item"], "2018-01-01", "2018-12-31").count() == 1
    assert R.monthly_sales_trend(t["order"], t["order_item"], "2018-01-01", "2019-01-01").count() == 2


def test_late_deliveries(t):
    late = R.late_deliveries(t["order"], t["order_item"], t["seller"]).collect()
    assert [r["order_id"] for r in late] == ["o1", "o1"] and str(late[0]["days_late"]) == "10 days, 12:00:00"
    state = R.late_deliveries_by_state(t["order"], t["order_item"], t["seller"]).first()
    assert tuple(state) == ("RJ", 2, Decimal("10.50"))
    assert R.late_deliveries(t["order"], t["order_item"], t["seller"], "2019-01-01", "2020-01-01").count() == 0


def test_descending_measures_put_nulls_first_and_ties_by_key(t):
    category = t["product_category"].unionByName(
        t["product_category"].sparkSession.createDataFrame([("c", None)], "category_name string, name_english string")
    )
    out = R.sales_by_category(
        t["order"], t["order_item"], t["product"], category, t["review"], "2018-01-01", "2019-01-01"
    ).collect()
    assert [(r["category"], r["gross_revenue"], r["avg_score"]) for r in out] == [
        ("A", Decimal("230.00"), Decimal("3.50")), ("B", Decimal("100.00"), Decimal("3.50"))]


def test_filtering_orders_first_is_the_same_plan(t):
    direct = R.payment_method_analysis(t["payment"], t["order"])
    first = R.payment_method_analysis(t["payment"], R.delivered(t["order"]))
    assert rows(direct) == rows(first) and len(rows(direct)) == 3


def test_reports_survive_empty_tables(t):
    none = {k: v.where(F.lit(False)) for k, v in t.items()}
    assert R.seller_performance(none["seller"], none["order_item"], none["order"], none["review"]).count() == 0
    assert R.monthly_sales_trend(none["order"], none["order_item"]).count() == 0
    assert R.counts_side_by_side({"orders": none["order"], "items": t["order_item"]}).first() == (0, 4)


def test_no_python_and_no_cartesian(t):
    report = R.geographic_distribution(t["customer"], t["order"], t["order_item"], t["review"], t["seller"])
    plan = plan_of(report)
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_top_rows_are_taken_before_sorting_everything(t):
    assert "TakeOrderedAndProject" in plan_of(
        R.seller_performance(t["seller"], t["order_item"], t["order"], t["review"])
    )


def test_geo_views_keep_rows_without_a_place(spark, t):
    places = spark.createDataFrame([("01001", -23.5, -46.6)], "zip_code_prefix string, latitude double, longitude double")
    got = {r["customer_id"]: r["location"] for r in R.customer_geo(t["customer"], places).collect()}
    assert got["c1"]["lng"] == -46.6 and got["c2"] is None
    assert R.seller_geo(t["seller"], places).count() == 2
