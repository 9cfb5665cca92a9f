"""Relational reports.

Several reports are defined over joins that multiply rows: every item of an order meets every review
of that order. The multiplied rows are never built here. Reviews are first reduced to one row per
order (how many, how many scored, sum of scores), so each item keeps exactly one row and the
multiplicity enters the sums as a weight. The figures are those of the multiplied join, and an order
with very many items and reviews costs their sum, not their product.

Dimension attributes (seller city, category name, customer state) are joined after the aggregation
wherever the grouping key allows it, so that a key holding a large share of the items is combined
before it meets the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import ranges, temporal, text
from tradewind.functions.documents import as_variant, contains_json, text_at
from tradewind.functions.geo import distance_km, point
from tradewind.functions.numeric import percent, rounded_avg, rounded_ratio, weighted_sum
from tradewind.functions.temporal import YEAR_COLUMN

ORDER_KEY = ["order_id", "order_purchase_timestamp"]
DELIVERED = "delivered"


def delivered(order: DataFrame) -> DataFrame:
    return order.where(F.col("order_status") == DELIVERED)


def late(order: DataFrame) -> DataFrame:
    """Delivered after the estimated date."""
    return delivered(order).where(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))


def reviews_per_order(review: DataFrame, keys: list[str]) -> DataFrame:
    """One row per order: number of reviews, of named reviews, of scores, and the sum of scores."""
    return review.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_reviews"),
        F.count("review_id").alias("n_named"),
        F.count("review_score").alias("n_scores"),
        F.sum(F.col("review_score").cast("long")).alias("sum_scores"),
    )


def delivered_items(order: DataFrame, order_item: DataFrame, *columns: str) -> DataFrame:
    """Items of delivered orders, joined on both parts of the order key."""
    return delivered(order).select(*ORDER_KEY, *columns).join(order_item, ORDER_KEY)


def _multiplicity() -> Column:
    """Rows an item contributes to a left join with the reviews of its order."""
    return F.coalesce(F.col("n_reviews"), F.lit(1))


def _distinct(column: str, approximate: bool) -> Column:
    """Distinct count; the approximate one keeps a bounded sketch per group and shuffles no values."""
    return F.approx_count_distinct(column, 0.01) if approximate else F.count_distinct(column)


def _avg_review(digits: int = 2) -> Column:
    return rounded_ratio(F.sum("sum_scores"), F.sum("n_scores"), digits)


# --- order level -----------------------------------------------------------------------------------


def order_detail(
    order: DataFrame,
    customer: DataFrame,
    order_item: DataFrame,
    product: DataFrame,
    product_category: DataFrame,
    payment: DataFrame,
    order_id,
    customer_key: str = "customer_id",
) -> DataFrame:
    """Every item of one order with every payment of it.

    ``customer_key`` names the customer column that ``order.customer_id`` refers to.
    """
    # The id is applied to each child as well: it is the join key, so only one order's rows move.
    pick = F.col("order_id") == order_id
    who = customer.select(F.col(customer_key).alias("_who"))
    return (
        order.where(pick)
        .join(who, F.col("customer_id") == F.col("_who"))
        .drop("customer_id")
        .withColumnRenamed("_who", customer_key)
        .join(order_item.where(pick).drop("order_purchase_timestamp"), "order_id")
        .join(product.select("product_id", "category_name"), "product_id")
        .join(product_category.select("category_name", F.col("name_english").alias("category")), "category_name")
        .join(payment.where(pick).drop("order_purchase_timestamp"), "order_id")
        .select(
            "order_id",
            customer_key,
            "order_status",
            "order_purchase_timestamp",
            "order_item_id",
            "product_id",
            "category",
            "price",
            "freight_value",
            "payment_type",
            "payment_installments",
            "payment_value",
        )
    )


def customer_order_history(
    order: DataFrame, order_item: DataFrame, payment: DataFrame, customer_id
) -> DataFrame:
    """Items and payments of one customer's orders, newest first."""
    return (
        order.where(F.col("customer_id") == customer_id)
        .select(*ORDER_KEY, "order_status")
        .join(order_item, ORDER_KEY)
        .join(payment, ORDER_KEY)
        .orderBy(
            F.col("order_purchase_timestamp").desc_nulls_first(), "order_id", "order_item_id", "payment_sequential"
        )
        .select(
            *ORDER_KEY,
            "order_status",
            "price",
            "freight_value",
            "payment_type",
            "payment_installments",
            "payment_value",
        )
    )


# --- sales -----------------------------------------------------------------------------------------


def sales_by_category(
    order: DataFrame,
    order_item: DataFrame,
    product: DataFrame,
    product_category: DataFrame,
    review: DataFrame,
    start: str,
    end: str,
    approximate_distinct: bool = False,
) -> DataFrame:
    """Orders, revenue and review score per category; children are joined on the order id alone."""
    chosen = temporal.half_open(delivered(order), "order_purchase_timestamp", start, end).select("order_id")
    named = product.select("product_id", "category_name").join(
        product_category.select("category_name", F.col("name_english").alias("category")), "category_name"
    )
    rows = (
        chosen.join(order_item.select("order_id", "product_id", "price"), "order_id")
        .join(reviews_per_order(review, ["order_id"]), "order_id", "left")
        .join(named.select("product_id", "category"), "product_id")
    )
    return (
        rows.groupBy("category")
        .agg(
            _distinct("order_id", approximate_distinct).alias("total_orders"),
            weighted_sum(F.col("price"), _multiplicity()).alias("gross_revenue"),
            _avg_review().alias("avg_score"),
        )
        .orderBy(F.col("gross_revenue").desc_nulls_first(), "category")
    )


def _month_totals(rows: DataFrame, month: str) -> DataFrame:
    return rows.groupBy(F.date_trunc("month", "order_purchase_timestamp").alias(month))


def monthly_sales_trend(
    order: DataFrame,
    order_item: DataFrame,
    start: str | None = None,
    end: str | None = None,
    approximate_distinct: bool = False,
) -> DataFrame:
    """Orders, revenue, freight and average order value per month; without bounds all months."""
    picked = order
    if start is not None and end is not None:
        picked = temporal.half_open(order, "order_purchase_timestamp", start, end)
    return (
        _month_totals(delivered_items(picked, order_item), "month")
        .agg(
            _distinct("order_id", approximate_distinct).alias("total_orders"),
            F.sum("price").alias("gross_revenue"),
            F.sum("freight_value").alias("total_freight"),
        )
        .withColumn("avg_order_value", rounded_ratio(F.col("gross_revenue"), F.col("total_orders")))
        .orderBy("month")
    )


def monthly_revenue(order: DataFrame, order_item: DataFrame, start: str, end: str) -> DataFrame:
    """Revenue and freight share per month over a closed range of timestamps."""
    picked = temporal.closed(order, "order_purchase_timestamp", start, end)
    return (
        _month_totals(delivered_items(picked, order_item), "mes")
        .agg(
            F.sum("price").alias("ingreso_bruto"),
            F.sum("freight_value").alias("flete_total"),
            F.count_distinct("order_id").alias("total_pedidos"),
        )
        .withColumn("pct_flete", percent(F.col("flete_total"), F.col("ingreso_bruto")))
        .orderBy("mes")
    )


# --- sellers ---------------------------------------------------------------------------------------


def _seller_report(
    seller: DataFrame, order_item: DataFrame, order: DataFrame, review: DataFrame, top: int, weight: Column
) -> DataFrame:
    rows = delivered_items(order, order_item).join(reviews_per_order(review, ORDER_KEY), ORDER_KEY, "left")
    freight_rows = F.when(F.col("freight_value").isNotNull(), weight)
    totals = rows.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        weighted_sum(F.col("price"), weight).alias("total_revenue"),
        rounded_ratio(weighted_sum(F.col("freight_value"), weight), F.sum(freight_rows)).alias("avg_freight"),
        _avg_review().alias("avg_review"),
    )
    return (
        seller.select("seller_id", "seller_city", "seller_state")
        .join(totals, "seller_id")
        .select(
            "seller_id", "seller_city", "seller_state", "total_orders", "total_revenue", "avg_freight", "avg_review"
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "seller_id")
        .limit(top)
    )


def seller_performance(
    seller: DataFrame, order_item: DataFrame, order: DataFrame, review: DataFrame, top: int = 20
) -> DataFrame:
    """Best sellers by revenue, where an item counts once per review of its order."""
    return _seller_report(seller, order_item, order, review, top, _multiplicity())


def seller_performance_once(
    seller: DataFrame, order_item: DataFrame, order: DataFrame, review: DataFrame, top: int = 20
) -> DataFrame:
    """Best sellers by revenue, where an item counts once; the review score is weighted as above."""
    return _seller_report(seller, order_item, order, review, top, F.lit(1))


def late_deliveries(
    order: DataFrame,
    order_item: DataFrame,
    seller: DataFrame,
    start: str | None = None,
    end: str | None = None,
    top: int = 50,
) -> DataFrame:
    """Latest deliveries per item, longest delay first."""
    picked = late(order)
    if start is not None and end is not None:
        picked = temporal.half_open(picked, "order_purchase_timestamp", start, end)
    delay = F.col("order_delivered_customer_date") - F.col("order_estimated_delivery_date")
    return (
        picked.select(
            *ORDER_KEY,
            "order_estimated_delivery_date",
            "order_delivered_customer_date",
            delay.alias("days_late"),
        )
        .join(order_item.select(*ORDER_KEY, "seller_id"), ORDER_KEY)
        .join(seller.select("seller_id", "seller_city", "seller_state"), "seller_id")
        .drop("seller_id")
        .orderBy(F.col("days_late").desc_nulls_first(), "order_id", "seller_city", "seller_state")
        .limit(top)
    )


def late_deliveries_by_state(order: DataFrame, order_item: DataFrame, seller: DataFrame) -> DataFrame:
    """Late items and mean delay in days per seller state."""
    delay = temporal.micros_between(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    per_seller = (
        late(order)
        .select(*ORDER_KEY, delay.alias("micros"))
        .join(order_item.select(*ORDER_KEY, "seller_id"), ORDER_KEY)
        .groupBy("seller_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("micros").cast("decimal(20,0)")).alias("micros"))
    )
    day = F.lit(86_400_000_000).cast("decimal(12,0)")
    days = F.sum("micros").cast("decimal(30,0)") / F.sum("n").cast("decimal(19,0)") / day
    return (
        per_seller.join(seller.select("seller_id", "seller_state"), "seller_id")
        .groupBy("seller_state")
        .agg(F.sum("n").alias("late_deliveries"), F.round(days, 2).alias("avg_days_late"))
        .orderBy(F.col("late_deliveries").desc_nulls_first(), "seller_state")
    )


# --- payments and products -------------------------------------------------------------------------


def payment_method_analysis(payment: DataFrame, order: DataFrame) -> DataFrame:
    """Orders, payments, value and instalments per payment type, delivered orders only.

    The status filter reaches the scan of the orders by itself, so a version that filters the orders
    in a sub-query first is the same plan.
    """
    rows = payment.join(delivered(order).select(*ORDER_KEY), ORDER_KEY)
    return (
        rows.groupBy("payment_type")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.count(F.lit(1)).alias("total_payments"),
            F.sum("payment_value").alias("total_value"),
            rounded_avg("payment_value").alias("avg_payment"),
            rounded_avg(F.col("payment_installments").cast("long"), 1).alias("avg_installments"),
        )
        .orderBy(F.col("total_value").desc_nulls_first(), "payment_type")
    )


def _product_reviews(
    product: DataFrame,
    product_category: DataFrame,
    order_item: DataFrame,
    order: DataFrame,
    review: DataFrame,
    how: str,
    weight: Column,
    min_reviews: int,
    top: int,
) -> DataFrame:
    rows = delivered_items(order, order_item).join(reviews_per_order(review, ORDER_KEY), ORDER_KEY, how)
    totals = (
        rows.groupBy("product_id")
        .agg(
            F.coalesce(F.sum("n_named"), F.lit(0)).alias("review_count"),
            _avg_review().alias("avg_score"),
            weighted_sum(F.col("price"), weight).alias("total_sales"),
        )
        .where(F.col("review_count") >= min_reviews)
    )
    named = product.select("product_id", "category_name").join(
        product_category.select("category_name", F.col("name_english").alias("category")), "category_name"
    )
    return (
        totals.join(named, "product_id")
        .select("product_id", "category", "review_count", "avg_score", "total_sales")
        .orderBy(F.col("avg_score").asc_nulls_last(), "product_id")
        .limit(top)
    )


def worst_reviewed_products(
    product: DataFrame,
    product_category: DataFrame,
    order_item: DataFrame,
    order: DataFrame,
    review: DataFrame,
    min_reviews: int = 5,
    top: int = 20,
) -> DataFrame:
    """Lowest scores first; only reviewed orders count, sales once per review."""
    return _product_reviews(
        product, product_category, order_item, order, review, "inner", F.col("n_reviews"), min_reviews, top
    )


def worst_reviewed_products_once(
    product: DataFrame,
    product_category: DataFrame,
    order_item: DataFrame,
    order: DataFrame,
    review: DataFrame,
    min_reviews: int = 5,
    top: int = 20,
) -> DataFrame:
    """As above, but sales count every delivered item once."""
    return _product_reviews(
        product, product_category, order_item, order, review, "left", F.lit(1), min_reviews, top
    )


def worst_reviewed_products_outer(
    product: DataFrame,
    product_category: DataFrame,
    order_item: DataFrame,
    order: DataFrame,
    review: DataFrame,
    min_reviews: int = 5,
    top: int = 20,
) -> DataFrame:
    """As the first form, but items of delivered orders without a review also count in the sales."""
    return _product_reviews(
        product, product_category, order_item, order, review, "left", _multiplicity(), min_reviews, top
    )


# --- customers -------------------------------------------------------------------------------------


def _customers(customer: DataFrame, customer_key: str, *columns: str) -> DataFrame:
    """Customer rows per key and attributes, with the number of equal rows."""
    return customer.groupBy(F.col(customer_key).alias("customer_key"), *columns).agg(
        F.count(F.lit(1)).alias("copies")
    )


def top_customers(
    customer: DataFrame, order: DataFrame, order_item: DataFrame, customer_key: str = "customer_id", top: int = 20
) -> DataFrame:
    """Customers by spend. A customer is combined to one row before the customer table is joined."""
    spend = (
        delivered_items(order, order_item, "customer_id")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("price").alias("total_spent"),
            F.max("order_purchase_timestamp").alias("last_order"),
        )
    )
    who = _customers(customer, customer_key, "customer_city", "customer_state")
    return (
        spend.join(who, F.col("customer_id") == F.col("customer_key"))
        .select(
            F.col("customer_key").alias(customer_key),
            "customer_city",
            "customer_state",
            "total_orders",
            (F.col("total_spent").cast("decimal(26,2)") * F.col("copies").cast("decimal(12,0)")).alias("total_spent"),
            "last_order",
        )
        .orderBy(F.col("total_spent").desc_nulls_first(), customer_key, "customer_city", "customer_state")
        .limit(top)
    )


def geographic_distribution(
    customer: DataFrame,
    order: DataFrame,
    order_item: DataFrame,
    review: DataFrame,
    seller: DataFrame,
    customer_key: str = "customer_id",
    approximate_distinct: bool = False,
) -> DataFrame:
    """Orders, revenue, review score and active sellers per customer state."""
    who = _customers(customer, customer_key, "customer_state")
    known = seller.select("seller_id", F.col("seller_id").alias("matched_seller"))
    rows = (
        delivered_items(order, order_item.select(*ORDER_KEY, "seller_id", "price"), "customer_id")
        .join(reviews_per_order(review, ORDER_KEY), ORDER_KEY, "left")
        .join(who, F.col("customer_id") == F.col("customer_key"))
        .join(known, "seller_id", "left")
    )
    copies = F.col("copies")
    # rows lie by order already: one row per order and state first, then orders are counted and sellers told apart
    per_order = rows.groupBy("customer_state", "order_id").agg(
        weighted_sum(F.col("price"), _multiplicity() * copies).alias("revenue"),
        F.sum(F.col("sum_scores") * copies).alias("sum_scores"),
        F.sum(F.col("n_scores") * copies).alias("n_scores"),
        F.collect_set("matched_seller").alias("sellers"),
    )
    distinct = per_order.select("customer_state", F.explode("sellers").alias("matched_seller"))
    if not approximate_distinct:
        distinct = distinct.distinct()
    counted = F.approx_count_distinct("matched_seller", 0.01) if approximate_distinct else F.count("matched_seller")
    active = distinct.groupBy(F.col("customer_state").alias("of_state")).agg(counted.alias("unique_sellers"))
    return (
        per_order.groupBy("customer_state")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
            rounded_ratio(F.sum("sum_scores"), F.sum("n_scores")).alias("avg_review"),
        )
        .join(active, F.col("customer_state").eqNullSafe(F.col("of_state")), "left")
        .select(
            "customer_state",
            "total_orders",
            "total_revenue",
            "avg_review",
            F.coalesce("unique_sellers", F.lit(0)).cast("long").alias("unique_sellers"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first(), "customer_state")
    )


# --- nested columns, ranges, fuzzy text, places ----------------------------------------------------


def products_with_specs(product: DataFrame, pattern: str | dict, top: int = 20) -> DataFrame:
    """Products whose specifications contain a JSON document."""
    specs = F.col("specifications")
    if product.schema["specifications"].dataType.typeName() == "string":
        specs = as_variant(specs)
    return (
        product.withColumn("_specs", specs)
        .where(contains_json(F.col("_specs"), pattern))
        .select(
            "product_id",
            "category_name",
            "product_weight_g",
            text_at(F.col("_specs"), "$.material").alias("material"),
            text_at(F.col("_specs"), "$.voltagem").alias("voltagem"),
        )
        .orderBy("product_id")
        .limit(top)
    )


def promotions_in_window(order: DataFrame, start: str, end: str, top: int | None = 5) -> DataFrame:
    """Orders whose promotion period overlaps ``[start, end)``."""
    kind = order.schema["promotion_period"].dataType["lower"].dataType
    window = ranges.make_range(F.lit(start).cast(kind), F.lit(end).cast(kind))
    hits = (
        order.where(ranges.overlaps(F.col("promotion_period"), window))
        .select("order_id", "order_status", "promotion_period")
        .orderBy("order_id")
    )
    return hits if top is None else hits.limit(top)


def city_search(seller: DataFrame, fragment: str, term: str, top: int = 10) -> DataFrame:
    """Seller cities containing a fragment, most similar to a term first."""
    return (
        seller.where(F.col("seller_city").ilike(f"%{fragment}%"))
        .select(
            "seller_city",
            "seller_state",
            text.similarity(F.col("seller_city"), F.lit(term)).alias("similitud"),
        )
        .orderBy(F.col("similitud").desc_nulls_first(), "seller_city", "seller_state")
        .limit(top)
    )


def category_search(product_category: DataFrame, term: str, threshold: float = 0.3, top: int = 5) -> DataFrame:
    """Category names at least as similar to a term as the threshold, best first."""
    return (
        product_category.select("name_english", text.similarity(F.col("name_english"), F.lit(term)).alias("sim"))
        .where(F.col("sim") >= threshold)
        .orderBy(F.col("sim").desc(), "name_english")
        .limit(top)
    )


def customer_geo(customer: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Customers with the position of their zip code."""
    spot = geolocation.select("zip_code_prefix", point("longitude", "latitude").alias("location"))
    return customer.join(spot, "zip_code_prefix", "left").select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "customer_city", "customer_state", "location"
    )


def seller_geo(seller: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Sellers with the position of their zip code."""
    spot = geolocation.select("zip_code_prefix", point("longitude", "latitude").alias("location"))
    return seller.join(spot, "zip_code_prefix", "left").select(
        "seller_id", "zip_code_prefix", "seller_city", "seller_state", "location"
    )


def shipping_distances(
    order: DataFrame, order_item: DataFrame, customer: DataFrame, seller: DataFrame, geolocation: DataFrame
) -> DataFrame:
    """Items shipped per pair of zip codes, with the great-circle distance.

    Items are combined per pair of zip codes first, so a distance is computed once per pair.
    """
    ids = ["order_id", "customer_id", "seller_id"]
    pairs = (
        order.select(*ORDER_KEY, "customer_id")
        .join(order_item.select(*ORDER_KEY, "seller_id"), ORDER_KEY)
        .select(*ids)
        .join(customer.select("customer_id", F.col("zip_code_prefix").alias("customer_zip")), "customer_id")
        .join(seller.select("seller_id", F.col("zip_code_prefix").alias("seller_zip")), "seller_id")
        .groupBy("customer_zip", "seller_zip")
        .agg(F.count(F.lit(1)).alias("items"))
    )
    spot = point("longitude", "latitude")
    buyers = geolocation.select(F.col("zip_code_prefix").alias("customer_zip"), spot.alias("buyer"))
    makers = geolocation.select(F.col("zip_code_prefix").alias("seller_zip"), spot.alias("maker"))
    return (
        pairs.join(buyers, "customer_zip")
        .join(makers, "seller_zip")
        .select("customer_zip", "seller_zip", "items", distance_km(F.col("buyer"), F.col("maker")).alias("distance_km"))
    )


# --- storage reports -------------------------------------------------------------------------------


def partition_summary(order: DataFrame) -> DataFrame:
    """Rows and first and last day per purchase year."""
    year = F.col(YEAR_COLUMN) if YEAR_COLUMN in order.columns else F.year("order_purchase_timestamp")
    return (
        order.groupBy(year.alias(YEAR_COLUMN))
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.to_date(F.min("order_purchase_timestamp")).alias("fecha_min"),
            F.to_date(F.max("order_purchase_timestamp")).alias("fecha_max"),
        )
        .orderBy(YEAR_COLUMN)
    )


def range_summary(order: DataFrame, start: str, end: str) -> DataFrame:
    """Rows and first and last day in a closed range; on the partitioned layout only its years are read."""
    return temporal.closed(order, "order_purchase_timestamp", start, end).agg(
        F.count(F.lit(1)).alias("filas"),
        F.to_date(F.min("order_purchase_timestamp")).alias("fecha_min"),
        F.to_date(F.max("order_purchase_timestamp")).alias("fecha_max"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table, sorted by name."""
    counts = [df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).orderBy("tabla")


def counts_side_by_side(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with one count column per table."""
    rows = row_counts(tables)
    return rows.agg(*[F.max(F.when(F.col("tabla") == name, F.col("filas"))).alias(name) for name in tables])
