"""Data exploration: summaries, distributions, the wide order fact and its decomposition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import rounded_avg, rounded_ratio, weighted_sum
from tradewind.functions.temporal import month_label
from tradewind.operators import profiling
from tradewind.session import stored

# Columns that number or identify rows and are no measures.
IDENTIFIERS = [
    "order_item_id",
    "payment_sequential",
    "customer_zip_code_prefix",
    "seller_zip_code_prefix",
    "geolocation_zip_code_prefix",
]


def _per_table(tables: dict[str, DataFrame], job) -> DataFrame:
    parts = [job(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def describe_tables(tables: dict[str, DataFrame], approximate: bool = False) -> DataFrame:
    return profiling.describe_tables(tables, approximate)


def null_report(tables: dict[str, DataFrame]) -> DataFrame:
    return _per_table(tables, profiling.null_counts)


def outlier_report(
    tables: dict[str, DataFrame], exclude: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    skip = IDENTIFIERS if exclude is None else exclude
    return profiling.outliers_of_tables(tables, skip, approximate)


def top_values(df: DataFrame, column: str, top: int = 5) -> DataFrame:
    """The most frequent values, for instance the states with most customers."""
    return profiling.value_counts(df, column).limit(top)


def orders_per_month(order: DataFrame) -> DataFrame:
    return (
        order.where(F.col("order_purchase_timestamp").isNotNull())
        .groupBy(month_label("order_purchase_timestamp").alias("month"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("month")
    )


def place_per_zip(geolocation: DataFrame, role: str) -> DataFrame:
    """Mean position and most frequent city and state per zip code, named for ``customer`` or ``seller``."""
    zip_code = "geolocation_zip_code_prefix"
    spots = geolocation.groupBy(zip_code).agg(
        F.avg("geolocation_lat").alias(f"{role}_geolocation_lat"),
        F.avg("geolocation_lng").alias(f"{role}_geolocation_lng"),
    )
    names = profiling.mode_per_group(geolocation, [zip_code], ["geolocation_city", "geolocation_state"])
    return spots.join(names, zip_code).select(
        F.col(zip_code).alias(f"{role}_zip_code_prefix"),
        f"{role}_geolocation_lat",
        f"{role}_geolocation_lng",
        F.col("geolocation_city").alias(f"{role}_geolocation_city"),
        F.col("geolocation_state").alias(f"{role}_geolocation_state"),
    )


def _once(df: DataFrame, known: list[str], key: list[str]) -> DataFrame:
    """Columns of ``df`` that are new, plus the key."""
    return df.select(*key, *[c for c in df.columns if c not in known and c not in key])


def orders_full(
    order: DataFrame,
    customer: DataFrame,
    payment: DataFrame,
    review: DataFrame,
    order_item: DataFrame,
    product: DataFrame,
    product_category: DataFrame,
    seller: DataFrame,
    geolocation: DataFrame,
) -> DataFrame:
    """The wide fact: every order with each combination of its payments, reviews and items.

    Ten left joins. Dimensions are joined where their key comes from, before rows are multiplied: places and
    categories to the customers, sellers and products, these to orders and items. The order children are then
    joined one after the other on the same key, so one arrangement of the rows by order serves all of them, and
    no wide row is shuffled.
    """
    steps = {
        "payment": (payment, "order_id"),
        "review": (review, "order_id"),
        "order_item": (order_item, "order_id"),
        "customer": (
            customer.select(
                "customer_id",
                "customer_unique_id",
                F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
                "customer_city",
                "customer_state",
            ),
            "customer_id",
        ),
        "product": (product.withColumnRenamed("category_name", "product_category_name"), "product_id"),
        "product_category": (
            product_category.select(
                F.col("category_name").alias("product_category_name"),
                F.col("name_english").alias("product_category_name_english"),
            ),
            "product_category_name",
        ),
        "seller": (
            seller.select(
                "seller_id", F.col("zip_code_prefix").alias("seller_zip_code_prefix"), "seller_city", "seller_state"
            ),
            "seller_id",
        ),
        "customer_place": (place_per_zip(geolocation, "customer"), "customer_zip_code_prefix"),
        "seller_place": (place_per_zip(geolocation, "seller"), "seller_zip_code_prefix"),
    }
    # A column comes from the first table that has it; joined one after the other, keys would come to the front.
    columns, own = order.columns, {}
    for name, (table, key) in steps.items():
        own[name] = _once(table, columns, [key])
        columns = [key, *(c for c in columns if c != key), *own[name].columns[1:]]

    def with_parents(table: DataFrame, *names: str) -> DataFrame:
        for name in names:
            table = table.join(own[name], steps[name][1], "left")
        return table

    own["customer"] = with_parents(own["customer"], "customer_place")
    own["product"] = with_parents(own["product"], "product_category")
    own["seller"] = with_parents(own["seller"], "seller_place")
    own["order_item"] = with_parents(own["order_item"], "product", "seller")
    return with_parents(order, "customer", "payment", "review", "order_item").select(*columns)


ITEM_COLUMNS = ["order_item_id", "shipping_limit_date", "price", "freight_value", "product_id", "seller_id"]
FREE_TEXT = ["review_comment_title", "review_comment_message"]


def order_summary(order: DataFrame, customer: DataFrame, payment: DataFrame, review: DataFrame) -> DataFrame:
    """The slim fact for dashboards: orders with customer, payments and reviews, no free text."""
    who = customer.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    fact = order
    for table, key in ((payment, "order_id"), (review.drop(*FREE_TEXT), "order_id"), (who, "customer_id")):
        fact = fact.join(_once(table, fact.columns, [key]), key, "left")
    return fact


def monthly_sales_by_state_and_payment(
    order: DataFrame, customer: DataFrame, payment: DataFrame
) -> DataFrame:
    """Payment value per month, customer state and payment type."""
    return (
        order.select("order_id", "customer_id", month_label("order_purchase_timestamp").alias("month"))
        .join(payment.select("order_id", "payment_type", "payment_value"), "order_id", "left")
        .join(customer.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("month", "customer_state", "payment_type")
        .agg(F.sum("payment_value").alias("sales"), F.count_distinct("order_id").alias("orders"))
    )


def fact_sales_by_state_and_payment(fact: DataFrame) -> DataFrame:
    """The same report taken straight from the wide fact: a payment counts once per row it occurs in."""
    return fact.groupBy(
        month_label("order_purchase_timestamp").alias("month"), "customer_state", "payment_type"
    ).agg(F.sum("payment_value").alias("sales"), F.count_distinct("order_id").alias("orders"))


def fact_review_score_by_category(fact: DataFrame) -> DataFrame:
    """Average review score per category over the rows of the wide fact."""
    return fact.groupBy("product_category_name").agg(
        rounded_avg(F.col("review_score").cast("long")).alias("avg_review_score"),
        F.count("review_score").alias("reviews"),
    )


def _per_order(child: DataFrame, name: str) -> DataFrame:
    return child.groupBy("order_id").agg(F.count(F.lit(1)).alias(name))


def sales_over_fact(
    order: DataFrame, customer: DataFrame, payment: DataFrame, review: DataFrame, order_item: DataFrame
) -> DataFrame:
    """``fact_sales_by_state_and_payment`` without building the fact.

    A payment stands in the fact once for every combination of its order's reviews and items: their numbers enter as a
    weight, so an order costs the sum of its children and not their product.
    """
    times = F.coalesce("n_reviews", F.lit(1)) * F.coalesce("n_items", F.lit(1))
    return (
        order.select("order_id", "customer_id", month_label("order_purchase_timestamp").alias("month"))
        .join(payment.select("order_id", "payment_type", "payment_value"), "order_id", "left")
        .join(_per_order(review, "n_reviews"), "order_id", "left")
        .join(_per_order(order_item, "n_items"), "order_id", "left")
        .join(customer.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("month", "customer_state", "payment_type")
        .agg(weighted_sum(F.col("payment_value"), times).alias("sales"), F.count_distinct("order_id").alias("orders"))
    )


def review_scores_over_fact(
    order: DataFrame, payment: DataFrame, review: DataFrame, order_item: DataFrame, product: DataFrame
) -> DataFrame:
    """``fact_review_score_by_category`` without building the fact: payments and reviews of an order as weights."""
    scores = review.groupBy("order_id").agg(
        F.count("review_score").alias("n_scores"), F.sum(F.col("review_score").cast("long")).alias("sum_scores")
    )
    times = F.coalesce("n_payments", F.lit(1))
    return (
        order.select("order_id")
        .join(_per_order(payment, "n_payments"), "order_id", "left")
        .join(scores, "order_id", "left")
        .join(order_item.select("order_id", "product_id"), "order_id", "left")
        .join(product.select("product_id", F.col("category_name").alias("product_category_name")), "product_id", "left")
        .groupBy("product_category_name")
        .agg(
            rounded_ratio(F.sum(F.col("sum_scores") * times), F.sum(F.col("n_scores") * times)).alias("avg_review_score"),
            F.coalesce(F.sum(F.col("n_scores") * times), F.lit(0)).alias("reviews"),
        )
    )


def review_score_by_category(order_item: DataFrame, product: DataFrame, review: DataFrame) -> DataFrame:
    """Average review score per product category, over distinct pairs of order and category.

    An order counts once per category, however many of its items fall into it.
    """
    pairs = (
        order_item.select("order_id", "product_id")
        .join(product.select("product_id", F.col("category_name").alias("product_category_name")), "product_id")
        .select("order_id", "product_category_name")
        # dealt before they are made distinct: few pairs of a task are equal, and a table of them beside the join's sort takes memory
        .repartition("order_id", "product_category_name")
        .distinct()
    )
    return (
        pairs.join(review.select("order_id", "review_score"), "order_id")
        .groupBy("product_category_name")
        .agg(
            rounded_avg(F.col("review_score").cast("long")).alias("avg_review_score"),
            F.count("review_score").alias("reviews"),
        )
    )


def largest_order_rows(order_item: DataFrame, key: str = "order_id") -> DataFrame:
    """All rows of the order with most item rows: what repeats in a table that is not normalised."""
    largest = (
        order_item.groupBy(key)
        .agg(F.count(F.lit(1)).alias("item_rows"))
        .where(F.col("item_rows") > 1)
        .orderBy(F.col("item_rows").desc(), key)
        .limit(1)
    )
    return order_item.join(F.broadcast(largest), key)


# Table -> (key, other columns) of the normalised model, as taken out of the wide fact.
DECOMPOSITION: dict[str, tuple[list[str], list[str]]] = {
    "customer": (["customer_id"], ["customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"]),
    "seller": (["seller_id"], ["seller_zip_code_prefix", "seller_city", "seller_state"]),
    "product": (["product_id"], ["product_category_name"]),
    "product_category": (["product_category_name"], ["product_category_name_english"]),
    "order": (
        ["order_id"],
        [
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ],
    ),
    "order_item": (["order_id", "order_item_id"], ["product_id", "seller_id", "price", "freight_value"]),
    "payment": (["order_id", "payment_sequential"], ["payment_type", "payment_installments", "payment_value"]),
    "review": (["review_id"], ["order_id", "review_score"]),
    "geolocation": (
        ["customer_zip_code_prefix"],
        [
            "customer_geolocation_lat",
            "customer_geolocation_lng",
            "customer_geolocation_city",
            "customer_geolocation_state",
        ],
    ),
}


def tagged_rows(fact: DataFrame) -> DataFrame:
    """``table_name`` and the columns of every table of the decomposition, NULL where a row's table has no such column.

    One pass turns a row of the fact into one row for each table whose key it has; equal rows fall together in every task, then in
    one shuffle for all tables. Where a key has several different rows (a broken dependency) all of them are kept, so
    that nothing is lost silently; see ``duplicate_keys``.
    """
    layout = {name: [c for c in [*key, *others] if c in fact.columns] for name, (key, others) in DECOMPOSITION.items()}
    columns = sorted({c for own in layout.values() for c in own})
    entries = []
    for name, (key, _) in DECOMPOSITION.items():
        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
        fields = [(F.col(c) if c in layout[name] else F.lit(None).cast(fact.schema[c].dataType)).alias(c) for c in columns]
        entries.append(F.when(present, F.struct(F.lit(name).alias("table_name"), *fields)))
    return fact.select(F.inline(F.array_compact(F.array(*entries)))).distinct()


def _taken_out(fact: DataFrame, name: str) -> DataFrame:
    """The distinct rows of one table of the decomposition, from its own columns of the fact alone.

    Where a key has several different rows (a broken dependency) all of them are kept, so that nothing is lost
    silently; see ``duplicate_keys``.
    """
    key, others = DECOMPOSITION[name]
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return fact.where(present).select(*[c for c in [*key, *others] if c in fact.columns]).distinct()


def decompose(fact: DataFrame) -> dict[str, DataFrame]:
    """The wide fact back into its normalised tables, one row per key, written to the shared folder.

    The fact is built and written once, in columns; a table reads its own columns and makes them distinct, so neither
    tasks nor shuffles hold rows of all tables.
    """
    wide = stored(fact, "fact")
    return {name: stored(_taken_out(wide, name), f"decomposed-{name}") for name in DECOMPOSITION}


def row_digests(rows: DataFrame, key: str = "table_name") -> DataFrame:
    """Rows and two digests of their contents for each key; equal for equal bags of rows in any order."""
    content = [c for c in rows.columns if c != key]
    a, b = F.xxhash64(*content), F.xxhash64(F.lit(1), *content)
    return rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor(a).alias("mixed"), F.sum(b.cast("decimal(20,0)")).alias("total")
    )
