"""Exploration and quality jobs over the test tables."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.entries import on_shop, with_nulls
from tradewind.entries.views import avg, dbl, stamp, with_views
from tradewind.functions.temporal import parse_timestamp
from tradewind.operators import quality as Q
from tradewind.operators.privacy import protect_pii, read_secrets, reveal
from tradewind.operators.profiling import inclusion, outlier_rows
from tradewind.operators.upsert import insert_new
from tradewind.plans import explore as E
from tradewind.schemas import DOCUMENT_FIELDS, PRIMARY_KEYS, Reference, row_rules
from tradewind.session import workspace
from tradewind.sources.star_views import Shop

# Table -> (SQL view, {column: (SQL expression, "n" number or "t" text-like)}).
PROFILED: dict[str, tuple[str, dict[str, tuple[str, str]]]] = {
    "customer": (
        "v_customer",
        {
            "customer_id": ("customer_id", "n"),
            "customer_unique_id": ("customer_unique_id", "n"),
            "zip_code_prefix": ("zip_code_prefix", "n"),
            "customer_city": ("customer_city", "t"),
            "customer_state": ("customer_state", "t"),
        },
    ),
    "geolocation": (
        "v_geo",
        {
            "geolocation_zip_code_prefix": ("zip", "n"),
            "geolocation_lat": ("lat", "n"),
            "geolocation_lng": ("lng", "n"),
            "geolocation_city": ("city", "t"),
            "geolocation_state": ("state", "t"),
        },
    ),
    "order": (
        "v_order",
        {
            "order_id": ("order_id", "n"),
            "customer_id": ("customer_id", "n"),
            "order_status": ("order_status", "t"),
            "order_purchase_timestamp": ("ts", "t"),
            "order_delivered_customer_date": ("delivered_at", "t"),
            "order_estimated_delivery_date": ("estimated_at", "t"),
        },
    ),
    "order_item": (
        "v_item",
        {
            "order_id": ("order_id", "n"),
            "order_purchase_timestamp": ("ts", "t"),
            "shipping_limit_date": ("shipping_limit_date", "t"),
            "order_item_id": ("order_item_id", "n"),
            "product_id": ("product_id", "n"),
            "seller_id": ("seller_id", "n"),
            "price": ("price", "n"),
            "freight_value": ("freight_value", "n"),
        },
    ),
    "payment": (
        "v_payment",
        {
            "order_id": ("order_id", "n"),
            "order_purchase_timestamp": ("ts", "t"),
            "payment_sequential": ("seq", "n"),
            "payment_type": ("payment_type", "t"),
            "payment_installments": ("payment_installments", "n"),
            "payment_value": ("payment_value", "n"),
        },
    ),
    "product": (
        "v_product",
        {
            "product_id": ("product_id", "n"),
            "category_name": ("category_name", "t"),
            "name": ("name", "t"),
            "specifications": ("specifications", "t"),
            "product_weight_g": ("product_weight_g", "n"),
            "product_height_cm": ("product_height_cm", "n"),
        },
    ),
    "product_category": (
        "v_category",
        {"category_name": ("category_name", "t"), "name_english": ("name_english", "t")},
    ),
    "review": (
        "v_review",
        {
            "review_id": ("review_id", "n"),
            "order_id": ("order_id", "n"),
            "order_purchase_timestamp": ("ts", "t"),
            "review_score": ("review_score", "n"),
        },
    ),
    "seller": (
        "v_seller",
        {
            "seller_id": ("seller_id", "n"),
            "zip_code_prefix": ("zip_code_prefix", "n"),
            "seller_city": ("seller_city", "t"),
            "seller_state": ("seller_state", "t"),
        },
    ),
}


def _profiled(s: Shop) -> dict[str, DataFrame]:
    return {name: getattr(s, name).select(*columns) for name, (_, columns) in PROFILED.items()}


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


def _full(s: Shop) -> DataFrame:
    return E.orders_full(
        s.order.drop("promotion_period"),
        s.customer,
        s.payment,
        s.review,
        s.order_item,
        s.product.select("product_id", "category_name", "product_weight_g"),
        s.product_category,
        s.seller,
        s.geolocation,
    )


def _full_out(s: Shop) -> DataFrame:
    return _rounded(
        with_nulls(
            _full(s).drop("shipping_limit_date"),
            "review_id",
            "review_score",
            "order_item_id",
            "product_id",
            "seller_id",
            "product_weight_g",
            "seller_zip_code_prefix",
        ),
        9,
        "customer_geolocation_lat",
        "customer_geolocation_lng",
        "seller_geolocation_lat",
        "seller_geolocation_lng",
    )


# Table -> what is added up over its keys and over its other columns: numbers, lengths of texts, seconds of times.
_CONTENTS = {
    "customer": ("customer_id", "customer_unique_id + customer_zip_code_prefix + length(customer_city) + length(customer_state)"),
    "seller": ("seller_id", "seller_zip_code_prefix + length(seller_city) + length(seller_state)"),
    "product": ("product_id", "length(product_category_name)"),
    "product_category": ("length(product_category_name)", "length(product_category_name_english)"),
    "order": (
        "order_id",
        "customer_id + length(order_status) + unix_seconds(cast(order_purchase_timestamp as timestamp))"
        " + coalesce(unix_seconds(cast(order_delivered_customer_date as timestamp)), 0) + unix_seconds(cast(order_estimated_delivery_date as timestamp))",
    ),
    "order_item": ("order_id * 10 + order_item_id", "product_id + seller_id + price + freight_value"),
    "payment": ("order_id * 10 + payment_sequential", "length(payment_type) + payment_installments + payment_value"),
    "review": ("review_id", "order_id + review_score"),
    "geolocation": ("customer_zip_code_prefix", "customer_geolocation_lat + customer_geolocation_lng"),
}


def _decomposed(s: Shop) -> DataFrame:
    """Rows, keys and contents of the tables taken out of the fact."""
    parts = []
    for name, df in E.decompose(_full(s)).items():
        keys, contents = (F.round(F.sum(F.expr(x).cast("double")), 2) for x in _CONTENTS[name])
        parts.append(df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas"), keys.alias("claves"), contents.alias("contenido")))
    return reduce(DataFrame.unionByName, parts)


def _decomposed_sql() -> str:
    sold = "SELECT product_id FROM v_item"
    seconds = "epoch(ts) + coalesce(epoch(delivered_at), 0) + epoch(estimated_at)"
    tables = {
        "customer": ("v_customer WHERE customer_id IN (SELECT customer_id FROM v_order)", "customer_id", "customer_unique_id + zip_code_prefix + length(customer_city) + length(customer_state)"),
        "seller": ("v_seller WHERE seller_id IN (SELECT seller_id FROM v_item)", "seller_id", "zip_code_prefix + length(seller_city) + length(seller_state)"),
        "product": (f"v_product WHERE product_id IN ({sold})", "product_id", "length(category_name)"),
        "product_category": (
            f"v_category WHERE category_name IN (SELECT category_name FROM v_product WHERE product_id IN ({sold}))", "length(category_name)", "length(name_english)",
        ),
        "order": ("v_order", "order_id", f"customer_id + length(order_status) + {seconds}"),
        "order_item": (
            "(SELECT DISTINCT order_id, order_item_id, product_id, seller_id, price, freight_value FROM v_item)",
            "order_id * 10 + order_item_id",
            "product_id + seller_id + price + freight_value",
        ),
        "payment": ("v_payment", "order_id * 10 + seq", "length(payment_type) + payment_installments + payment_value"),
        "review": ("v_review", "review_id", "order_id + review_score"),
        "geolocation": ("v_zip WHERE zip IN (SELECT zip_code_prefix FROM v_customer WHERE customer_id IN (SELECT customer_id FROM v_order))", "zip", "lat + lng"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS filas, round(sum({dbl(keys)}), 2) AS claves, round(sum({dbl(contents)}), 2) AS contenido FROM {source}"
        for name, (source, keys, contents) in tables.items()
    )


def _pairs(s: Shop):
    t = _profiled(s)
    order = s.order.select("order_id", "customer_id", "order_purchase_timestamp")
    return [
        ("customer", s.customer, "order", order),
        ("order", order, "order_item", s.order_item.drop("order_purchase_timestamp")),
        ("order", order, "payment", s.payment.drop("order_purchase_timestamp")),
        ("order", order, "review", s.review.drop("order_purchase_timestamp")),
        ("order_item", s.order_item.select("product_id", "seller_id"), "product", s.product),
        ("order_item", s.order_item.select("product_id", "seller_id"), "seller", t["seller"]),
        ("product", s.product, "product_category", s.product_category),
    ]


# --- faulty inputs for the quality jobs, as projections of the tables ---


def _bad_payments(s: Shop) -> DataFrame:
    key = F.col("o_orderkey")
    return s.table("orders").select(
        key.alias("order_id"),
        F.when(F.col("o_orderpriority").startswith("5"), "cash").otherwise("credit_card").alias("payment_type"),
        (key % 7 - 1).alias("payment_installments"),
        F.when(key % 13 != 0, F.col("o_totalprice").cast("decimal(12,2)") - 100000).alias("payment_value"),
    )


_BAD_PAYMENTS = """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority LIKE '5%' THEN 'cash' ELSE 'credit_card' END AS payment_type,
           o_orderkey % 7 - 1 AS payment_installments,
           CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_totalprice AS DECIMAL(12,2)) - 100000 END AS payment_value
    FROM orders"""


def _event_documents(s: Shop) -> DataFrame:
    eid = F.col("event_id")
    when = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    kind = F.when(F.col("event_type") == "view", "product_view").when(
        F.col("event_type") == "purchase", "cart_add"
    ).otherwise(F.col("event_type"))
    parts = [
        F.concat(F.lit('"event_type":'), q(kind)),
        F.when(eid % 5 == 0, None)
        .when(eid % 7 == 0, '"session_id":null')
        .otherwise(F.concat(F.lit('"session_id":'), q(F.col("user_id").cast("string")))),
        F.concat(F.lit('"timestamp":'), F.when(eid % 11 == 0, eid.cast("string")).otherwise(q(when))),
        F.concat(F.lit('"ttl_expire":'), F.when(eid % 17 == 0, '"soon"').otherwise(q(when))),
        F.concat(F.lit('"metadata":'), F.when(eid % 13 == 0, "[1]").otherwise('{"source":"x"}')),
        F.when(eid % 3 == 0, F.concat(F.lit('"product_id":'), eid.cast("string"))),
    ]
    return s.table("events").select("event_id", F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("doc"))


def _document_report(s: Shop) -> DataFrame:
    checked = Q.validate_documents(_event_documents(s), "doc", DOCUMENT_FIELDS["event_logs"])
    return checked.select("event_id", F.array_join("violations", "; ").alias("violations"))


def _africa(s: Shop) -> DataFrame:
    return s.seller.where(F.col("seller_state") == "AFRICA")


def _versions(s: Shop) -> DataFrame:
    base = s.products_catalog.select("product_id", "name", "total_reviews")
    old = base.where(F.col("product_id") % 2 == 0).select("product_id", "name")
    new = base.where(F.col("product_id") % 2 == 1).withColumn("schema_version", F.lit(2))
    return with_nulls(Q.read_versions([old, new]), "total_reviews")


def _put(spark, path: str, content: bytes) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    stream.write(bytearray(content))
    stream.close()


def _protected(s: Shop) -> DataFrame:
    """Key and salt come from files that only this run knows; what is hidden is checked to differ before it is revealed."""
    spark = s.order.sparkSession
    folder = workspace(spark, "secrets")
    for name, size in (("key", 16), ("salt", 24)):
        _put(spark, f"{folder}/{name}", os.urandom(size))
    secrets = read_secrets(spark, f"{folder}/key", f"{folder}/salt")
    source = s.table("customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_name").alias("pseudonym"))
    hidden = protect_pii(source, secrets, ["name"], ["pseudonym"])
    shown = reveal(hidden.withColumn("cipher", F.col("name")), secrets, ["name"])
    return shown.select(
        "c_custkey",
        "name",
        (F.col("cipher") != F.col("name").cast("binary")).alias("hidden"),
        (F.length("pseudonym") == 64).alias("hashed"),
    )


QUERIES = {
    "e1_describe_tables": on_shop(
        lambda s: _rounded(
            with_nulls(E.describe_tables(_profiled(s)), "unique", "freq"),
            4,
            "mean",
            "std",
            "min",
            "q25",
            "q50",
            "q75",
            "max",
        )
    ),
    "e2_null_report": on_shop(lambda s: E.null_report(_profiled(s))),
    "e3_shared_columns": on_shop(lambda s: inclusion(_pairs(s))),
    "e4a_customers_per_state": on_shop(lambda s: E.top_values(s.customer, "customer_state")),
    "e4b_sellers_per_state": on_shop(lambda s: E.top_values(s.seller, "seller_state")),
    "e5_outliers": on_shop(
        lambda s: _rounded(E.outlier_report(_profiled(s)), 4, "lower_bound", "upper_bound")
    ),
    "q9_outlier_rows": on_shop(
        lambda s: _rounded(
            outlier_rows(s.event_logs.select("event_id", "value"), "value"),
            4,
            "lower_bound",
            "upper_bound",
        )
    ),
    "e6_orders_per_month": on_shop(lambda s: E.orders_per_month(s.order)),
    "e7a_place_per_zip_customer": on_shop(
        lambda s: _rounded(
            E.place_per_zip(s.geolocation, "customer"), 9, "customer_geolocation_lat", "customer_geolocation_lng"
        )
    ),
    "e7b_place_per_zip_seller": on_shop(
        lambda s: _rounded(
            E.place_per_zip(s.geolocation, "seller"), 9, "seller_geolocation_lat", "seller_geolocation_lng"
        )
    ),
    "e8_orders_full": on_shop(_full_out),
    "e9_largest_order": on_shop(
        lambda s: E.largest_order_rows(s.order_item).select("order_id", "item_rows", "order_item_id", "product_id", "price")
    ),
    "e10a_sales_by_state_and_payment": on_shop(
        lambda s: E.monthly_sales_by_state_and_payment(s.order, s.customer, s.payment)
    ),
    "e10b_review_score_by_category": on_shop(
        lambda s: E.review_score_by_category(s.order_item, s.product, s.review)
    ),
    "e10c_fact_sales_by_state_and_payment": on_shop(
        lambda s: E.sales_over_fact(s.order, s.customer, s.payment, s.review, s.order_item)
    ),
    "e10d_fact_review_score_by_category": on_shop(
        lambda s: E.review_scores_over_fact(s.order, s.payment, s.review, s.order_item, s.product)
    ),
    "e11_order_summary": on_shop(
        lambda s: with_nulls(
            E.order_summary(s.order.drop("promotion_period"), s.customer, s.payment, s.review), "review_id", "review_score"
        )
    ),
    "q1_duplicate_keys": on_shop(lambda s: Q.duplicate_keys(s.order_item, PRIMARY_KEYS["order_item"])),
    "q2_orphans": on_shop(
        lambda s: Q.orphans(s.order_item, s.seller.where(F.col("seller_state") != "AFRICA"), ["seller_id"]).select(
            "order_id", "order_item_id", "product_id", "seller_id", "price"
        )
    ),
    "q3a_set_null": on_shop(
        lambda s: with_nulls(
            Q.on_parent_delete(
                s.seller,
                s.zip_centroid.where(F.col("zip_code_prefix") < 5),
                Reference("seller", ["zip_code_prefix"], "geolocation", ["zip_code_prefix"], "set null"),
            ),
            "zip_code_prefix",
        )
    ),
    "q3b_cascade": on_shop(
        lambda s: Q.on_parent_delete(
            s.review,
            s.order.where(F.col("order_status") == "processing"),
            Reference("review", ["order_id"], "order", ["order_id"], "cascade"),
        )
    ),
    "q3c_restrict": on_shop(
        lambda s: Q.on_parent_delete(
            s.order_item.select("order_id", "seller_id", "price"),
            _africa(s),
            Reference("order_item", ["seller_id"], "seller", ["seller_id"], "restrict"),
        )
    ),
    "q4a_failed_rules": on_shop(
        lambda s: Q.split_valid(_bad_payments(s), row_rules("payment"))[1].withColumn(
            "failed_rules", F.array_join("failed_rules", ",")
        )
    ),
    "q4b_valid_rows": on_shop(lambda s: Q.split_valid(_bad_payments(s), row_rules("payment"))[0]),
    "q5_rule_summary": on_shop(lambda s: Q.rule_summary(_bad_payments(s), row_rules("payment"))),
    "q6_document_violations": on_shop(_document_report),
    "q7_reconcile": on_shop(
        lambda s: with_nulls(
            Q.reconcile(
                {"order": s.table("orders"), "order_item": s.table("lineitem")},
                {
                    "order": s.order,
                    "order_item": insert_new(s.order_item.where(F.lit(False)), s.order_item, PRIMARY_KEYS["order_item"]),
                    "payment": s.payment,
                },
            ),
            "source_rows",
        )
    ),
    "q8_timestamp_conversion": on_shop(
        lambda s: s.table("orders").select(
            "o_orderkey",
            parse_timestamp(
                F.when(F.col("o_orderkey") % 17 == 0, "not a date")
                .when(F.col("o_orderkey") % 19 == 0, "")
                .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            ).alias("parsed"),
        )
    ),
    "q11_dependency_violations": on_shop(
        lambda s: Q.dependency_violations(s.table("part"), ["p_name"], "p_brand")
    ),
    "q12_decompose": on_shop(_decomposed),
    "q13_read_versions": on_shop(_versions),
    "q14_protect_pii": on_shop(_protected),
}


def _describe_sql() -> str:
    parts = []
    for table, (view, columns) in PROFILED.items():
        for name, (expr, kind) in columns.items():
            head = f"SELECT '{table}' AS table_name, '{name}' AS column_name, count({expr}) AS count"
            if kind == "n":
                x = dbl(expr)
                quart = ", ".join(
                    f"round(quantile_cont({x}, {p}), 4) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75)
                )
                parts.append(
                    f"{head}, NULL::DOUBLE AS \"unique\", NULL::VARCHAR AS top, NULL::DOUBLE AS freq, "
                    f"round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, "
                    f"{quart}, round(max({x}), 4) AS max FROM {view}"
                )
            else:
                best = (
                    f"(SELECT CAST({expr} AS VARCHAR) AS v, count(*) AS n FROM {view} WHERE {expr} IS NOT NULL "
                    "GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
                )
                nulls = ", ".join(f"NULL::DOUBLE AS {c}" for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
                parts.append(
                    f"{head}, {dbl(f'count(DISTINCT {expr})')} AS \"unique\", (SELECT v FROM {best}) AS top, "
                    f"{dbl(f'(SELECT n FROM {best})')} AS freq, {nulls} FROM {view}"
                )
    return " UNION ALL ".join(parts)


def _nulls_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) - count({expr}) AS nulls FROM {view}"
        for table, (view, columns) in PROFILED.items()
        for name, (expr, _) in columns.items()
    )


def _outliers_sql() -> str:
    parts = []
    for table, (view, columns) in PROFILED.items():
        for name, (expr, kind) in columns.items():
            if kind != "n" or name in E.IDENTIFIERS:
                continue
            x = dbl(expr)
            parts.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, round(any_value(lo), 4) AS lower_bound, "
                f"round(any_value(hi), 4) AS upper_bound, count(*) FILTER (WHERE {x} < lo OR {x} > hi) AS outliers "
                f"FROM {view}, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
                f"(SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {view}))"
            )
    return " UNION ALL ".join(parts)


def _inclusion_sql() -> str:
    pairs = [
        ("customer", "v_customer", "order", "v_order", "customer_id"),
        ("order", "v_order", "order_item", "v_item", "order_id"),
        ("order", "v_order", "payment", "v_payment", "order_id"),
        ("order", "v_order", "review", "v_review", "order_id"),
        ("order_item", "v_item", "product", "v_product", "product_id"),
        ("order_item", "v_item", "seller", "v_seller", "seller_id"),
        ("product", "v_product", "product_category", "v_category", "category_name"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{left}' AS left_table, '{right}' AS right_table, '{c}' AS column_name, "
        f"(SELECT count(DISTINCT {c}) FROM {a}) AS left_values, "
        f"(SELECT count(*) FROM (SELECT {c} FROM {a} INTERSECT SELECT {c} FROM {b}) t WHERE {c} IS NOT NULL) AS matched_values"
        for left, a, right, b, c in pairs
    )


def _zip_sql(role: str) -> str:
    def mode(column: str) -> str:
        return (
            f"SELECT zip, {column} AS v FROM v_geo GROUP BY 1, 2 "
            f"QUALIFY row_number() OVER (PARTITION BY zip ORDER BY count(*) DESC, {column}) = 1"
        )

    return f"""
        SELECT g.zip AS {role}_zip_code_prefix, round(avg(lat), 9) AS {role}_geolocation_lat,
               round(avg(lng), 9) AS {role}_geolocation_lng, any_value(c.v) AS {role}_geolocation_city,
               any_value(st.v) AS {role}_geolocation_state
        FROM v_geo g JOIN ({mode('city')}) c ON c.zip = g.zip JOIN ({mode('state')}) st ON st.zip = g.zip GROUP BY 1"""


_FULL_JOIN = f"""
    FROM v_order o LEFT JOIN v_customer c ON c.customer_id = o.customer_id
    LEFT JOIN v_payment pay ON pay.order_id = o.order_id LEFT JOIN v_review r ON r.order_id = o.order_id
    LEFT JOIN v_item oi ON oi.order_id = o.order_id LEFT JOIN v_product p ON p.product_id = oi.product_id
    LEFT JOIN v_category pc ON pc.category_name = p.category_name LEFT JOIN v_seller s ON s.seller_id = oi.seller_id
    LEFT JOIN ({_zip_sql('customer')}) cg ON cg.customer_zip_code_prefix = c.zip_code_prefix
    LEFT JOIN ({_zip_sql('seller')}) sg ON sg.seller_zip_code_prefix = s.zip_code_prefix"""
_ORDER_COLUMNS = f"""
    o.order_id, o.customer_id, o.order_status, {stamp('o.ts')} AS order_purchase_timestamp,
    {stamp('o.delivered_at')} AS order_delivered_customer_date, {stamp('o.estimated_at')} AS order_estimated_delivery_date,
    pay.seq AS payment_sequential, pay.payment_type, pay.payment_installments, {dbl('pay.payment_value')} AS payment_value,
    {dbl('r.review_id')} AS review_id, {dbl('r.review_score')} AS review_score, c.customer_unique_id, c.customer_city,
    c.customer_state"""
_FULL = f"""
    SELECT {_ORDER_COLUMNS}, {dbl('oi.order_item_id')} AS order_item_id, {dbl('oi.product_id')} AS product_id,
           {dbl('oi.seller_id')} AS seller_id, {dbl('oi.price')} AS price,
           {dbl('oi.freight_value')} AS freight_value, c.zip_code_prefix AS customer_zip_code_prefix,
           p.category_name AS product_category_name, {dbl('p.product_weight_g')} AS product_weight_g,
           pc.name_english AS product_category_name_english,
           {dbl('s.zip_code_prefix')} AS seller_zip_code_prefix, s.seller_city, s.seller_state, cg.customer_geolocation_lat,
           cg.customer_geolocation_lng, cg.customer_geolocation_city, cg.customer_geolocation_state,
           sg.seller_geolocation_lat, sg.seller_geolocation_lng, sg.seller_geolocation_city, sg.seller_geolocation_state
    {_FULL_JOIN}"""

_VIOLATIONS = """
    SELECT event_id, array_to_string(list_sort(list_filter([
        CASE WHEN event_type NOT IN ('view', 'purchase') AND event_type NOT IN
             ('product_view', 'product_click', 'search', 'cart_add', 'cart_remove', 'cart_abandon', 'checkout_start',
              'category_view', 'seller_view') THEN 'event_type: not in domain' END,
        CASE WHEN event_id % 5 = 0 THEN 'session_id: missing' WHEN event_id % 7 = 0 THEN 'session_id: not string' END,
        CASE WHEN event_id % 11 = 0 THEN 'timestamp: not date' END,
        CASE WHEN event_id % 17 = 0 THEN 'ttl_expire: not date' END,
        CASE WHEN event_id % 13 = 0 THEN 'metadata: not object' END,
        CASE WHEN event_id % 3 = 0 THEN 'product_id: not string' END], lambda x: x IS NOT NULL)), '; ') AS violations
    FROM events"""

_RULES = {
    "payment_type_in_domain": "payment_type NOT IN ('credit_card', 'debit_card', 'boleto', 'voucher', 'not_defined')",
    "payment_installments_at_least_0": "payment_installments < 0",
    "payment_value_at_least_0": "payment_value < 0",
}
_FAILED = "concat_ws(',', " + ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _RULES.items()) + ")"
_PAYMENT_COLUMNS = f"order_id, payment_type, payment_installments, {dbl('payment_value')} AS payment_value"

SQL = {
    "e1_describe_tables": _describe_sql(),
    "e2_null_report": _nulls_sql(),
    "e3_shared_columns": _inclusion_sql(),
    "e4a_customers_per_state": """
        SELECT customer_state, count(*) AS count FROM v_customer GROUP BY 1 ORDER BY count DESC, customer_state LIMIT 5""",
    "e4b_sellers_per_state": """
        SELECT seller_state, count(*) AS count FROM v_seller GROUP BY 1 ORDER BY count DESC, seller_state LIMIT 5""",
    "e5_outliers": _outliers_sql(),
    "q9_outlier_rows": """
        SELECT event_id, value, round(lo, 4) AS lower_bound, round(hi, 4) AS upper_bound
        FROM v_event, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
            SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM v_event))
        WHERE value < lo OR value > hi""",
    "e6_orders_per_month": "SELECT strftime(ts, '%Y-%m') AS month, count(*) AS count FROM v_order GROUP BY 1",
    "e7a_place_per_zip_customer": _zip_sql("customer"),
    "e7b_place_per_zip_seller": _zip_sql("seller"),
    "e8_orders_full": _FULL,
    "e9_largest_order": f"""
        SELECT order_id, item_rows, order_item_id, product_id, {dbl('price')} AS price
        FROM v_item JOIN (SELECT order_id, count(*) AS item_rows FROM v_item GROUP BY 1 HAVING count(*) > 1
                          ORDER BY item_rows DESC, order_id LIMIT 1) USING (order_id)""",
    "e10a_sales_by_state_and_payment": f"""
        SELECT strftime(o.ts, '%Y-%m') AS month, customer_state, payment_type, {dbl('sum(payment_value)')} AS sales,
               count(DISTINCT o.order_id) AS orders
        FROM v_order o LEFT JOIN v_payment pay ON pay.order_id = o.order_id
        LEFT JOIN v_customer c ON c.customer_id = o.customer_id GROUP BY 1, 2, 3""",
    "e10b_review_score_by_category": f"""
        SELECT category_name AS product_category_name, {avg('sum(review_score)', 'count(review_score)')} AS avg_review_score,
               count(review_score) AS reviews
        FROM (SELECT DISTINCT oi.order_id, p.category_name FROM v_item oi JOIN v_product p USING (product_id)) x
        JOIN v_review r ON r.order_id = x.order_id GROUP BY 1""",
    "e10c_fact_sales_by_state_and_payment": f"""
        SELECT strftime(o.ts, '%Y-%m') AS month, customer_state, payment_type, {dbl('sum(payment_value)')} AS sales,
               count(DISTINCT o.order_id) AS orders {_FULL_JOIN} GROUP BY 1, 2, 3""",
    "e10d_fact_review_score_by_category": f"""
        SELECT p.category_name AS product_category_name, {avg('sum(review_score)', 'count(review_score)')} AS avg_review_score,
               count(review_score) AS reviews {_FULL_JOIN} GROUP BY 1""",
    "e11_order_summary": f"""
        SELECT {_ORDER_COLUMNS} FROM v_order o LEFT JOIN v_customer c ON c.customer_id = o.customer_id
        LEFT JOIN v_payment pay ON pay.order_id = o.order_id LEFT JOIN v_review r ON r.order_id = o.order_id""",
    "q1_duplicate_keys": """
        SELECT order_id, order_item_id, count(*) AS copies FROM v_item GROUP BY 1, 2 HAVING count(*) > 1""",
    "q2_orphans": f"""
        SELECT order_id, order_item_id, product_id, seller_id, {dbl('price')} AS price FROM v_item
        WHERE seller_id NOT IN (SELECT seller_id FROM v_seller WHERE seller_state <> 'AFRICA')""",
    "q3a_set_null": """
        SELECT seller_id, CASE WHEN zip_code_prefix >= 5 THEN CAST(zip_code_prefix AS DOUBLE) END AS zip_code_prefix,
               seller_city, seller_state
        FROM v_seller""",
    "q3b_cascade": f"""
        SELECT r.order_id, {stamp('r.ts')} AS order_purchase_timestamp, review_id, review_score
        FROM v_review r JOIN v_order o ON o.order_id = r.order_id WHERE order_status <> 'processing'""",
    "q3c_restrict": f"""
        SELECT order_id, oi.seller_id, {dbl('price')} AS price FROM v_item oi JOIN v_seller s ON s.seller_id = oi.seller_id
        WHERE seller_state = 'AFRICA'""",
    "q4a_failed_rules": f"""
        SELECT {_PAYMENT_COLUMNS}, {_FAILED} AS failed_rules FROM ({_BAD_PAYMENTS}) WHERE {_FAILED} <> ''""",
    "q4b_valid_rows": f"SELECT {_PAYMENT_COLUMNS} FROM ({_BAD_PAYMENTS}) WHERE {_FAILED} = ''",
    "q5_rule_summary": " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS rows FROM ({_BAD_PAYMENTS})"
        for name, bad in _RULES.items()
    ),
    "q6_document_violations": _VIOLATIONS,
    "q7_reconcile": """
        SELECT 'order' AS tabla, CAST((SELECT count(*) FROM orders) AS DOUBLE) AS source_rows, (SELECT count(*) FROM v_order) AS table_rows,
               true AS match
        UNION ALL
        SELECT 'order_item', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM
               (SELECT DISTINCT order_id, order_item_id FROM v_item)), (SELECT count(*) FROM lineitem) =
               (SELECT count(*) FROM (SELECT DISTINCT order_id, order_item_id FROM v_item))
        UNION ALL
        SELECT 'payment', NULL, (SELECT count(*) FROM v_payment), false""",
    "q8_timestamp_conversion": f"""
        SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0 THEN {stamp('o_orderdate')} END AS parsed
        FROM orders""",
    "q11_dependency_violations": """
        SELECT p_name, count(DISTINCT p_brand) AS "values" FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""",
    "q12_decompose": _decomposed_sql(),
    "q13_read_versions": """
        SELECT product_id, name, CASE WHEN product_id % 2 = 1 THEN CAST(total_reviews AS DOUBLE) END AS total_reviews,
               CASE WHEN product_id % 2 = 1 THEN 2 ELSE 1 END AS schema_version FROM v_catalog""",
    "q14_protect_pii": """
        SELECT c_custkey, c_name AS name, true AS hidden, true AS hashed FROM customer""",
}
SQL = {name: with_views(body) for name, body in SQL.items()}
