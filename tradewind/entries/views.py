"""The shop views in DuckDB SQL, written independently of the Spark ones."""

from __future__ import annotations

import re

VIEWS = {
    "v_order": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
               o_orderdate AS ts,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (5 + o_orderkey % 30) * INTERVAL '1' DAY END AS delivered_at,
               o_orderdate + INTERVAL '20' DAY AS estimated_at,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate - (o_orderkey % 10) * INTERVAL '1' DAY END AS promo_lower,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL '5' DAY END AS promo_upper
        FROM orders""",
    "v_item": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, o_orderdate AS ts, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_payment": """
        SELECT o_orderkey AS order_id, o_orderdate AS ts, 1 AS seq,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card' WHEN '3' THEN 'boleto'
                    WHEN '4' THEN 'not_defined' ELSE 'voucher' END AS payment_type,
               1 + o_orderkey % 10 AS payment_installments, CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
        FROM orders
        UNION ALL
        SELECT o_orderkey, o_orderdate, 2, 'voucher', 1, CAST(5 AS DECIMAL(12,2)) FROM orders WHERE o_orderkey % 11 = 0""",
    "v_review": """
        SELECT o_orderkey AS review_id, o_orderkey AS order_id, o_orderdate AS ts, 1 + (o_orderkey * 7) % 5 AS review_score
        FROM orders WHERE o_orderkey % 9 <> 0
        UNION ALL
        SELECT o_orderkey + 1000000, o_orderkey, o_orderdate, 1 FROM orders WHERE o_orderkey % 13 = 0""",
    "v_customer": """
        SELECT c_custkey AS customer_id, c_custkey + 10000000 AS customer_unique_id, c_nationkey AS zip_code_prefix,
               n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_seller": """
        SELECT s_suppkey AS seller_id, s_nationkey AS zip_code_prefix, n_name AS seller_city, r_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_product": """
        SELECT p_partkey AS product_id, p_type AS category_name, p_name AS name, p_size * 100 AS product_weight_g,
               p_size AS product_height_cm,
               CASE WHEN p_size % 2 = 0 THEN '{"voltagem":"110V","material":"' || p_brand || '"}'
                    ELSE '{"voltagem":"220V"}' END AS specifications,
               string_split(p_name, ' ') AS tags
        FROM part""",
    "v_category": "SELECT DISTINCT p_type AS category_name, lower(p_type) AS name_english FROM part",
    "v_geo": """
        SELECT c_nationkey AS zip, -30.0::DOUBLE + c_nationkey + (c_custkey % 10) * 0.01::DOUBLE AS lat,
               -70.0::DOUBLE + c_nationkey * 1.5::DOUBLE + (c_custkey % 7) * 0.01::DOUBLE AS lng,
               n_name || CASE WHEN c_custkey % 4 = 0 THEN '_B' ELSE '' END AS city, r_name AS state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_zip": """
        SELECT zip, CAST(sum(CAST(lat AS DECIMAL(9,6))) AS DOUBLE) / count(*) AS lat,
               CAST(sum(CAST(lng AS DECIMAL(9,6))) AS DOUBLE) / count(*) AS lng
        FROM v_geo GROUP BY zip""",
    "v_catalog": """
        SELECT p_partkey AS product_id, p_type AS product_category_name, lower(p_type) AS category_name_english,
               p_name AS name, p_name || ' ' || p_brand || ' ' || p_type AS description,
               p_size * 100 AS product_weight_g, p_size AS product_height_cm,
               string_split(p_name, ' ') AS tags, ((p_partkey * 7) % 51) / 10.0::DOUBLE AS avg_review_score,
               p_partkey % 100 AS total_reviews
        FROM part""",
    "v_event": """
        SELECT event_id,
               CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'product_click' WHEN 'purchase' THEN 'cart_add'
                    WHEN 'signup' THEN 'search' WHEN 'error' THEN 'cart_abandon' END AS event_type,
               user_id AS customer_unique_id, user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, p_type AS category,
               ts, ts + INTERVAL '90' DAY AS ttl_expire, value
        FROM events LEFT JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)""",
    "v_session": """
        SELECT 'sess_' || event_id AS id, user_id AS customer_unique_id, ts AS created_at,
               ts + INTERVAL '24' HOUR AS expires_at,
               CASE WHEN event_type = 'purchase' THEN event_id % 4 ELSE 0 END AS n_lines
        FROM events""",
    "v_line": """
        SELECT 'sess_' || event_id AS id, i AS line,
               (CAST(json_extract_string(props, '$.k') AS BIGINT) + 7 * i) % 100 AS product_id,
               1 + (event_id + i) % 3 AS quantity, CAST(value AS DECIMAL(10,2)) AS unit_price
        FROM events CROSS JOIN (VALUES (0), (1), (2)) t(i)
        WHERE event_type = 'purchase' AND i < event_id % 4""",
}

_NAME = re.compile(r"\bv_[a-z]+\b")


def with_views(body: str) -> str:
    """Prefix a query with the views it mentions, and those they mention."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in needed:
            for inner in _NAME.findall(VIEWS[name]):
                add(inner)
            needed.append(name)

    for name in _NAME.findall(body):
        add(name)
    if not needed:
        return body
    heads = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{body}"


def avg(total: str, count: str, digits: int = 2) -> str:
    """Quotient rounded half up in whole numbers; totals are not negative and have at most two decimals."""
    scale = 10**digits
    return (
        f"CAST((CAST(({total}) * {2 * scale} AS HUGEINT) + ({count})) // NULLIF(2 * CAST({count} AS HUGEINT), 0) AS DOUBLE)"
        f" / {scale}.0"
    )


def stamp(expr: str) -> str:
    """Timestamps as text with microseconds."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"
