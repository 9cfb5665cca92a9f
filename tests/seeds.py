"""Small hand-checkable tables and documents."""

from __future__ import annotations

import datetime as dt

from tradewind.schemas import COLLECTIONS

UTC = dt.timezone.utc


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


PRODUCTS = [
    {
        "product_id": "mouse",
        "product_category_name": "informatica_acessorios",
        "category_name_english": "computers_accessories",
        "name": "Mouse Inalambrico",
        "description": "Mouse optico com Bluetooth",
        "specifications": '{"weight_g": 85, "connectivity": ["USB-A", "Bluetooth 5.0"], "dimensions": {"height": 3.8}}',
        "tags": ["mouse", "inalambrico"],
        "avg_review_score": 4.3,
        "total_reviews": 128,
        "product_weight_g": 85,
    },
    {
        "product_id": "towel",
        "product_category_name": "cama_mesa_banho",
        "category_name_english": "bed_bath_table",
        "name": "Toalha Luxo",
        "description": "Toalha de banho",
        "specifications": '{"weight_g": 450, "material": "Algodao"}',
        "tags": ["toalha"],
        "avg_review_score": 4.7,
        "total_reviews": 89,
        "product_weight_g": 450,
    },
    {
        "product_id": "phone",
        "product_category_name": "eletronicos",
        "category_name_english": "electronics",
        "name": "Fone Bluetooth",
        "description": "Fone de ouvido",
        "specifications": '{"weight_g": 250, "connectivity": "Bluetooth 5.2"}',
        "tags": ["fone", "bluetooth"],
        "avg_review_score": 4.5,
        "total_reviews": 256,
        "product_weight_g": 250,
    },
    {
        "product_id": "boxes",
        "product_category_name": "utilidades_domesticas",
        "category_name_english": "household_utilities",
        "name": "Conjunto Tuppers",
        "description": "Recipientes",
        "specifications": '{"pieces": 10, "freezer_safe": true, "sizes": [150, 250]}',
        "tags": ["tuppers"],
        "avg_review_score": 4.1,
        "total_reviews": 67,
        "product_weight_g": 650,
    },
    {
        "product_id": "shirt",
        "product_category_name": None,
        "category_name_english": None,
        "name": "Camisa Academia",
        "description": None,
        "specifications": '{"size": "M", "technology": ["Dry Fit"]}',
        "tags": None,
        "avg_review_score": None,
        "total_reviews": 42,
        "product_weight_g": None,
    },
]

_DAY = "2024-06-20T"
EVENTS = [
    ("product_view", "ana", "sess_abc123", "mouse", "informatica_acessorios", "2024-06-20T14:32:10", "mouse inalambrico"),
    ("product_view", "ana", "sess_abc123", "phone", "eletronicos", "2024-06-20T14:33:05", "fone"),
    ("cart_add", "ana", "sess_abc123", "mouse", "informatica_acessorios", "2024-06-20T14:35:00", None),
    ("search", "bia", "sess_def456", None, None, "2024-06-20T15:00:00", "toalha"),
    ("product_view", "bia", "sess_def456", "towel", "cama_mesa_banho", "2024-06-20T15:01:30", "toalha"),
    ("cart_abandon", "caio", "sess_ghi789", None, None, "2024-06-19T22:15:00", None),
    ("checkout_start", "duda", "sess_jkl012", None, None, "2024-06-20T16:00:00", None),
]

SESSIONS = [
    ("sess_abc123", "ana", [("mouse", 1, 89.90, "s1"), ("phone", 1, 199.90, "s2")], "2024-06-20T14:30:00", "2024-06-21T14:30:00"),
    ("sess_def456", "bia", [("towel", 2, 49.90, "s3")], "2024-06-20T15:00:00", "2024-06-21T15:00:00"),
    ("sess_ghi789", "caio", [], "2024-06-19T22:00:00", "2024-06-20T22:00:00"),
]


def catalog(spark):
    schema = (
        "product_id string, product_category_name string, category_name_english string, name string, description string, "
        "specifications string, tags array<string>, avg_review_score double, total_reviews int, product_weight_g int"
    )
    order = [c.strip().split(" ")[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(p[c] for c in order) for p in PRODUCTS], schema)


def events(spark):
    import json

    data = [
        (*e[:5], json.dumps({"search_query": e[6]}) if e[6] else "{}", at(e[5])) for e in EVENTS
    ]
    df = spark.createDataFrame(
        data,
        "event_type string, customer_unique_id string, session_id string, product_id string, category string, "
        "metadata string, timestamp timestamp",
    )
    from pyspark.sql import functions as F

    return df.withColumn("metadata", F.parse_json("metadata"))


def sessions(spark):
    data = [(i, who, cart, at(a), at(b)) for i, who, cart, a, b in SESSIONS]
    return spark.createDataFrame(data, COLLECTIONS["user_sessions"])


def orders(spark):
    """Two delivered orders and one that is not; the first has two items, two payments, two reviews."""
    o = "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, " \
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
    t1, t2, t3 = at("2018-03-01T10:00:00"), at("2018-12-31T12:00:00"), at("2017-05-15T10:30:00")
    order = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", t1, at("2018-03-20T12:00:00"), at("2018-03-10T00:00:00")),
            ("o2", "c2", "delivered", t2, at("2019-01-05T00:00:00"), at("2019-01-10T00:00:00")),
            ("o3", "c1", "created", t3, None, at("2017-05-25T00:00:00")),
        ],
        o,
    )
    item = spark.createDataFrame(
        [("o1", 1, t1, "p1", "s1", "100.00", "10.00"), ("o1", 2, t1, "p2", "s1", "50.00", "5.00"),
         ("o2", 1, t2, "p1", "s2", "30.00", "3.00"), ("o3", 1, t3, "p1", "s1", "199.90", "15.50")],
        "order_id string, order_item_id int, order_purchase_timestamp timestamp, product_id string, seller_id string, "
        "price string, freight_value string",
    ).selectExpr("* except (price, freight_value)", "cast(price as decimal(10,2)) price",
                 "cast(freight_value as decimal(10,2)) freight_value")
    payment = spark.createDataFrame(
        [("o1", 1, t1, "credit_card", 3, 120.0), ("o1", 2, t1, "voucher", 1, 45.0), ("o2", 1, t2, "boleto", 1, 33.0)],
        "order_id string, payment_sequential int, order_purchase_timestamp timestamp, payment_type string, "
        "payment_installments int, payment_value double",
    ).selectExpr("* except (payment_value)", "cast(payment_value as decimal(10,2)) payment_value")
    review = spark.createDataFrame(
        [("r1", "o1", t1, 5), ("r2", "o1", t1, 2)],
        "review_id string, order_id string, order_purchase_timestamp timestamp, review_score int",
    )
    customer = spark.createDataFrame(
        [("c1", "u1", "01001", "Sao Paulo", "SP"), ("c2", "u2", "20040", "Rio", "RJ")],
        "customer_id string, customer_unique_id string, zip_code_prefix string, customer_city string, customer_state string",
    )
    seller = spark.createDataFrame(
        [("s1", "20040", "Rio", "RJ"), ("s2", "01001", "Sao Paulo", "SP")],
        "seller_id string, zip_code_prefix string, seller_city string, seller_state string",
    )
    product = spark.createDataFrame([("p1", "a"), ("p2", "b")], "product_id string, category_name string")
    category = spark.createDataFrame([("a", "A"), ("b", "B")], "category_name string, name_english string")
    return {
        "order": order, "order_item": item, "payment": payment, "review": review, "customer": customer,
        "seller": seller, "product": product, "product_category": category,
    }
