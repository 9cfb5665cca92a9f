"""Table schemas, keys, references and row rules of the commerce model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Closed domains, in declaration order.
ORDER_STATUS = ["created", "approved", "invoiced", "processing", "shipped", "delivered", "canceled", "unavailable"]
PAYMENT_TYPE = ["credit_card", "debit_card", "boleto", "voucher", "not_defined"]
EVENT_TYPE = [
    "product_view",
    "product_click",
    "search",
    "cart_add",
    "cart_remove",
    "cart_abandon",
    "checkout_start",
    "category_view",
    "seller_view",
]

RANGE = "struct<lower: timestamp, upper: timestamp, lower_inc: boolean, upper_inc: boolean>"

# Schemas in DDL form, as ``spark.read.schema`` takes them. Column names keep the spelling of the public data set ("lenght").
TABLES: dict[str, str] = {
    "geolocation": (
        "zip_code_prefix string, latitude decimal(9,6), longitude decimal(9,6), city string, state string"
    ),
    "product_category": ("category_name string, name_english string"),
    "customer": (
        "customer_id string, customer_unique_id string, zip_code_prefix string, customer_city string, customer_state string"
    ),
    "seller": (
        "seller_id string, zip_code_prefix string, seller_city string, seller_state string"
    ),
    "product": (
        "product_id string, category_name string, product_name_lenght smallint, product_description_lenght smallint, "
        "product_photos_qty smallint, product_weight_g decimal(8,2), product_length_cm decimal(6,2), "
        "product_height_cm decimal(6,2), product_width_cm decimal(6,2), specifications variant, photo_urls array<string>"
    ),
    "order": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
        f"order_estimated_delivery_date timestamp, promotion_period {RANGE}"
    ),
    "order_item": (
        "order_id string, order_item_id smallint, order_purchase_timestamp timestamp, product_id string, "
        "seller_id string, shipping_limit_date timestamp, price decimal(10,2), freight_value decimal(10,2)"
    ),
    "payment": (
        "order_id string, payment_sequential smallint, order_purchase_timestamp timestamp, payment_type string, "
        "payment_installments smallint, payment_value decimal(10,2)"
    ),
    "review": (
        "review_id string, order_id string, order_purchase_timestamp timestamp, review_score smallint, "
        "review_comment_title string, review_comment_message string, review_creation_date timestamp, "
        "review_answer_timestamp timestamp"
    ),
}

COLLECTIONS: dict[str, str] = {
    "products_catalog": (
        "product_id string, product_category_name string, category_name_english string, name string, "
        "description string, product_name_lenght int, product_description_lenght int, product_photos_qty int, "
        "product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int, "
        "photo_urls array<string>, specifications variant, tags array<string>, avg_review_score double, "
        "total_reviews int, schema_version int, created_at timestamp, updated_at timestamp"
    ),
    "event_logs": (
        "event_type string, customer_unique_id string, session_id string, product_id string, seller_id string, "
        "category string, metadata variant, page_url string, timestamp timestamp, ttl_expire timestamp"
    ),
    "user_sessions": (
        "_id string, customer_unique_id string, "
        "cart array<struct<product_id: string, quantity: int, unit_price: double, seller_id: string>>, "
        "created_at timestamp, expires_at timestamp"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    ),
}

# Column names of the text files, in file order; every field arrives as text.
CSV_COLUMNS: dict[str, list[str]] = {
    "geolocation": ["zip_code_prefix", "latitude", "longitude", "city", "state"],
    "product_category": ["category_name", "name_english"],
    "customer": ["customer_id", "customer_unique_id", "zip_code_prefix", "customer_city", "customer_state"],
    "seller": ["seller_id", "zip_code_prefix", "seller_city", "seller_state"],
    "product": [
        "product_id",
        "category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ],
    "order": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_item": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "payment": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "review": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
}

# Keys, required columns and references.
PRIMARY_KEYS: dict[str, list[str]] = {
    "geolocation": ["zip_code_prefix"],
    "product_category": ["category_name"],
    "customer": ["customer_unique_id"],
    "seller": ["seller_id"],
    "product": ["product_id"],
    "order": ["order_id", "order_purchase_timestamp"],
    "order_item": ["order_id", "order_item_id"],
    "payment": ["order_id", "payment_sequential"],
    "review": ["review_id"],
}

NOT_NULL: dict[str, list[str]] = {
    "geolocation": ["zip_code_prefix", "latitude", "longitude", "city", "state"],
    "product_category": ["category_name", "name_english"],
    "customer": ["customer_id", "customer_unique_id"],
    "seller": ["seller_id", "seller_city", "seller_state"],
    "product": ["product_id"],
    "order": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_estimated_delivery_date",
    ],
    "order_item": [
        "order_id",
        "order_item_id",
        "order_purchase_timestamp",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "payment": [
        "order_id",
        "payment_sequential",
        "order_purchase_timestamp",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "review": ["review_id", "order_id", "order_purchase_timestamp", "review_score", "review_creation_date"],
}


@dataclass(frozen=True)
class Reference:
    """A foreign key and what happens to the child when the parent row goes."""

    child: str
    columns: list[str]
    parent: str
    parent_columns: list[str]
    on_delete: str  # "set null" | "restrict" | "cascade"


_ORDER_KEY = ["order_id", "order_purchase_timestamp"]
REFERENCES: list[Reference] = [
    Reference("customer", ["zip_code_prefix"], "geolocation", ["zip_code_prefix"], "set null"),
    Reference("seller", ["zip_code_prefix"], "geolocation", ["zip_code_prefix"], "set null"),
    Reference("product", ["category_name"], "product_category", ["category_name"], "set null"),
    Reference("order", ["customer_id"], "customer", ["customer_unique_id"], "restrict"),
    Reference("order_item", _ORDER_KEY, "order", _ORDER_KEY, "restrict"),
    Reference("order_item", ["product_id"], "product", ["product_id"], "restrict"),
    Reference("order_item", ["seller_id"], "seller", ["seller_id"], "restrict"),
    Reference("payment", _ORDER_KEY, "order", _ORDER_KEY, "restrict"),
    Reference("review", _ORDER_KEY, "order", _ORDER_KEY, "cascade"),
]


@dataclass(frozen=True)
class Rule:
    """A row rule. As with a CHECK constraint, an unknown (NULL) outcome passes."""

    name: str
    holds: Column = field(compare=False)


def _at_least(column: str, low: int) -> Rule:
    return Rule(f"{column}_at_least_{low}", F.col(column) >= low)


def _positive(column: str) -> Rule:
    return Rule(f"{column}_positive", F.col(column) > 0)


def one_of(column: str, values: list[str]) -> Rule:
    return Rule(f"{column}_in_domain", F.col(column).isin(values))


def required(column: str) -> Rule:
    return Rule(f"{column}_required", F.col(column).isNotNull())


def row_rules(table: str) -> list[Rule]:
    """CHECK and domain rules of a table (not the NOT NULL ones)."""
    rules = {
        "product": [
            _at_least("product_name_lenght", 0),
            _at_least("product_description_lenght", 0),
            _at_least("product_photos_qty", 0),
            _positive("product_weight_g"),
            _positive("product_length_cm"),
            _positive("product_height_cm"),
            _positive("product_width_cm"),
        ],
        "order": [one_of("order_status", ORDER_STATUS)],
        "order_item": [_positive("price"), _at_least("freight_value", 0)],
        "payment": [
            one_of("payment_type", PAYMENT_TYPE),
            _at_least("payment_installments", 0),
            _at_least("payment_value", 0),
        ],
        "review": [Rule("review_score_between_1_and_5", F.col("review_score").between(1, 5))],
    }
    return rules.get(table, [])


@dataclass(frozen=True)
class Field:
    """One property of a document schema. ``items`` describes the elements of an array."""

    path: str
    kind: str  # string | int | double | date | object | array
    required: bool = False
    minimum: float | None = None
    maximum: float | None = None
    allowed: list[str] | None = None
    items: list["Field"] | str | None = None


def _ints(*names: str) -> list[Field]:
    return [Field(name, "int", minimum=0) for name in names]


def _catalogue(category: str, measures: bool) -> list[Field]:
    sizes = _ints(
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    return [
        Field("product_id", "string", required=True),
        Field(category, "string", required=True),
        Field("category_name_english", "string"),
        Field("name", "string", required=True),
        *(sizes if measures else []),
        Field("description", "string"),
        Field("photo_urls", "array", items="string"),
        Field("specifications", "object"),
        Field("tags", "array", items="string"),
        Field("avg_review_score", "double", minimum=0, maximum=5),
        Field("total_reviews", "int", minimum=0),
        Field("schema_version", "int"),
        Field("created_at", "date", required=True),
        Field("updated_at", "date", required=True),
    ]


DOCUMENT_FIELDS: dict[str, list[Field]] = {
    "products_catalog": _catalogue("product_category_name", measures=True),
    "products": _catalogue("category_name", measures=False),
    "event_logs": [
        Field("event_type", "string", required=True, allowed=EVENT_TYPE),
        Field("customer_unique_id", "string"),
        Field("session_id", "string", required=True),
        Field("product_id", "string"),
        Field("seller_id", "string"),
        Field("category", "string"),
        Field("metadata", "object"),
        Field("page_url", "string"),
        Field("timestamp", "date", required=True),
        Field("ttl_expire", "date", required=True),
    ],
    "user_sessions": [
        Field("_id", "string", required=True),
        Field("customer_unique_id", "string"),
        Field(
            "cart",
            "array",
            items=[
                Field("product_id", "string", required=True),
                Field("quantity", "int", required=True, minimum=1),
                Field("unit_price", "double", required=True, minimum=0),
                Field("seller_id", "string"),
            ],
        ),
        Field("created_at", "date", required=True),
        Field("expires_at", "date", required=True),
    ],
    "geolocation": [
        Field("geolocation_zip_code_prefix", "string", required=True),
        Field("geolocation_lat", "double", required=True),
        Field("geolocation_lng", "double", required=True),
        Field("geolocation_city", "string", required=True),
        Field("geolocation_state", "string", required=True),
    ],
}
