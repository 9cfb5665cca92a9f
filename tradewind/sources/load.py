"""Cleansing loads: all-text input to typed tables.

Text that does not parse becomes NULL rather than stopping the load; the quality jobs report it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numeric import blank_to_null, default_zero, parse_number, positive_or_null
from tradewind.functions.temporal import parse_timestamp
from tradewind.operators.topk import first_per_key


def _number(column: str, kind: str) -> Column:
    return parse_number(F.col(column), kind).alias(column)


def _time(column: str) -> Column:
    return parse_timestamp(F.col(column)).alias(column)


def _text(column: str) -> Column:
    return blank_to_null(F.col(column)).alias(column)


def clean_geolocation(raw: DataFrame) -> DataFrame:
    """One row per zip code: the first by city, state, latitude and longitude."""
    typed = raw.select(
        "zip_code_prefix", _number("latitude", "decimal(9,6)"), _number("longitude", "decimal(9,6)"), "city", "state"
    )
    return first_per_key(
        typed, ["zip_code_prefix"], [F.col(c).asc_nulls_last() for c in ("city", "state", "latitude", "longitude")]
    )


def clean_customer(raw: DataFrame) -> DataFrame:
    """Only the first row (by customer id) of every unique customer is kept, as the table's key asks."""
    return first_per_key(raw, ["customer_unique_id"], [F.col("customer_id")])


def clean_product(raw: DataFrame) -> DataFrame:
    """Blank measures and weights that are not positive become NULL."""
    return raw.select(
        "product_id",
        _text("category_name"),
        _number("product_name_lenght", "smallint"),
        _number("product_description_lenght", "smallint"),
        _number("product_photos_qty", "smallint"),
        positive_or_null(parse_number(F.col("product_weight_g"), "decimal(8,2)")).alias("product_weight_g"),
        _number("product_length_cm", "decimal(6,2)"),
        _number("product_height_cm", "decimal(6,2)"),
        _number("product_width_cm", "decimal(6,2)"),
    )


def clean_order(raw: DataFrame) -> DataFrame:
    """Timestamps parsed, blank ones NULL; a promotion period is not in the files and stays NULL."""
    times = [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    from tradewind.schemas import RANGE

    return raw.select("order_id", "customer_id", "order_status", *[_time(c) for c in times]).withColumn(
        "promotion_period", F.lit(None).cast(RANGE)
    )


def with_order_time(child: DataFrame, order: DataFrame, how: str = "inner") -> DataFrame:
    """Child rows with the purchase timestamp of their order.

    ``inner`` drops rows without an order, ``left`` keeps them with a NULL timestamp.
    """
    parent = order.select("order_id", "order_purchase_timestamp")
    return child.join(parent, "order_id", how)


def clean_order_item(raw: DataFrame, order: DataFrame, how: str = "inner") -> DataFrame:
    typed = raw.select(
        "order_id",
        _number("order_item_id", "smallint"),
        "product_id",
        "seller_id",
        _time("shipping_limit_date"),
        _number("price", "decimal(10,2)"),
        _number("freight_value", "decimal(10,2)"),
    )
    return with_order_time(typed, order, how)


def clean_payment(raw: DataFrame, order: DataFrame, how: str = "inner") -> DataFrame:
    typed = raw.select(
        "order_id",
        _number("payment_sequential", "smallint"),
        "payment_type",
        _number("payment_installments", "smallint"),
        _number("payment_value", "decimal(10,2)"),
    )
    return with_order_time(typed, order, how)


def clean_review(raw: DataFrame, order: DataFrame, how: str = "inner") -> DataFrame:
    typed = raw.select(
        "review_id",
        "order_id",
        _number("review_score", "smallint"),
        _text("review_comment_title"),
        _text("review_comment_message"),
        _time("review_creation_date"),
        _time("review_answer_timestamp"),
    )
    return with_order_time(typed, order, how)


def category_master(translation: DataFrame, product: DataFrame) -> DataFrame:
    """Translated categories, and those that only occur on products, without an English name."""
    extra = (
        product.select("category_name")
        .where(F.col("category_name").isNotNull())
        .distinct()
        .join(translation.select("category_name"), "category_name", "left_anti")
        .withColumn("name_english", F.lit(None).cast("string"))
    )
    return translation.select("category_name", "name_english").unionByName(extra)


def catalog_documents(raw_product: DataFrame, translation: DataFrame) -> DataFrame:
    """Catalogue documents from the product file: English name or ``''``, missing numbers as 0."""
    numbers = [c for c in raw_product.columns if c.startswith("product_") and c != "product_id"]
    # One translation per category: the last one read in the source, the highest here.
    names = translation.groupBy("category_name").agg(F.max("name_english").alias("name_english"))
    category = F.coalesce(F.col("category_name"), F.lit(""))
    return (
        raw_product.withColumn("category_name", category)
        .join(names, "category_name", "left")
        .select(
            "product_id",
            F.col("category_name").alias("product_category_name"),
            F.coalesce("name_english", F.lit("")).alias("category_name_english"),
            *[default_zero(parse_number(F.col(c), "int")).alias(c) for c in numbers],
        )
    )


def geolocation_documents(raw: DataFrame) -> DataFrame:
    """Geolocation rows as documents, many per zip code."""
    return raw.select(
        F.col("zip_code_prefix").alias("geolocation_zip_code_prefix"),
        parse_number(F.col("latitude"), "double").alias("geolocation_lat"),
        parse_number(F.col("longitude"), "double").alias("geolocation_lng"),
        F.col("city").alias("geolocation_city"),
        F.col("state").alias("geolocation_state"),
    )


def renamed(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Selected columns under new names, in the order of the mapping."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def concatenated(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def clean_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All nine tables from their raw frames, each unique on its primary key.

    Items, payments and reviews of unknown orders are dropped.
    """
    from tradewind.schemas import PRIMARY_KEYS

    order = clean_order(raw["order"])
    tables = {
        "geolocation": clean_geolocation(raw["geolocation"]),
        "product_category": raw["product_category"],
        "customer": clean_customer(raw["customer"]),
        "seller": raw["seller"],
        "product": clean_product(raw["product"]),
        "order": order,
        "order_item": clean_order_item(raw["order_item"], order),
        "payment": clean_payment(raw["payment"], order),
        "review": clean_review(raw["review"], order),
    }
    unique = {"geolocation", "customer"}  # already reduced above
    return {
        name: df if name in unique else first_per_key(df, PRIMARY_KEYS[name], _any_order(df, PRIMARY_KEYS[name]))
        for name, df in tables.items()
    }


def _any_order(df: DataFrame, keys: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in keys] or [F.col(keys[0])]
