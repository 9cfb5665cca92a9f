"""The commerce model as views over the star-schema tables of the test data.

Every view is a lazy DataFrame. Orders, payments and reviews come from one scan of ``orders`` each:
where an order yields several rows they are built as a short array per row and exploded, not by
reading the table twice.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.numeric import money
from tradewind.functions.ranges import make_range
from tradewind.functions.temporal import plus


def _days(expr: Column) -> Column:
    return F.make_dt_interval(expr.cast("int"))


class Shop:
    """Lazily built views over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A stored table; its files are listed and its schema is read once per shop."""
        if name not in self._tables:
            self._tables[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def order(self) -> DataFrame:
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        # Nested, so that a filter on one status folds to one on the stored column and reaches the scan.
        code = F.col("o_orderstatus")
        status = F.when(code == "F", "delivered").otherwise(F.when(code == "O", "shipped").otherwise("processing"))
        promo = make_range(day - _days(key % 10), day + _days(F.lit(5)))
        return self.table("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            day.alias("order_purchase_timestamp"),
            F.when(F.col("o_orderstatus") == "F", day + _days(5 + key % 30)).alias("order_delivered_customer_date"),
            (day + _days(F.lit(20))).alias("order_estimated_delivery_date"),
            F.when(key % 3 != 0, promo).alias("promotion_period"),
        )

    @cached_property
    def order_item(self) -> DataFrame:
        parent = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_purchase_timestamp")
        )
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            money("l_extendedprice").alias("price"),
            F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
        )
        return lines.join(parent, "order_id")

    @cached_property
    def payment(self) -> DataFrame:
        key = F.col("o_orderkey")
        digit = F.substring("o_orderpriority", 1, 1)
        kind = (
            F.when(digit == "1", "credit_card")
            .when(digit == "2", "debit_card")
            .when(digit == "3", "boleto")
            .when(digit == "4", "not_defined")
            .otherwise("voucher")
        )

        def row(seq: int, kind: Column, installments: Column, value: Column) -> Column:
            return F.struct(
                F.lit(seq).cast("smallint").alias("payment_sequential"),
                kind.alias("payment_type"),
                installments.cast("int").alias("payment_installments"),
                value.cast("decimal(12,2)").alias("payment_value"),
            )

        main = row(1, kind, 1 + key % 10, F.col("o_totalprice"))
        extra = row(2, F.lit("voucher"), F.lit(1), F.lit(5))
        rows = F.when(key % 11 == 0, F.array(main, extra)).otherwise(F.array(main))
        return self.table("orders").select(
            key.alias("order_id"), F.col("o_orderdate").alias("order_purchase_timestamp"), F.inline(rows)
        )

    @cached_property
    def review(self) -> DataFrame:
        key = F.col("o_orderkey")

        def row(review_id: Column, score: Column) -> Column:
            return F.struct(review_id.alias("review_id"), score.cast("smallint").alias("review_score"))

        first, second = row(key, 1 + (key * 7) % 5), row(key + 1000000, F.lit(1))
        rows = (
            F.when((key % 9 != 0) & (key % 13 == 0), F.array(first, second))
            .when(key % 9 != 0, F.array(first))
            .when(key % 13 == 0, F.array(second))
        )
        return self.table("orders").select(
            key.alias("order_id"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.inline(rows),
        )

    @cached_property
    def _place(self) -> DataFrame:
        region = self.table("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return self.table("nation").join(region, "n_regionkey").select("n_nationkey", "n_name", "r_name")

    @cached_property
    def customer(self) -> DataFrame:
        who = self.table("customer")
        return who.join(self._place, who["c_nationkey"] == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_custkey") + 10000000).alias("customer_unique_id"),
            F.col("c_nationkey").alias("zip_code_prefix"),
            F.col("n_name").alias("customer_city"),
            F.col("r_name").alias("customer_state"),
        )

    @cached_property
    def seller(self) -> DataFrame:
        who = self.table("supplier")
        return who.join(self._place, who["s_nationkey"] == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("zip_code_prefix"),
            F.col("n_name").alias("seller_city"),
            F.col("r_name").alias("seller_state"),
        )

    @cached_property
    def product(self) -> DataFrame:
        size = F.col("p_size")
        volts = F.when(
            size % 2 == 0,
            F.concat(F.lit('{"voltagem":"110V","material":"'), F.col("p_brand"), F.lit('"}')),
        ).otherwise(F.lit('{"voltagem":"220V"}'))
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category_name"),
            F.col("p_name").alias("name"),
            (size * 100).alias("product_weight_g"),
            size.alias("product_height_cm"),
            volts.alias("specifications"),
            F.split("p_name", " ").alias("tags"),
        )

    @cached_property
    def product_category(self) -> DataFrame:
        return (
            self.table("part")
            .select(F.col("p_type").alias("category_name"))
            .distinct()
            .withColumn("name_english", F.lower("category_name"))
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """Many rows per zip, as delivered by the source files."""
        who = self.table("customer")
        zip_code, key = F.col("c_nationkey"), F.col("c_custkey")
        return who.join(self._place, who["c_nationkey"] == F.col("n_nationkey")).select(
            zip_code.alias("geolocation_zip_code_prefix"),
            (F.lit(-30.0) + zip_code + (key % 10) * F.lit(0.01)).alias("geolocation_lat"),
            (F.lit(-70.0) + zip_code * F.lit(1.5) + (key % 7) * F.lit(0.01)).alias("geolocation_lng"),
            F.concat(F.col("n_name"), F.when(key % 4 == 0, "_B").otherwise("")).alias("geolocation_city"),
            F.col("r_name").alias("geolocation_state"),
        )

    @cached_property
    def zip_centroid(self) -> DataFrame:
        """One row per zip: the mean position, summed as decimals so that row order does not matter."""

        def mean(column: str) -> Column:
            return F.sum(F.col(column).cast("decimal(9,6)")).cast("double") / F.count(column)

        return self.geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
            mean("geolocation_lat").alias("latitude"), mean("geolocation_lng").alias("longitude")
        )

    @cached_property
    def products_catalog(self) -> DataFrame:
        key = F.col("p_partkey")
        specs = F.concat(
            F.lit('{"weight_g":'),
            (F.col("p_size") * 100).cast("string"),
            F.lit(',"connectivity":'),
            F.when(key % 3 == 0, '["USB-A","Bluetooth 5.0"]').when(key % 3 == 1, '"Bluetooth 4.2"').otherwise('["Wi-Fi"]'),
            F.lit("}"),
        )
        return self.table("part").select(
            key.alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("category_name_english"),
            F.col("p_name").alias("name"),
            F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("description"),
            (F.col("p_size") * 100).alias("product_weight_g"),
            F.col("p_size").alias("product_height_cm"),
            specs.alias("specifications"),
            F.split("p_name", " ").alias("tags"),
            ((key * 7) % 51 / 10.0).cast("double").alias("avg_review_score"),
            (key % 100).cast("int").alias("total_reviews"),
        )

    @cached_property
    def event_logs(self) -> DataFrame:
        kinds = {
            "view": "product_view",
            "click": "product_click",
            "purchase": "cart_add",
            "signup": "search",
            "error": "cart_abandon",
        }
        kind = F.col("event_type")
        for raw, name in kinds.items():
            kind = F.when(F.col("event_type") == raw, name) if raw == "view" else kind.when(F.col("event_type") == raw, name)
        events = self.table("events").select(
            "event_id",
            kind.alias("event_type"),
            F.col("user_id").alias("customer_unique_id"),
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
            F.col("ts").alias("timestamp"),
            plus("ts", "90 days").alias("ttl_expire"),
            F.col("value"),
        )
        parts = self.table("part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))
        return events.join(parts, "product_id", "left")

    @cached_property
    def user_sessions(self) -> DataFrame:
        """One session document per event; purchases carry a cart of 0 to 3 lines.

        The cart is built inside the row, so it is bounded and needs no grouping.
        """
        eid, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("bigint")
        size = F.when(F.col("event_type") == "purchase", eid % 4).otherwise(F.lit(0))
        line = lambda i: F.struct(
            ((k + 7 * i) % 100).alias("product_id"),
            (1 + (eid + i) % 3).cast("int").alias("quantity"),
            F.col("value").cast("decimal(10,2)").alias("unit_price"),
        )
        lines = F.slice(F.array(*[line(i) for i in range(3)]), F.lit(1), size.cast("int"))
        return self.table("events").select(
            F.concat(F.lit("sess_"), eid.cast("string")).alias("_id"),
            F.col("user_id").alias("customer_unique_id"),
            lines.alias("cart"),
            F.col("ts").alias("created_at"),
            plus("ts", "24 hours").alias("expires_at"),
        )
