"""Files, layouts and partition jobs: written from the test tables into the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.entries import loads, on_shop, with_nulls
from tradewind.entries.loads import raw_geolocation, raw_items, raw_products
from tradewind.entries.views import dbl, stamp, with_views
from tradewind.functions.temporal import half_open
from tradewind.operators.lifecycle import archive_year, split_open_partition
from tradewind.plans.catalog import cart_totals
from tradewind.plans.reports import ORDER_KEY
from tradewind.schemas import CSV_COLUMNS
from tradewind.session import workspace
from tradewind.sources import expiry, files, filtered, load, sinks
from tradewind.sources.star_views import Shop


def _orders(s: Shop) -> DataFrame:
    return s.order.drop("promotion_period")


def _csv_orders(s: Shop) -> DataFrame:
    """Orders written as text with a header and loaded again."""
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "csv-orders")
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    none = F.lit(None).cast("string")
    text = _orders(s).select(
        "order_id",
        "customer_id",
        "order_status",
        time("order_purchase_timestamp"),
        none.alias("order_approved_at"),
        none.alias("order_delivered_carrier_date"),
        time("order_delivered_customer_date"),
        time("order_estimated_delivery_date"),
    )
    text.write.option("header", True).csv(path)
    return load.clean_order(files.read_raw(spark, path, "order")).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )


def _csv(table: str, raw, clean, *numbers: str):
    """A table's rows as text go into a CSV file with a header and are loaded again; ``numbers`` are compared as numbers."""

    def build(s: Shop) -> DataFrame:
        spark, path = s.order.sparkSession, workspace(s.order.sparkSession, f"csv-{table}")
        text = raw(s).select(*(F.col(c).cast("string") for c in CSV_COLUMNS[table]))
        text.write.options(header=True, quoteAll=True, escape='"').csv(path)
        loaded = clean(s, files.read_raw(spark, path, table))
        return with_nulls(loaded.withColumns({c: F.col(c).cast("bigint") for c in numbers if c in loaded.columns}), *numbers)

    return on_shop(build)


def _raw_reviews(s: Shop) -> DataFrame:
    """Reviews with a message of two lines, with a comma and quotes."""
    when = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    return s.review.select(
        "*",
        F.lit(None).cast("string").alias("review_comment_title"),
        F.concat(F.lit('first, "line"\nsecond '), F.col("order_id").cast("string")).alias("review_comment_message"),
        when.alias("review_creation_date"),
        F.lit("not a time").alias("review_answer_timestamp"),
    )


def _review_out(s: Shop, raw: DataFrame) -> DataFrame:
    cleaned = load.clean_review(raw.withColumn("order_id", F.col("order_id").cast("bigint")), s.order)
    return with_nulls(cleaned, "review_score").withColumn(
        "review_comment_message", F.replace("review_comment_message", F.lit("\n"), F.lit("|"))
    )


def _child(clean):
    return lambda s, raw: clean(raw.withColumn("order_id", F.col("order_id").cast("bigint")), s.order)


def _deliveries(s: Shop) -> DataFrame:
    return s.order.select("order_id", "order_status", "order_delivered_customer_date")


_DELIVERY_SCHEMA = "order_id bigint, order_status string, order_delivered_customer_date timestamp_ntz"


def _tsv(s: Shop) -> DataFrame:
    """A status with a tab, a line break and a backslash goes out and comes back."""
    path = workspace(s.order.sparkSession, "tsv")
    marked = _deliveries(s).withColumn("order_status", F.concat("order_status", F.lit("\tand\nmore\\n")))
    sinks.append_tsv(marked, path)
    return files.read_tsv(s.order.sparkSession, path, _DELIVERY_SCHEMA)


def _quoted(s: Shop) -> DataFrame:
    path = workspace(s.order.sparkSession, "quoted")
    sinks.append_quoted_csv(_deliveries(s), path)
    return s.order.sparkSession.read.schema(_DELIVERY_SCHEMA).csv(path)


def _json_sessions(s: Shop) -> DataFrame:
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "json")
    sinks.append_documents(s.user_sessions, path)
    return cart_totals(files.read_documents(spark, path, "user_sessions")).withColumn("total", F.round("total", 2))


def _year_of_layout(s: Shop) -> DataFrame:
    """One quarter read from the year-partitioned table."""
    path = workspace(s.order.sparkSession, "years")
    sinks.write_by_year(_orders(s), path)
    stored = s.order.sparkSession.read.parquet(path)
    return half_open(stored, "order_purchase_timestamp", "1997-10-01", "1998-01-01").select(
        "order_id", "order_purchase_timestamp", "purchase_year"
    )


def _clustered(s: Shop) -> DataFrame:
    path = workspace(s.order.sparkSession, "clustered")
    sinks.write_clustered(_orders(s), path, "order_purchase_timestamp")
    stored = s.order.sparkSession.read.parquet(path)
    return half_open(stored, "order_purchase_timestamp", "1998-03-01", "1998-04-01").select("order_id", "customer_id")


def _filtered(name: str, table, *columns: str, then: str = ""):
    """Rows of a named filter from their copy, after the first load, a second one, or the first one again."""

    def build(s: Shop) -> DataFrame:
        spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "loads")
        source = table(s).select(*columns)
        half = F.pmod(F.hash(columns[0]), F.lit(2)) == 0
        filtered.write_load(source.where(half) if then else source, path, "first")
        filtered.refresh(spark, path, name)
        if then:
            filtered.write_load(source.where(~half) if then == "second" else source, path, then)
            filtered.refresh(spark, path, name)
        return filtered.read_filtered(spark, path, name).select(*columns)

    return on_shop(build)


_LATE = ("order_id", "order_delivered_customer_date", "order_estimated_delivery_date")


def _inserted_twice(s: Shop) -> DataFrame:
    """Insert-if-absent onto a stored table, twice."""
    path = workspace(s.order.sparkSession, "insert")
    items = s.order_item.select("order_id", "order_item_id", "product_id", "seller_id", "price")
    sinks.insert_new_into(items.where(F.col("order_id") % 2 == 0), path, ["order_id", "order_item_id"])
    sinks.insert_new_into(items, path, ["order_id", "order_item_id"])
    return s.order.sparkSession.read.parquet(path)


def _archived(late_rows: bool):
    def build(s: Shop) -> DataFrame:
        """All orders with their place after one year has moved; with ``late_rows`` some come after the first move."""
        spark, root = s.order.sparkSession, workspace(s.order.sparkSession, "archive")
        orders, late = _orders(s), (F.year("order_purchase_timestamp") == 1996) & (F.col("order_id") % 3 == 0)
        sinks.write_by_year(orders.where(~late) if late_rows else orders, f"{root}/order")
        archive_year(spark, f"{root}/order", f"{root}/archive", 1996)
        if late_rows:
            sinks.write_by_year(orders.where(late), f"{root}/order", mode="append")
            archive_year(spark, f"{root}/order", f"{root}/archive", 1996)
        columns = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "purchase_year"]
        places = {"active": f"{root}/order", "archive": f"{root}/archive/arch_order_1996"}
        parts = [spark.read.parquet(path).select(*columns, F.lit(place).alias("place")) for place, path in places.items()]
        return parts[0].unionByName(parts[1])

    return on_shop(build)


def _inferred(s: Shop) -> DataFrame:
    """Sellers as text with zip codes of five digits, read with inferred types; zip codes stay text."""
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "csv-inferred")
    text = s.seller.select("seller_id", F.lpad(F.col("zip_code_prefix").cast("string"), 5, "0").alias("zip_code_prefix"), "seller_city", "seller_state")
    text.write.options(header=True, quoteAll=True, escape='"').csv(path)
    found = files.read_inferred(spark, path, ["zip_code_prefix"])
    types = F.lit(" ".join(f.dataType.simpleString() for f in found.schema.fields)).alias("types")
    return found.select(F.col("seller_id").cast("bigint").alias("seller_id"), "zip_code_prefix", "seller_city", "seller_state", types)


def _marked(s: Shop) -> DataFrame:
    """Categories as text whose files begin with a byte-order mark."""
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "csv-marked")
    s.product_category.toDF("\ufeffcategory_name", "name_english").write.option("header", True).csv(path)
    found = files.read_csv(spark, path, "category_name string, name_english string")
    return found.where(F.col("category_name") != "category_name")


def _one_year(s: Shop) -> DataFrame:
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "one-year")
    sinks.write_by_year(_orders(s), path)
    return files.read_year(spark, path, 1997).select("order_id", "order_status", "purchase_year")


def _renamed(s: Shop) -> DataFrame:
    """Customers under the names of the exploration files, stored and read back."""
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "renamed")
    names = {"customer_id": "customer_id", "zip_code_prefix": "customer_zip_code_prefix", "customer_state": "state"}
    sinks.append(load.renamed(s.customer, names), path)
    return files.read_table(spark, path)


def _without_period(s: Shop) -> DataFrame:
    """Orders from text get the column that the text does not have, of the type the schema asks for."""
    time = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    none = F.lit(None).cast("string")
    raw = _orders(s).select(
        "order_id", "customer_id", "order_status", time("order_purchase_timestamp"), none.alias("order_approved_at"),
        none.alias("order_delivered_carrier_date"), time("order_delivered_customer_date"), time("order_estimated_delivery_date"),
    )
    found = load.clean_order(raw)
    kind = F.lit(found.schema["promotion_period"].dataType.simpleString()).alias("type")
    return found.select("order_id", F.col("promotion_period").isNull().alias("missing"), kind)


_SWEEP = "2024-04-20 12:00:00"


def _swept(s: Shop) -> DataFrame:
    """Events laid out by day of expiry, some with a later or no expiry, after a sweep."""
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "expiry")
    events = s.event_logs.select("event_id", F.col("ttl_expire").cast("timestamp").alias("ttl_expire"))
    expiry.write_by_expiry(events, path, "ttl_expire")
    old, later = F.col("ttl_expire"), F.col("ttl_expire") + F.expr("interval 30 days")
    new = F.when(F.col("event_id") % 2 == 0, later)
    changes = events.where("event_id % 10 in (0, 5)").select("event_id", old.alias("old"), new.alias("new"))
    expiry.change_expiry(spark, path, "ttl_expire", "event_id", changes)
    expiry.sweep(spark, path, "ttl_expire", _SWEEP)
    return expiry.read_by_expiry(spark, path)


def _loaded_once(s: Shop) -> DataFrame:
    """A load that finds rows in place writes nothing."""
    spark, path = s.order.sparkSession, workspace(s.order.sparkSession, "load-once")
    written = [sinks.load_once(_deliveries(s), path) for _ in range(2)]
    found = spark.read.parquet(path).select("order_id", "order_status")
    return found.withColumn("written", F.lit(" ".join(str(w).lower() for w in written)))


def _split(s: Shop) -> DataFrame:
    """Orders from 1999 on start in one open-ended part and end in their years."""
    spark, root = s.order.sparkSession, workspace(s.order.sparkSession, "split")
    year = F.year("order_purchase_timestamp")
    sinks.write_by_year(_orders(s).where(year < 1999), f"{root}/order")
    sinks.append(_orders(s).where(year >= 1999), f"{root}/order_future")
    split_open_partition(spark, f"{root}/order_future", f"{root}/order", ORDER_KEY)
    return spark.read.parquet(f"{root}/order").groupBy("purchase_year").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("order_id").alias("ids")
    )


QUERIES = {
    "src1_csv_orders": on_shop(_csv_orders),
    "src1_csv_customers": _csv(
        "customer", lambda s: s.customer, lambda s, raw: load.clean_customer(raw), "customer_id", "customer_unique_id", "zip_code_prefix"
    ),
    "src1_csv_sellers": _csv("seller", lambda s: s.seller, lambda s, raw: raw, "seller_id", "zip_code_prefix"),
    "src1_csv_categories": _csv("product_category", lambda s: s.product_category, lambda s, raw: raw),
    "src1_csv_products": _csv(
        "product",
        raw_products,
        lambda s, raw: load.clean_product(raw),
        "product_id",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
    ),
    "src1_csv_geolocation": _csv(
        "geolocation", raw_geolocation, lambda s, raw: load.clean_geolocation(raw), "zip_code_prefix"
    ),
    "src1_csv_items": _csv("order_item", raw_items, _child(load.clean_order_item), "product_id", "seller_id", "order_item_id"),
    "src1_csv_payments": _csv(
        "payment", lambda s: s.payment, _child(load.clean_payment), "payment_sequential", "payment_installments"
    ),
    "src1_csv_reviews": _csv("review", _raw_reviews, _review_out, "review_id"),
    "src2_csv_inferred": on_shop(_inferred),
    "src3_csv_with_mark": on_shop(_marked),
    "src8_one_year": on_shop(_one_year),
    "snk6_renamed": on_shop(_renamed),
    "snk12_added_column": on_shop(_without_period),
    "snk13_load_once": on_shop(_loaded_once),
    "snk1_insert_new_stored": on_shop(_inserted_twice),
    "snk3_tsv": on_shop(_tsv),
    "snk4_quoted_csv": on_shop(_quoted),
    "snk5_json_documents": on_shop(_json_sessions),
    "snk14_year_layout": on_shop(_year_of_layout),
    "snk15_clustered_layout": on_shop(_clustered),
    "snk16_filtered_copy": _filtered("late_orders", lambda s: s.order, *_LATE),
    "snk16_filtered_copy_stale": _filtered("late_orders", lambda s: s.order, *_LATE, then="second"),
    "snk16_filtered_copy_repeated": _filtered("late_orders", lambda s: s.order, *_LATE, then="first"),
    "snk16_boleto_or_voucher": _filtered("boleto_or_voucher", lambda s: s.payment, "order_id", "payment_sequential", "payment_type"),
    "snk16_weight_from_20": _filtered("weight_from_20", lambda s: s.product, "product_id", "product_weight_g"),
    "snk16_score_from_4": _filtered("score_from_4", lambda s: s.products_catalog, "product_id", "avg_review_score"),
    "snk16_product_views": _filtered("product_views", lambda s: s.event_logs, "event_id", "event_type"),
    "r1_archive_year": _archived(False),
    "r1_archive_late_rows": _archived(True),
    "r3_split_open_partition": on_shop(_split),
    "r4_sweep_by_day": on_shop(_swept),
}

_DELIVERED = f"""
    SELECT order_id, order_status, {stamp('delivered_at')} AS order_delivered_customer_date FROM v_order"""

_LATE_SQL = f"""
    SELECT order_id, {stamp('delivered_at')} AS order_delivered_customer_date,
           {stamp('estimated_at')} AS order_estimated_delivery_date FROM v_order WHERE delivered_at > estimated_at"""
_PLACES_SQL = f"""
    SELECT order_id, customer_id, order_status, {stamp('ts')} AS order_purchase_timestamp, year(ts) AS purchase_year,
           CASE WHEN year(ts) = 1996 THEN 'archive' ELSE 'active' END AS place FROM v_order"""

SQL = {
    "src1_csv_orders": f"""
        SELECT order_id, customer_id, order_status, {stamp('ts')} AS order_purchase_timestamp,
               NULL::VARCHAR AS order_approved_at, {stamp('delivered_at')} AS order_delivered_customer_date,
               {stamp('estimated_at')} AS order_estimated_delivery_date FROM v_order""",
    "src1_csv_customers": f"""
        SELECT {dbl('customer_id')} AS customer_id, {dbl('customer_unique_id')} AS customer_unique_id,
               {dbl('zip_code_prefix')} AS zip_code_prefix, customer_city, customer_state FROM v_customer""",
    "src1_csv_sellers": f"""
        SELECT {dbl('seller_id')} AS seller_id, {dbl('zip_code_prefix')} AS zip_code_prefix, seller_city, seller_state
        FROM v_seller""",
    "src1_csv_categories": "SELECT category_name, name_english FROM v_category",
    "src1_csv_products": loads.SQL["snk7_clean_product"].replace("p_partkey AS product_id", "CAST(p_partkey AS DOUBLE) AS product_id"),
    "src1_csv_geolocation": loads.SQL["snk2_first_place_per_zip"].replace(
        "zip AS zip_code_prefix,", "CAST(zip AS DOUBLE) AS zip_code_prefix,"
    ),
    "src1_csv_items": f"""
        SELECT l_orderkey AS order_id, {dbl('l_linenumber')} AS order_item_id, {dbl('l_partkey')} AS product_id,
               {dbl('l_suppkey')} AS seller_id, {stamp('l_shipdate')} AS shipping_limit_date,
               {dbl('CAST(l_extendedprice AS DECIMAL(12,2))')} AS price,
               {dbl('CAST(l_quantity AS DECIMAL(10,2))')} AS freight_value, {stamp('ts')} AS order_purchase_timestamp
        FROM lineitem JOIN v_order ON order_id = l_orderkey WHERE l_orderkey % 23 <> 0""",
    "src1_csv_payments": f"""
        SELECT order_id, {dbl('seq')} AS payment_sequential, payment_type, {dbl('payment_installments')} AS payment_installments,
               {dbl('payment_value')} AS payment_value, {stamp('ts')} AS order_purchase_timestamp FROM v_payment""",
    "src1_csv_reviews": f"""
        SELECT {dbl('review_id')} AS review_id, order_id, {dbl('review_score')} AS review_score,
               NULL::VARCHAR AS review_comment_title, 'first, "line"|second ' || order_id AS review_comment_message,
               {stamp('ts')} AS review_creation_date, NULL::VARCHAR AS review_answer_timestamp,
               {stamp('ts')} AS order_purchase_timestamp FROM v_review""",
    "snk1_insert_new_stored": f"""
        SELECT order_id, order_item_id, product_id, seller_id, {dbl('price')} AS price FROM v_item
        QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id, seller_id, v_item.price) = 1""",
    "src2_csv_inferred": """
        SELECT seller_id, lpad(CAST(zip_code_prefix AS VARCHAR), 5, '0') AS zip_code_prefix, seller_city, seller_state,
               'int string string string' AS types FROM v_seller""",
    "src3_csv_with_mark": "SELECT category_name, name_english FROM v_category",
    "src8_one_year": "SELECT order_id, order_status, 1997 AS purchase_year FROM v_order WHERE year(ts) = 1997",
    "snk6_renamed": """
        SELECT customer_id, zip_code_prefix AS customer_zip_code_prefix, customer_state AS state FROM v_customer""",
    "snk12_added_column": """
        SELECT order_id, true AS missing, 'struct<lower:timestamp,upper:timestamp,lower_inc:boolean,upper_inc:boolean>' AS type FROM v_order""",
    "snk13_load_once": "SELECT order_id, order_status, 'true false' AS written FROM v_order",
    "snk3_tsv": f"""
        SELECT order_id, order_status || chr(9) || 'and' || chr(10) || 'more' || chr(92) || 'n' AS order_status,
               {stamp('delivered_at')} AS order_delivered_customer_date FROM v_order""",
    "snk4_quoted_csv": _DELIVERED,
    "snk5_json_documents": f"""
        SELECT id AS _id, round({dbl('sum(quantity * unit_price)')}, 2) AS total FROM v_line GROUP BY 1""",
    "snk14_year_layout": f"""
        SELECT order_id, {stamp('ts')} AS order_purchase_timestamp, 1997 AS purchase_year FROM v_order
        WHERE ts >= TIMESTAMP '1997-10-01' AND ts < TIMESTAMP '1998-01-01'""",
    "snk15_clustered_layout": """
        SELECT order_id, customer_id FROM v_order WHERE ts >= TIMESTAMP '1998-03-01' AND ts < TIMESTAMP '1998-04-01'""",
    "snk16_filtered_copy": _LATE_SQL,
    "snk16_filtered_copy_stale": _LATE_SQL,
    "snk16_filtered_copy_repeated": _LATE_SQL,
    "snk16_boleto_or_voucher": """
        SELECT order_id, seq AS payment_sequential, payment_type FROM v_payment WHERE payment_type IN ('voucher', 'boleto')""",
    "snk16_weight_from_20": "SELECT product_id, product_weight_g FROM v_product WHERE NOT product_weight_g < 20",
    "snk16_score_from_4": "SELECT product_id, avg_review_score FROM v_catalog WHERE NOT avg_review_score < 4",
    "snk16_product_views": "SELECT event_id, event_type FROM v_event WHERE event_type = 'product_view'",
    "r1_archive_year": _PLACES_SQL,
    "r1_archive_late_rows": _PLACES_SQL,
    "r4_sweep_by_day": f"""
        SELECT event_id, {stamp('until')} AS ttl_expire, strftime(until, '%Y-%m-%d') AS expiry_day
        FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN ttl_expire + INTERVAL '30' DAY
                                    WHEN event_id % 10 = 5 THEN NULL ELSE ttl_expire END AS until FROM v_event)
        WHERE until IS NULL OR until > TIMESTAMP '2024-04-20 12:00:00'""",
    "r3_split_open_partition": """
        SELECT year(ts) AS purchase_year, count(*) AS filas, CAST(sum(order_id) AS BIGINT) AS ids FROM v_order GROUP BY 1""",
}
SQL = {name: with_views(body) if body.lstrip()[:4] != "WITH" else body for name, body in SQL.items()}
