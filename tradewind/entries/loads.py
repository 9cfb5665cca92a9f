"""Loads, retention and streams over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.entries import on_shop, with_nulls
from tradewind.entries.views import dbl, stamp, with_views
from tradewind.functions import documents as D
from tradewind.functions import ranges
from tradewind.functions.temporal import next_year, seconds_between
from tradewind.operators.lifecycle import classify_partitions, ttl_split, with_event_ttl, with_session_ttl
from tradewind.operators.upsert import insert_new
from tradewind.plans.reports import partition_summary
from tradewind.session import workspace
from tradewind.sources import load as L
from tradewind.sources.star_views import Shop
from tradewind.streaming import events as S

_ITEM = ["order_id", "order_item_id"]


def _upserted(s: Shop) -> DataFrame:
    """Items of even orders are there already at a higher price; all items come in."""
    items = s.order_item.select(*_ITEM, "product_id", "seller_id", "price")
    raised = items.where(F.col("order_id") % 2 == 0).withColumn("price", (F.col("price") + 1).cast("decimal(12,2)"))
    return insert_new(insert_new(raised.where(F.lit(False)), raised, _ITEM), items, _ITEM)


def raw_geolocation(s: Shop) -> DataFrame:
    text = lambda c: F.col(c).cast("decimal(9,6)").cast("string")
    return s.geolocation.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        text("geolocation_lat").alias("latitude"),
        text("geolocation_lng").alias("longitude"),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").alias("state"),
    )


def raw_products(s: Shop) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    weight = (
        F.when(key % 7 == 0, "").when(key % 5 == 0, "0").when(key % 11 == 0, "-1").otherwise(F.concat(size, F.lit("00")))
    )
    return s.table("part").select(
        key.alias("product_id"),
        F.when(key % 13 == 0, F.lit("")).otherwise(F.col("p_type")).alias("category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        F.lit("").alias("product_description_lenght"),
        F.when(key % 3 == 0, F.lit(None).cast("string")).otherwise("2").alias("product_photos_qty"),
        weight.alias("product_weight_g"),
        size.alias("product_length_cm"),
        F.when(key % 4 == 0, "").otherwise(size).alias("product_height_cm"),
        F.lit("x").alias("product_width_cm"),
    )


def _translation(s: Shop) -> DataFrame:
    return s.product_category.where(F.col("category_name") != "PROMO")


def raw_items(s: Shop) -> DataFrame:
    """Item rows as text; every 23rd names an order that does not exist."""
    key = F.col("l_orderkey")
    return s.table("lineitem").select(
        F.when(key % 23 == 0, key + 10**9).otherwise(key).alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").cast("string").alias("freight_value"),
    )


def _live(s: Shop) -> DataFrame:
    live, _ = ttl_split(s.event_logs, "ttl_expire", "2024-04-15")
    return live.select("event_id", "ttl_expire")


def _expired(s: Shop) -> DataFrame:
    _, gone = ttl_split(s.event_logs, "ttl_expire", "2024-04-15")
    return gone.select("event_id", "ttl_expire")


def _derived_ttl(s: Shop) -> DataFrame:
    """Every third event has lost its expiry and gets a derived one; the others keep theirs."""
    events = s.event_logs.withColumn(
        "ttl_expire", F.when(F.col("event_id") % 3 != 0, F.col("ttl_expire") + F.expr("interval 2 days"))
    )
    return with_event_ttl(events).select("event_id", "ttl_expire")


def _session_ttl(s: Shop) -> DataFrame:
    return with_session_ttl(s.user_sessions.drop("expires_at")).select("_id", "expires_at")


def _policy(s: Shop) -> DataFrame:
    years = partition_summary(s.order).select("purchase_year", "filas")
    return classify_partitions(years, 2008, F.col("purchase_year") % 2 == 0)


def _keys(s: Shop) -> DataFrame:
    spec = F.col("specifications")
    return s.product.select(
        "product_id",
        D.has_key(spec, "material").alias("has_material"),
        D.has_any_key(spec, ["color", "material"]).alias("any_key"),
        D.has_all_keys(spec, ["voltagem", "material"]).alias("all_keys"),
        D.contains_all(F.col("tags"), ["red", "bolt"]).alias("red_bolt"),
    )


def _range_tests(s: Shop) -> DataFrame:
    kind = s.order.schema["order_purchase_timestamp"].dataType
    window = ranges.make_range(F.lit("1998-01-01").cast(kind), F.lit("1998-06-30").cast(kind), "[]")
    period = F.col("promotion_period")
    return s.order.select(
        "order_id",
        ranges.contains_point(period, F.col("order_purchase_timestamp")).cast("string").alias("holds_purchase"),
        ranges.contained_by(period, window).cast("string").alias("inside_window"),
        seconds_between(F.col("order_estimated_delivery_date"), F.col("order_purchase_timestamp")).alias("promised"),
        next_year("1998-03-01").alias("next_year"),
    )


def _pairs_column(s: Shop) -> DataFrame:
    """Seller settings held as ``key => value`` text."""
    text = F.concat(F.lit("shipping_days => "), (F.col("s_suppkey") % 7).cast("string"), F.lit(", accepts_returns => true"))
    settings = D.parse_pairs(text)
    return s.table("supplier").select(
        "s_suppkey",
        settings["shipping_days"].cast("int").alias("shipping_days"),
        settings["accepts_returns"].alias("accepts_returns"),
    )


def _feed(raw: DataFrame) -> DataFrame:
    """Events under the event log's names."""
    return raw.select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), F.col("user_id").alias("customer_unique_id"), "event_type"
    )


def _stream(s: Shop) -> DataFrame:
    """The events file as a stream."""
    raw = (
        s.order.sparkSession.readStream.schema(s.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(s._folder)
    )
    return _feed(raw)


def _windowed(s: Shop) -> DataFrame:
    """Closed windows as the stream delivers them, and the open ones."""
    spark, root = s.order.sparkSession, workspace(s.order.sparkSession, "event-counts")
    return S.with_open(S.advance(S.event_counts(_stream(s)), root), S.open_counts(spark, root))


def _sessions(s: Shop) -> DataFrame:
    spark, root = s.order.sparkSession, workspace(s.order.sparkSession, "sessions")
    return S.with_open(S.advance(S.session_summaries(_stream(s)), root), S.open_sessions(spark, root))


def _ingested(s: Shop) -> DataFrame:
    """Every event arrives twice and is kept once."""
    twice = _stream(s).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    kept = S.deduplicated(twice, ["event_id"])
    return S.run_available(s.order.sparkSession, kept, "ingest").select("event_id", "timestamp", "ttl_expire")


QUERIES = {
    "snk1_insert_new": on_shop(_upserted),
    "snk2_first_place_per_zip": on_shop(lambda s: L.clean_geolocation(raw_geolocation(s))),
    "snk7_clean_product": on_shop(
        lambda s: with_nulls(
            L.clean_product(raw_products(s)), "product_name_lenght", "product_description_lenght", "product_photos_qty"
        )
    ),
    "snk9a_items_with_order_time": on_shop(
        lambda s: L.clean_order_item(raw_items(s), s.order).drop("shipping_limit_date")
    ),
    "snk9b_items_with_order_time_left": on_shop(
        lambda s: L.clean_order_item(raw_items(s), s.order, "left").drop("shipping_limit_date")
    ),
    "snk10_catalog_documents": on_shop(lambda s: L.catalog_documents(raw_products(s), _translation(s))),
    "snk11_category_master": on_shop(
        lambda s: L.category_master(_translation(s), s.product)
    ),
    "r2_retention_policy": on_shop(_policy),
    "r4a_live_events": on_shop(_live),
    "r4b_expired_events": on_shop(_expired),
    "r5a_event_ttl": on_shop(_derived_ttl),
    "r5b_session_ttl": on_shop(_session_ttl),
    "s19_json_keys": on_shop(_keys),
    "s21_range_tests": on_shop(_range_tests),
    "s33_pairs": on_shop(_pairs_column),
    "st1_event_counts": on_shop(_windowed),
    "st2_session_summaries": on_shop(_sessions),
    "st3_deduplicated_ingest": on_shop(_ingested),
}

_RAW_ITEM = """
    SELECT CASE WHEN l_orderkey % 23 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS order_id,
           l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(10,2)) AS freight_value FROM lineitem"""


def _timed_sql(how: str) -> str:
    return f"""
        SELECT i.order_id, order_item_id, product_id, seller_id, {dbl('price')} AS price,
               {dbl('freight_value')} AS freight_value, {stamp('o.ts')} AS order_purchase_timestamp
        FROM ({_RAW_ITEM}) i {how} JOIN v_order o ON o.order_id = i.order_id"""


SQL = {
    "snk1_insert_new": f"""
        WITH pick AS (SELECT order_id, order_item_id, product_id, seller_id, price,
                             row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id, seller_id, price) AS rn
                      FROM v_item)
        SELECT order_id, order_item_id, product_id, seller_id,
               {dbl('CASE WHEN order_id % 2 = 0 THEN price + 1 ELSE price END')} AS price FROM pick WHERE rn = 1""",
    "snk2_first_place_per_zip": f"""
        SELECT zip AS zip_code_prefix, {dbl('CAST(lat AS DECIMAL(9,6))')} AS latitude,
               {dbl('CAST(lng AS DECIMAL(9,6))')} AS longitude, city, state FROM v_geo
        QUALIFY row_number() OVER (PARTITION BY zip ORDER BY city, state, CAST(lat AS DECIMAL(9,6)), CAST(lng AS DECIMAL(9,6))) = 1""",
    "snk7_clean_product": f"""
        SELECT p_partkey AS product_id, CASE WHEN p_partkey % 13 <> 0 THEN p_type END AS category_name,
               {dbl('length(p_name)')} AS product_name_lenght, NULL::DOUBLE AS product_description_lenght,
               {dbl('CASE WHEN p_partkey % 3 <> 0 THEN 2 END')} AS product_photos_qty,
               {dbl('CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 AND p_partkey % 11 <> 0 THEN p_size * 100 END')}
                   AS product_weight_g,
               {dbl('p_size')} AS product_length_cm, {dbl('CASE WHEN p_partkey % 4 <> 0 THEN p_size END')} AS product_height_cm,
               NULL::DOUBLE AS product_width_cm FROM part""",
    "snk9a_items_with_order_time": _timed_sql(""),
    "snk9b_items_with_order_time_left": _timed_sql("LEFT"),
    "snk10_catalog_documents": """
        SELECT p_partkey AS product_id, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE p_type END AS product_category_name,
               CASE WHEN p_partkey % 13 = 0 OR p_type = 'PROMO' THEN '' ELSE lower(p_type) END AS category_name_english,
               length(p_name) AS product_name_lenght, 0 AS product_description_lenght,
               CASE WHEN p_partkey % 3 <> 0 THEN 2 ELSE 0 END AS product_photos_qty,
               CASE WHEN p_partkey % 7 = 0 OR p_partkey % 5 = 0 THEN 0 WHEN p_partkey % 11 = 0 THEN -1 ELSE p_size * 100 END
                   AS product_weight_g,
               p_size AS product_length_cm, CASE WHEN p_partkey % 4 <> 0 THEN p_size ELSE 0 END AS product_height_cm,
               0 AS product_width_cm FROM part""",
    "snk11_category_master": """
        SELECT category_name, CASE WHEN category_name <> 'PROMO' THEN name_english END AS name_english FROM v_category""",
    "r2_retention_policy": """
        SELECT y AS purchase_year, filas, 2008 - y AS age, CASE WHEN 2008 - y <= 5 THEN 'active'
               WHEN 2008 - y > 10 AND y % 2 = 0 THEN 'delete' ELSE 'archive' END AS action
        FROM (SELECT year(ts) AS y, count(*) AS filas FROM v_order GROUP BY 1)""",
    "r4a_live_events": f"""
        SELECT event_id, {stamp('ttl_expire')} AS ttl_expire FROM v_event WHERE ttl_expire > TIMESTAMP '2024-04-15'""",
    "r4b_expired_events": f"""
        SELECT event_id, {stamp('ttl_expire')} AS ttl_expire FROM v_event WHERE ttl_expire <= TIMESTAMP '2024-04-15'""",
    "r5a_event_ttl": f"""
        SELECT event_id, {stamp("ts + INTERVAL '90' DAY + CASE WHEN event_id % 3 <> 0 THEN 2 ELSE 0 END * INTERVAL '1' DAY")}
               AS ttl_expire FROM v_event""",
    "r5b_session_ttl": f"SELECT id AS _id, {stamp('expires_at')} AS expires_at FROM v_session",
    "s19_json_keys": """
        SELECT product_id, list_contains(json_keys(specifications), 'material') AS has_material,
               list_has_any(json_keys(specifications), ['color', 'material']) AS any_key,
               list_has_all(json_keys(specifications), ['voltagem', 'material']) AS all_keys,
               list_has_all(tags, ['red', 'bolt']) AS red_bolt FROM v_product""",
    "s21_range_tests": """
        SELECT order_id, CAST(promo_lower <= ts AND ts < promo_upper AS VARCHAR) AS holds_purchase,
               CAST(TIMESTAMP '1998-01-01' <= promo_lower AND promo_upper <= TIMESTAMP '1998-06-30' AS VARCHAR) AS inside_window,
               CAST(epoch(estimated_at) - epoch(ts) AS DOUBLE) AS promised, 1999 AS next_year FROM v_order""",
    "s33_pairs": """
        SELECT s_suppkey, s_suppkey % 7 AS shipping_days, 'true' AS accepts_returns FROM supplier""",
    "st1_event_counts": f"""
        SELECT {stamp("time_bucket(INTERVAL '1 hour', ts)")} AS window_start, event_type, count(*) AS count,
               max(time_bucket(INTERVAL '1 hour', ts)) + INTERVAL '1' HOUR
                   > (SELECT max(ts) FROM events) - INTERVAL '10' MINUTE AS open
        FROM events GROUP BY 1, 2""",
    "st2_session_summaries": f"""
        WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '30' MINUTE
                                                 THEN 0 ELSE 1 END AS fresh FROM events),
        numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n
                     FROM marked),
        runs AS (SELECT user_id, min(ts) AS a, max(ts) + INTERVAL '30' MINUTE AS b, count(*) AS events
                 FROM numbered GROUP BY user_id, n)
        SELECT user_id AS customer_unique_id, {stamp('a')} AS session_start, {stamp('b')} AS session_end, events,
               b > (SELECT max(ts) FROM events) - INTERVAL '10' MINUTE AS open FROM runs""",
    "st3_deduplicated_ingest": f"""
        SELECT event_id, {stamp('ts')} AS timestamp, {stamp("ts + INTERVAL '90' DAY")} AS ttl_expire FROM events""",
}
SQL = {name: with_views(body) for name, body in SQL.items()}
