"""Document queries over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.entries import on_shop
from tradewind.entries.views import dbl, day, stamp, with_views
from tradewind.plans import catalog as C

AS_OF = "2024-01-30 12:00:00"
USER = 8
SESSION = "8-2024-01-01"
CATEGORY = "PROMO"


def _joined(arr: str, *fields: str) -> Column:
    """An array of structs as text: fields by ``:``, elements by ``|``."""
    return F.array_join(F.transform(arr, lambda r: F.concat_ws(":", *[r[f].cast("string") for f in fields])), "|")


def _cart(df: DataFrame) -> DataFrame:
    return df.withColumn("cart", _joined("cart", "product_id", "quantity", "unit_price"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, 6))
    return df


def _tags(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.array_join("tags", " "))


def _late(s):
    out = C.category_weights_late(s.products_catalog, s.event_logs, CATEGORY)
    return _rounded(
        out.withColumn("event_stats", _joined("event_stats", "_id", "count")).withColumn(
            "sample_products", _joined("sample_products", "product_id", "weight_g")
        ),
        "avg_weight_g",
        "avg_weight_kg",
    )


def _early(s):
    out = C.category_weights_early_products(s.products_catalog, s.event_logs, CATEGORY)
    return _rounded(
        out.withColumn("event_stats", _joined("event_stats", "_id", "count")),
        "avg_weight_g",
        "avg_weight_kg",
        "avg_height_cm",
    )


def _weighted(s):
    out = C.weighted_categories(s.products_catalog)
    return _rounded(
        out.withColumn("top_products", _joined("top_products", "product_id", "product_weight_g")),
        "avgWeight",
        "weightedScore",
    )


_EVENT_COLUMNS = ["event_id", "event_type", "customer_unique_id", "session_id", "product_id", "category", "timestamp"]

QUERIES = {
    "m1_products_in_category": on_shop(lambda s: C.products_in_category(s.products_catalog, CATEGORY)),
    "m2_search_products": on_shop(lambda s: _rounded(C.search_products(s.products_catalog, "plate bolt"), "score")),
    "m3_products_with_spec": on_shop(
        lambda s: C.products_with_spec(s.products_catalog, "$.connectivity", "Bluetooth")
    ),
    "m4_products_with_tag": on_shop(lambda s: _tags(C.products_with_tag(s.products_catalog, "bolt"))),
    "m5_best_rated": on_shop(lambda s: C.best_rated(s.products_catalog)),
    "m6_score_per_category": on_shop(lambda s: _rounded(C.score_per_category(s.products_catalog), "avgScore")),
    "m7_recent_events_of_customer": on_shop(
        lambda s: C.recent_events_of_customer(s.event_logs, USER, AS_OF).select(*_EVENT_COLUMNS)
    ),
    "m8_session_timeline": on_shop(lambda s: C.session_timeline(s.event_logs, SESSION)),
    "m9_events_by_type": on_shop(lambda s: C.events_by_type(s.event_logs)),
    "m10_most_viewed": on_shop(lambda s: C.most_viewed(s.event_logs)),
    "m11_active_carts": on_shop(lambda s: _cart(C.active_carts(s.user_sessions, AS_OF))),
    "m12_active_cart_of": on_shop(lambda s: _cart(C.active_cart_of(s.user_sessions, USER, "2024-01-15 12:00:00"))),
    "m13_cart_totals": on_shop(lambda s: C.cart_totals(s.user_sessions)),
    "m13_cart_total_of_session": on_shop(lambda s: C.cart_totals(s.user_sessions, "sess_7")),
    "m14_cart_products": on_shop(lambda s: C.cart_products(s.user_sessions, s.products_catalog)),
    "m14_enriched_cart_lines": on_shop(lambda s: C.enriched_cart_lines(s.user_sessions, s.products_catalog)),
    "m15a_by_height_range": on_shop(lambda s: C.by_height_range(s.products_catalog, CATEGORY, 10, 30)),
    "m15b_by_height_range_desc": on_shop(lambda s: C.by_height_range(s.products_catalog, CATEGORY, 10, 30, True)),
    "m16_category_name_matches": on_shop(lambda s: C.category_name_matches(s.products_catalog, "AR")),
    "m17_category_name_search": on_shop(
        lambda s: _rounded(C.category_name_search(s.products_catalog, "promo small"), "score")
    ),
    "m18a_heavy_products": on_shop(lambda s: C.heavy_products(s.products_catalog, CATEGORY, 2000)),
    "m18b_heavy_products_desc": on_shop(lambda s: C.heavy_products(s.products_catalog, CATEGORY, 2000, True)),
    "m19a_category_weights_late": on_shop(_late),
    "m19b_category_weights_early": on_shop(_early),
    "m20a_category_mean_late": on_shop(
        lambda s: _rounded(C.category_mean_late(s.products_catalog, CATEGORY, 500), "avg_weight_g")
    ),
    "m20b_category_mean_early": on_shop(
        lambda s: _rounded(C.category_mean_early(s.products_catalog, CATEGORY, 500), "avg_weight_g")
    ),
    "m21a_largest_categories": on_shop(lambda s: _rounded(C.largest_categories(s.products_catalog), "avgWeight")),
    "m21b_largest_categories_heavy": on_shop(
        lambda s: _rounded(C.largest_categories_heavy(s.products_catalog, 1000), "avgWeight")
    ),
    "m22_weighted_categories": on_shop(_weighted),
    "m23a_weight_range_regex": on_shop(lambda s: C.weight_range_regex(s.products_catalog, 500, 2500, "econ")),
    "m23b_weight_range_search": on_shop(
        lambda s: _rounded(C.weight_range_search(s.products_catalog, 500, 2500, "economy"), "score")
    ),
    "m24_events_since": on_shop(lambda s: C.events_since(s.event_logs, "product_view", "2024-01-25")),
    "m25_sessions_of_customer": on_shop(lambda s: _cart(C.sessions_of_customer(s.user_sessions, USER))),
    "m26_best_rated_per_category": on_shop(lambda s: C.best_rated_per_category(s.products_catalog, 5)),
    "m27_search_in_category": on_shop(
        lambda s: _rounded(C.search_in_category(s.products_catalog, CATEGORY, "bolt"), "score")
    ),
    "m28_daily_views_by_customer": on_shop(lambda s: C.daily_views_by_customer(s.event_logs)),
    "m29_sessions_with_event": on_shop(lambda s: C.sessions_with_event(s.event_logs, "cart_add", "2024-01-20")),
    "m30a_places_in_city": on_shop(
        lambda s: _rounded(
            C.places_in_city(s.geolocation, "AFRICA", "NATION_5"), "geolocation_lat", "geolocation_lng"
        )
    ),
    "m30b_places_of_zip": on_shop(
        lambda s: _rounded(C.places_of_zip(s.geolocation, 7), "geolocation_lat", "geolocation_lng")
    ),
}

_WORDS = "list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda w: w <> '')"


def score_sql(fields: list[str], terms: list[str]) -> str:
    wanted = "[" + ", ".join(f"'{t}'" for t in terms) + "]"
    parts = []
    for field in fields:
        tokens = _WORDS.format(field)
        hits = f"len(list_filter({tokens}, lambda w: list_contains({wanted}, w)))"
        parts.append(f"coalesce(CAST({hits} AS DOUBLE) / NULLIF(len({tokens}), 0), 0)")
    return "round(" + " + ".join(parts) + ", 6)"


_TEXT = ["name", "description", "product_category_name"]
_STATS = """
    top AS (SELECT category, event_type, count(*) AS n,
                   row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, event_type) AS rn
            FROM v_event GROUP BY 1, 2),
    stats AS (SELECT category, string_agg(event_type || ':' || n, '|' ORDER BY rn) AS event_stats
              FROM top WHERE rn <= 3 GROUP BY 1)"""
_CARTS = """
    carts AS (SELECT id, string_agg(product_id || ':' || quantity || ':' || unit_price, '|' ORDER BY line) AS cart
              FROM v_line GROUP BY 1)"""
_BY_WEIGHT = f"""
    SELECT product_id, product_category_name, product_weight_g, product_height_cm FROM v_catalog
    WHERE product_category_name = '{CATEGORY}' AND product_height_cm BETWEEN 10 AND 30"""
_HEAVY = f"""
    SELECT product_id, product_weight_g, product_category_name FROM v_catalog
    WHERE product_category_name = '{CATEGORY}' AND product_weight_g >= 2000"""

SQL = {
    "m1_products_in_category": f"""
        SELECT product_id, name, category_name_english, avg_review_score, total_reviews FROM v_catalog
        WHERE product_category_name = '{CATEGORY}'""",
    "m2_search_products": f"""
        SELECT product_id, name, {score_sql(_TEXT, ['plate', 'bolt'])} AS score FROM v_catalog WHERE score > 0""",
    "m3_products_with_spec": """
        SELECT product_id, name, CASE WHEN product_id % 3 = 0 THEN '["USB-A","Bluetooth 5.0"]' ELSE '"Bluetooth 4.2"' END
               AS connectivity FROM v_catalog WHERE product_id % 3 < 2""",
    "m4_products_with_tag": """
        SELECT product_id, name, array_to_string(tags, ' ') AS tags FROM v_catalog WHERE list_contains(tags, 'bolt')""",
    "m5_best_rated": """
        SELECT product_id, name, product_category_name, avg_review_score, total_reviews FROM v_catalog
        ORDER BY avg_review_score DESC, total_reviews DESC, product_id LIMIT 3""",
    "m6_score_per_category": """
        SELECT category_name_english AS _id, round(avg(avg_review_score), 6) AS avgScore, count(*) AS totalProducts
        FROM v_catalog GROUP BY 1""",
    "m7_recent_events_of_customer": f"""
        SELECT event_id, event_type, customer_unique_id, session_id, product_id, category, {stamp('ts')} AS timestamp
        FROM v_event WHERE customer_unique_id = {USER} AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL '24' HOUR""",
    "m8_session_timeline": f"""
        SELECT event_type, product_id, {stamp('ts')} AS timestamp FROM v_event WHERE session_id = '{SESSION}'""",
    "m9_events_by_type": "SELECT event_type AS _id, count(*) AS count FROM v_event GROUP BY 1",
    "m10_most_viewed": """
        SELECT product_id AS _id, count(*) AS views FROM v_event WHERE event_type = 'product_view'
        GROUP BY 1 ORDER BY views DESC, _id LIMIT 5""",
    "m11_active_carts": f"""
        WITH {_CARTS}
        SELECT id AS _id, customer_unique_id, cart, {stamp('expires_at')} AS expires_at
        FROM v_session JOIN carts USING (id) WHERE expires_at > TIMESTAMP '{AS_OF}'""",
    "m12_active_cart_of": f"""
        WITH {_CARTS}
        SELECT id AS _id, coalesce(cart, '') AS cart FROM v_session LEFT JOIN carts USING (id)
        WHERE customer_unique_id = {USER} AND expires_at > TIMESTAMP '2024-01-15 12:00:00'
        ORDER BY created_at DESC, id LIMIT 1""",
    "m13_cart_totals": f"SELECT id AS _id, {dbl('sum(quantity * unit_price)')} AS total FROM v_line GROUP BY 1",
    "m13_cart_total_of_session": f"""
        SELECT id AS _id, {dbl('sum(quantity * unit_price)')} AS total FROM v_line WHERE id = 'sess_7' GROUP BY 1""",
    "m14_cart_products": """
        SELECT product_id, name, category_name_english, avg_review_score FROM v_catalog
        WHERE product_id IN (SELECT product_id FROM v_line)""",
    "m14_enriched_cart_lines": f"""
        SELECT l.id AS _id, l.product_id, quantity, {dbl('unit_price')} AS unit_price, name, category_name_english,
               avg_review_score
        FROM v_line l JOIN v_catalog c ON l.product_id = c.product_id""",
    "m15a_by_height_range": _BY_WEIGHT,
    "m15b_by_height_range_desc": _BY_WEIGHT,
    "m16_category_name_matches": """
        SELECT product_id, category_name_english, product_category_name FROM v_catalog
        WHERE regexp_matches(category_name_english, 'AR', 'i')""",
    "m17_category_name_search": f"""
        SELECT product_id, category_name_english, product_category_name,
               {score_sql(['category_name_english'], ['promo', 'small'])} AS score FROM v_catalog WHERE score > 0""",
    "m18a_heavy_products": _HEAVY,
    "m18b_heavy_products_desc": _HEAVY,
    "m19a_category_weights_late": f"""
        WITH {_STATS},
        sample AS (SELECT product_category_name AS c, product_id, product_weight_g,
                          row_number() OVER (PARTITION BY product_category_name ORDER BY product_id) AS rn FROM v_catalog),
        samples AS (SELECT c, string_agg(product_id || ':' || product_weight_g, '|' ORDER BY rn) AS sample_products
                    FROM sample WHERE rn <= 3 GROUP BY 1),
        g AS (SELECT product_category_name AS c, avg(product_weight_g) AS w, count(*) AS n FROM v_catalog GROUP BY 1)
        SELECT g.c AS category_name, round(w, 6) AS avg_weight_g, n AS total_products, event_stats, sample_products,
               round(w / 1000, 6) AS avg_weight_kg
        FROM g LEFT JOIN stats ON stats.category = g.c LEFT JOIN samples ON samples.c = g.c
        WHERE g.c = '{CATEGORY}' AND w >= 20""",
    "m19b_category_weights_early": f"""
        WITH {_STATS},
        kept AS (SELECT * FROM v_catalog WHERE product_category_name = '{CATEGORY}' AND product_weight_g >= 20),
        g AS (SELECT product_category_name AS c, avg(product_weight_g) AS w, count(*) AS n, avg(product_height_cm) AS h
              FROM kept GROUP BY 1)
        SELECT g.c AS _id, product_id, product_weight_g AS weight_g, round(w, 6) AS avg_weight_g, n AS total_products,
               round(h, 6) AS avg_height_cm, round(w / 1000, 6) AS avg_weight_kg, n AS sample_count, event_stats
        FROM kept JOIN g ON kept.product_category_name = g.c LEFT JOIN stats ON stats.category = g.c""",
    "m20a_category_mean_late": f"""
        SELECT product_category_name AS _id, round(avg(product_weight_g), 6) AS avg_weight_g, count(*) AS count
        FROM v_catalog GROUP BY 1 HAVING _id = '{CATEGORY}' AND avg(product_weight_g) >= 500""",
    "m20b_category_mean_early": f"""
        SELECT product_category_name AS _id, round(avg(product_weight_g), 6) AS avg_weight_g, count(*) AS count
        FROM v_catalog WHERE product_category_name = '{CATEGORY}' AND product_weight_g >= 500 GROUP BY 1""",
    "m21a_largest_categories": """
        SELECT * FROM (SELECT product_category_name AS _id, count(*) AS count, round(avg(product_weight_g), 6) AS avgWeight
                       FROM v_catalog GROUP BY 1 ORDER BY count DESC, _id LIMIT 10) WHERE avgWeight >= 0""",
    "m21b_largest_categories_heavy": """
        SELECT product_category_name AS _id, count(*) AS count, round(avg(product_weight_g), 6) AS avgWeight
        FROM v_catalog WHERE product_weight_g >= 1000 GROUP BY 1 ORDER BY count DESC, _id LIMIT 10""",
    "m22_weighted_categories": """
        WITH heavy AS (SELECT * FROM v_catalog WHERE product_weight_g >= 100 AND product_category_name IS DISTINCT FROM ''),
        ranked AS (SELECT product_category_name AS c, product_id, product_weight_g,
                          row_number() OVER (PARTITION BY product_category_name ORDER BY product_weight_g DESC, product_id) AS rn
                   FROM heavy),
        tops AS (SELECT c, string_agg(product_id || ':' || product_weight_g, '|' ORDER BY rn) AS top_products
                 FROM ranked WHERE rn <= 3 GROUP BY 1),
        g AS (SELECT product_category_name AS _id, count(*) AS count, avg(product_weight_g) AS w FROM heavy GROUP BY 1)
        SELECT _id, count, round(w, 6) AS avgWeight, round(w * ln(count + 1), 6) AS weightedScore, top_products
        FROM g LEFT JOIN tops ON c = _id ORDER BY w * ln(count + 1) DESC, _id LIMIT 10""",
    "m23a_weight_range_regex": """
        SELECT product_id, category_name_english, product_category_name FROM v_catalog
        WHERE product_weight_g BETWEEN 500 AND 2500 AND regexp_matches(category_name_english, 'econ', 'i')""",
    "m23b_weight_range_search": f"""
        SELECT product_id, product_weight_g, category_name_english, {score_sql(['category_name_english'], ['economy'])} AS score
        FROM v_catalog WHERE product_weight_g BETWEEN 500 AND 2500 AND score > 0 ORDER BY score DESC, product_id LIMIT 10""",
    "m24_events_since": f"""
        SELECT session_id, {stamp('ts')} AS timestamp, category FROM v_event
        WHERE event_type = 'product_view' AND ts >= TIMESTAMP '2024-01-25'""",
    "m25_sessions_of_customer": f"""
        WITH {_CARTS}
        SELECT id AS _id, {stamp('created_at')} AS created_at, coalesce(cart, '') AS cart
        FROM v_session LEFT JOIN carts USING (id) WHERE customer_unique_id = {USER}""",
    "m26_best_rated_per_category": """
        SELECT product_category_name, product_id, avg_review_score FROM v_catalog
        QUALIFY row_number() OVER (PARTITION BY product_category_name ORDER BY avg_review_score DESC, product_id) <= 5""",
    "m27_search_in_category": f"""
        SELECT product_id, name, {score_sql(['name', 'description', "array_to_string(tags, ' ')"], ['bolt'])} AS score
        FROM v_catalog WHERE product_category_name = '{CATEGORY}' AND score > 0""",
    "m28_daily_views_by_customer": f"""
        SELECT customer_unique_id, {day('ts')} AS day, count(*) AS views FROM v_event
        WHERE event_type = 'product_view' GROUP BY 1, 2""",
    "m29_sessions_with_event": f"""
        SELECT session_id, count(*) AS events, {stamp('min(ts)')} AS first_seen, {stamp('max(ts)')} AS last_seen
        FROM v_event WHERE event_type = 'cart_add' AND ts >= TIMESTAMP '2024-01-20' GROUP BY 1""",
    "m30a_places_in_city": """
        SELECT zip AS geolocation_zip_code_prefix, round(lat, 6) AS geolocation_lat, round(lng, 6) AS geolocation_lng,
               city AS geolocation_city, state AS geolocation_state FROM v_geo WHERE state = 'AFRICA' AND city = 'NATION_5'""",
    "m30b_places_of_zip": """
        SELECT zip AS geolocation_zip_code_prefix, round(lat, 6) AS geolocation_lat, round(lng, 6) AS geolocation_lng,
               city AS geolocation_city, state AS geolocation_state FROM v_geo WHERE zip = 7""",
}
SQL = {name: with_views(body) for name, body in SQL.items()}
