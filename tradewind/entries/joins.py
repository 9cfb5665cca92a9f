"""Distance, similarity and overlap joins over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.entries import on_shop
from tradewind.entries.reports import HAVERSINE, similarity_sql
from tradewind.entries.views import with_views
from tradewind.functions.ranges import make_range
from tradewind.functions.text import matches_any, search_terms, text_score
from tradewind.operators.matching import overlap_join, trigram_match
from tradewind.operators.proximity import nearest, within_radius
from tradewind.session import workspace
from tradewind.sources import token_table
from tradewind.sources.star_views import Shop

ZIP = 7
TERMS = "thou les"


def _zips(s: Shop, prefix: str) -> DataFrame:
    return s.zip_centroid.select(
        F.col("zip_code_prefix").alias(f"{prefix}_zip"),
        F.col("longitude").alias(f"{prefix}_lng"),
        F.col("latitude").alias(f"{prefix}_lat"),
    )


def _sellers(s: Shop) -> DataFrame:
    return s.seller.join(_zips(s, "seller"), F.col("zip_code_prefix") == F.col("seller_zip")).select(
        "seller_id", "seller_city", "seller_lng", "seller_lat"
    )


def _near_zip(s: Shop) -> DataFrame:
    """Sellers within 250 km of one zip code, nearest first."""
    here = _zips(s, "buyer").where(F.col("buyer_zip") == ZIP)
    found = within_radius(here, _sellers(s), 250, ("buyer_lng", "buyer_lat"), ("seller_lng", "seller_lat"))
    return (
        found.select("seller_id", "seller_city", F.round("distance_km", 1).alias("dist_km"))
        .orderBy("dist_km", "seller_id")
    )


def _pairs_within(s: Shop) -> DataFrame:
    found = within_radius(
        _zips(s, "buyer"), _sellers(s), 400, ("buyer_lng", "buyer_lat"), ("seller_lng", "seller_lat")
    )
    return found.select("buyer_zip", "seller_id", F.round("distance_km", 4).alias("distance_km"))


def _nearest(s: Shop) -> DataFrame:
    found = nearest(
        _zips(s, "buyer"), _sellers(s), 5, "seller_id", ("buyer_lng", "buyer_lat"), ("seller_lng", "seller_lat")
    )
    return found.select("buyer_zip", "seller_id", "rank", F.round("distance", 6).alias("distance"))


def _similar_names(s: Shop) -> DataFrame:
    a = s.table("part").select(F.col("p_name").alias("left_name"))
    b = s.table("part").select(F.col("p_name").alias("right_name"))
    return trigram_match(a, b, "left_name", "right_name", 0.5)


def _campaign_overlaps(s: Shop) -> DataFrame:
    """Promotions of orders that overlap the first ten days of a month."""
    month = F.date_trunc("month", "order_purchase_timestamp").cast("timestamp_ntz")
    campaigns = (
        s.order.select(month.alias("campaign"))
        .distinct()
        .withColumn("campaign_period", make_range(F.col("campaign"), F.col("campaign") + F.expr("interval 10 days")))
    )
    pairs = overlap_join(s.order.select("order_id", "promotion_period"), campaigns, "promotion_period", "campaign_period")
    return pairs.groupBy("campaign").agg(F.count(F.lit(1)).alias("promotions"), F.sum("order_id").alias("order_ids"))


def _documents(s: Shop) -> DataFrame:
    """Full-text search over whole documents."""
    terms, body = search_terms(TERMS), [F.col("text")]
    return s.table("documents").where(matches_any(body, terms)).select(
        "doc_id", F.round(text_score(body, terms), 6).alias("score")
    )


def _tokens(s: Shop) -> str:
    path = workspace(s.order.sparkSession, "tokens")
    token_table.write_tokens(s.table("documents"), "doc_id", ["text"], path)
    return path


def _document_tokens(s: Shop) -> DataFrame:
    """The search of ``_documents`` from a stored token table."""
    found = token_table.search(s.order.sparkSession, _tokens(s), TERMS)
    return found.select(F.col("id").alias("doc_id"), F.round("score", 6).alias("score"))


def _document_frequencies(s: Shop) -> DataFrame:
    return token_table.frequencies(s.order.sparkSession, _tokens(s))


QUERIES = {
    "p16_sellers_near_zip": on_shop(_near_zip),
    "j13_within_radius": on_shop(_pairs_within),
    "j14_nearest": on_shop(_nearest),
    "j15_similar_names": on_shop(_similar_names),
    "j16_campaign_overlaps": on_shop(_campaign_overlaps),
    "s27_document_search": on_shop(_documents),
    "s27_token_table_search": on_shop(_document_tokens),
    "s27_token_frequencies": on_shop(_document_frequencies),
}

_FAR = HAVERSINE.format("b.lat", "b.lng", "m.lat", "m.lng")

SQL = {
    "p16_sellers_near_zip": f"""
        SELECT s.seller_id, s.seller_city, round({_FAR}, 1) AS dist_km
        FROM v_zip b, v_seller s JOIN v_zip m ON m.zip = s.zip_code_prefix WHERE b.zip = {ZIP} AND {_FAR} <= 250""",
    "j13_within_radius": f"""
        SELECT b.zip AS buyer_zip, s.seller_id, round({_FAR}, 4) AS distance_km
        FROM v_zip b, v_seller s JOIN v_zip m ON m.zip = s.zip_code_prefix WHERE {_FAR} <= 400""",
    "j14_nearest": """
        SELECT b.zip AS buyer_zip, s.seller_id,
               row_number() OVER (PARTITION BY b.zip ORDER BY sqrt(pow(b.lng - m.lng, 2) + pow(b.lat - m.lat, 2)), s.seller_id)
                   AS rank,
               round(sqrt(pow(b.lng - m.lng, 2) + pow(b.lat - m.lat, 2)), 6) AS distance
        FROM v_zip b, v_seller s JOIN v_zip m ON m.zip = s.zip_code_prefix QUALIFY rank <= 5""",
    "j15_similar_names": f"""
        SELECT a.p_name AS left_name, b.p_name AS right_name, {similarity_sql('a.p_name', 'b.p_name')} AS similarity
        FROM (SELECT DISTINCT p_name FROM part) a, (SELECT DISTINCT p_name FROM part) b WHERE similarity >= 0.5""",
    "j16_campaign_overlaps": """
        SELECT strftime(m, '%Y-%m-%d %H:%M:%S.%f') AS campaign, count(*) AS promotions, CAST(sum(order_id) AS BIGINT) AS order_ids
        FROM v_order, (SELECT DISTINCT date_trunc('month', ts)::TIMESTAMP AS m FROM v_order)
        WHERE promo_lower < m + INTERVAL '10' DAY AND m < promo_upper GROUP BY 1""",
    "s27_document_search": r"""
        WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS tokens
                   FROM documents)
        SELECT doc_id, round(CAST(len(list_filter(tokens, lambda x: x IN ('thou', 'les'))) AS DOUBLE) / len(tokens), 6) AS score
        FROM w WHERE list_has_any(tokens, ['thou', 'les'])""",
}
SQL["s27_token_table_search"] = SQL["s27_document_search"]
SQL["s27_token_frequencies"] = r"""
    SELECT token, count(*) AS documents FROM (
        SELECT DISTINCT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS token FROM documents)
    GROUP BY token"""
SQL = {name: with_views(body) for name, body in SQL.items()}
