"""Queries over the document collections: product catalogue, event log, sessions, places.

Sorts follow the document store: missing values are lowest (first ascending, last descending).
Every sort ends in a unique column, so that limits are repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import temporal, text
from tradewind.functions.documents import any_element_rlike, as_variant, non_empty, not_equal_or_missing
from tradewind.operators.topk import attach_nested, nested_top, top_per_group

CATEGORY = "product_category_name"


def as_products(catalog: DataFrame) -> DataFrame:
    """The catalogue under the older collection's column name."""
    return catalog.withColumnRenamed(CATEGORY, "category_name")


def _specs(df: DataFrame) -> Column:
    col = F.col("specifications")
    return as_variant(col) if df.schema["specifications"].dataType.typeName() == "string" else col


# --- catalogue: find -------------------------------------------------------------------------------


def products_in_category(catalog: DataFrame, category: str) -> DataFrame:
    return catalog.where(F.col(CATEGORY) == category).select(
        "product_id", "name", "category_name_english", "avg_review_score", "total_reviews"
    )


def search_products(
    catalog: DataFrame, query: str, fields: tuple[str, ...] = ("name", "description", CATEGORY)
) -> DataFrame:
    """Full-text search: any term matches, most relevant first."""
    terms, columns = text.search_terms(query), [F.col(f) for f in fields]
    return (
        catalog.where(text.matches_any(columns, terms))
        .select("product_id", "name", text.text_score(columns, terms).alias("score"))
        .orderBy(F.col("score").desc(), "product_id")
    )


def search_in_category(catalog: DataFrame, category: str, query: str) -> DataFrame:
    """Full-text search over name, description and tags within one category."""
    terms = text.search_terms(query)
    columns = [F.col("name"), F.col("description"), F.array_join("tags", " ")]
    return (
        catalog.where((F.col(CATEGORY) == category) & text.matches_any(columns, terms))
        .select("product_id", "name", text.text_score(columns, terms).alias("score"))
        .orderBy(F.col("score").desc(), "product_id")
    )


def products_with_spec(catalog: DataFrame, path: str, pattern: str) -> DataFrame:
    """Regex on a nested specification that is one text or an array of texts."""
    field = path.rsplit(".", 1)[-1]
    found = catalog.withColumn("_field", F.try_variant_get(_specs(catalog), path, "variant"))
    return found.where(any_element_rlike(F.col("_field"), "$", pattern)).select(
        "product_id", "name", F.to_json("_field").alias(field)
    )


def products_with_tag(catalog: DataFrame, tag: str) -> DataFrame:
    return catalog.where(F.array_contains("tags", tag)).select("product_id", "name", "tags")


def best_rated(catalog: DataFrame, top: int = 3) -> DataFrame:
    return (
        catalog.select("product_id", "name", CATEGORY, "avg_review_score", "total_reviews")
        .orderBy(F.col("avg_review_score").desc(), F.col("total_reviews").desc(), "product_id")
        .limit(top)
    )


def best_rated_per_category(catalog: DataFrame, top: int) -> DataFrame:
    """The best rated products of every category."""
    return top_per_group(
        catalog.select(CATEGORY, "product_id", "avg_review_score"),
        [CATEGORY],
        [F.col("avg_review_score").desc(), F.col("product_id")],
        top,
    )


def by_height_range(
    catalog: DataFrame, category: str, low: float, high: float, descending: bool = False
) -> DataFrame:
    """Products of a category in a height range, by weight."""
    weight = F.col("product_weight_g").desc() if descending else F.col("product_weight_g").asc()
    return (
        catalog.where((F.col(CATEGORY) == category) & F.col("product_height_cm").between(low, high))
        .select("product_id", CATEGORY, "product_weight_g", "product_height_cm")
        .orderBy(weight, "product_id")
    )


def category_name_matches(catalog: DataFrame, pattern: str) -> DataFrame:
    """Case-insensitive regex on the English category name."""
    return catalog.where(F.col("category_name_english").rlike(f"(?i){pattern}")).select(
        "product_id", "category_name_english", CATEGORY
    )


def category_name_search(catalog: DataFrame, query: str) -> DataFrame:
    """Full-text search on the English category name, most relevant first."""
    terms, columns = text.search_terms(query), [F.col("category_name_english")]
    return (
        catalog.where(text.matches_any(columns, terms))
        .select("product_id", "category_name_english", CATEGORY, text.text_score(columns, terms).alias("score"))
        .orderBy(F.col("score").desc(), "product_id")
    )


def heavy_products(catalog: DataFrame, category: str, min_weight: float = 20, descending: bool = False) -> DataFrame:
    """Products of a category from a weight on, by weight."""
    weight = F.col("product_weight_g").desc() if descending else F.col("product_weight_g").asc()
    return (
        catalog.where((F.col("product_weight_g") >= min_weight) & (F.col(CATEGORY) == category))
        .select("product_id", "product_weight_g", CATEGORY)
        .orderBy(weight, "product_id")
    )


def weight_range_regex(catalog: DataFrame, low: float, high: float, pattern: str) -> DataFrame:
    return category_name_matches(catalog.where(F.col("product_weight_g").between(low, high)), pattern)


def weight_range_search(catalog: DataFrame, low: float, high: float, query: str, top: int = 10) -> DataFrame:
    terms, columns = text.search_terms(query), [F.col("category_name_english")]
    return (
        catalog.where(F.col("product_weight_g").between(low, high) & text.matches_any(columns, terms))
        .select(
            "product_id", "product_weight_g", "category_name_english", text.text_score(columns, terms).alias("score")
        )
        .orderBy(F.col("score").desc(), "product_id")
        .limit(top)
    )


# --- catalogue: aggregation ------------------------------------------------------------------------


def score_per_category(catalog: DataFrame) -> DataFrame:
    return (
        catalog.groupBy(F.col("category_name_english").alias("_id"))
        .agg(F.avg("avg_review_score").alias("avgScore"), F.count(F.lit(1)).alias("totalProducts"))
        .orderBy(F.col("avgScore").desc(), "_id")
    )


def event_stats(events: DataFrame, top: int = 3) -> DataFrame:
    """Per category an array of its most frequent event types."""
    counts = (
        events.where(F.col("category").isNotNull())
        .groupBy("category", "event_type")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return nested_top(
        counts,
        ["category"],
        [F.col("count").desc(), F.col("event_type")],
        top,
        [F.col("event_type").alias("_id"), F.col("count")],
        "event_stats",
    )


def category_weights_late(
    catalog: DataFrame, events: DataFrame, category: str, min_weight: float = 20, top: int = 5
) -> DataFrame:
    """Group every product, then keep categories by mean weight. Three sample products per category."""
    stats = (
        catalog.groupBy(F.col(CATEGORY).alias("category_name"))
        .agg(F.avg("product_weight_g").alias("avg_weight_g"), F.count(F.lit(1)).alias("total_products"))
        .where((F.col("category_name") == category) & (F.col("avg_weight_g") >= min_weight))
        .withColumn("avg_weight_kg", F.col("avg_weight_g") / 1000)
        .orderBy(F.col("avg_weight_g").desc(), "category_name")
        .limit(top)
    )
    samples = nested_top(
        catalog.where(F.col(CATEGORY) == category),
        [CATEGORY],
        [F.col("product_id")],
        3,
        [F.col("product_id"), F.col("product_weight_g").alias("weight_g")],
        "sample_products",
    )
    popular = event_stats(events.where(F.col("category") == category))
    out = attach_nested(stats, popular, "category_name", "category", "event_stats")
    return attach_nested(out, samples, "category_name", CATEGORY, "sample_products").select(
        "category_name", "avg_weight_g", "total_products", "event_stats", "sample_products", "avg_weight_kg"
    )


def _early(catalog: DataFrame, category: str, min_weight: float) -> DataFrame:
    return catalog.where((F.col(CATEGORY) == category) & (F.col("product_weight_g") >= min_weight))


def category_weights_early(
    catalog: DataFrame, events: DataFrame, category: str, min_weight: float = 20, top: int = 5
) -> DataFrame:
    """Keep products by weight, then group: one row per category, without its list of products."""
    stats = (
        _early(catalog, category, min_weight)
        .groupBy(F.col(CATEGORY).alias("_id"))
        .agg(
            F.avg("product_weight_g").alias("avg_weight_g"),
            F.count(F.lit(1)).alias("total_products"),
            F.avg("product_height_cm").alias("avg_height_cm"),
        )
        .withColumn("avg_weight_kg", F.col("avg_weight_g") / 1000)
        .withColumn("sample_count", F.col("total_products"))
        .orderBy(F.col("avg_weight_g").desc(), "_id")
        .limit(top)
    )
    popular = event_stats(events.where(F.col("category") == category))
    return attach_nested(stats, popular, "_id", "category", "event_stats")


def category_weights_early_products(
    catalog: DataFrame, events: DataFrame, category: str, min_weight: float = 20, top: int = 5
) -> DataFrame:
    """As above with the complete list of products, one row per product.

    A category has no bound on its products, so the list stays rows instead of one array.
    """
    stats = category_weights_early(catalog, events, category, min_weight, top)
    products = _early(catalog, category, min_weight).select(
        F.col(CATEGORY).alias("_id"), "product_id", F.col("product_weight_g").alias("weight_g")
    )
    return products.join(stats, "_id")


def category_mean_late(catalog: DataFrame, category: str, min_weight: float = 20, top: int = 5) -> DataFrame:
    """Mean weight of a category over all its products, kept if heavy enough on average."""
    return _category_means(catalog, "avg_weight_g", "count").where(
        (F.col("_id") == category) & (F.col("avg_weight_g") >= min_weight)
    ).orderBy(F.col("avg_weight_g").desc(), "_id").limit(top)


def category_mean_early(catalog: DataFrame, category: str, min_weight: float = 20, top: int = 5) -> DataFrame:
    """Mean weight of a category over its heavy products."""
    return (
        _category_means(_early(catalog, category, min_weight), "avg_weight_g", "count")
        .orderBy(F.col("avg_weight_g").desc(), "_id")
        .limit(top)
    )


def _category_means(catalog: DataFrame, mean: str, count: str) -> DataFrame:
    return catalog.groupBy(F.col(CATEGORY).alias("_id")).agg(
        F.count(F.lit(1)).alias(count), F.avg("product_weight_g").alias(mean)
    )


def largest_categories(catalog: DataFrame, top: int = 10) -> DataFrame:
    """Largest categories; the weight filter comes after the limit, so fewer rows may remain."""
    largest = _category_means(catalog, "avgWeight", "count").orderBy(F.col("count").desc(), "_id").limit(top)
    return largest.where(F.col("avgWeight") >= 0)


def largest_categories_heavy(catalog: DataFrame, min_weight: float = 100, top: int = 10) -> DataFrame:
    """Largest categories counting heavy products only."""
    heavy = catalog.where(F.col("product_weight_g") >= min_weight)
    return _category_means(heavy, "avgWeight", "count").orderBy(F.col("count").desc(), "_id").limit(top)


def weighted_categories(catalog: DataFrame, min_weight: float = 100, top: int = 10) -> DataFrame:
    """Categories by mean weight times the log of their size, each with its three heaviest products."""
    heavy = catalog.where(
        (F.col("product_weight_g") >= min_weight) & not_equal_or_missing(F.col(CATEGORY), "")
    )
    best = (
        _category_means(heavy, "avgWeight", "count")
        .withColumn("weightedScore", F.col("avgWeight") * F.ln(F.col("count") + 1))
        .orderBy(F.col("weightedScore").desc(), "_id")
        .limit(top)
    )
    wanted = best.select(F.col("_id").alias(CATEGORY))
    heaviest = nested_top(
        heavy.join(wanted, CATEGORY, "left_semi"),
        [CATEGORY],
        [F.col("product_weight_g").desc(), F.col("product_id")],
        3,
        [F.col("product_id"), F.col("product_weight_g")],
        "top_products",
    )
    return attach_nested(best, heaviest, "_id", CATEGORY, "top_products").orderBy(
        F.col("weightedScore").desc(), "_id"
    )


# --- event log -------------------------------------------------------------------------------------


def recent_events_of_customer(events: DataFrame, customer, as_of: str, hours: int = 24) -> DataFrame:
    """A customer's events of the last hours, newest first."""
    mine = events.where(F.col("customer_unique_id") == customer)
    return temporal.within_last(mine, "timestamp", as_of, hours).orderBy(F.col("timestamp").desc())


def session_timeline(events: DataFrame, session_id: str) -> DataFrame:
    """One session's events in time order."""
    columns = ["event_type", "product_id", "timestamp"]
    chosen = events.where(F.col("session_id") == session_id)
    if "metadata" in events.columns:
        return chosen.select(
            *columns, F.try_variant_get("metadata", "$.search_query", "string").alias("search_query")
        ).orderBy("timestamp")
    return chosen.select(*columns).orderBy("timestamp")


def events_by_type(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.col("event_type").alias("_id"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "_id")
    )


def most_viewed(events: DataFrame, top: int = 5) -> DataFrame:
    return (
        events.where(F.col("event_type") == "product_view")
        .groupBy(F.col("product_id").alias("_id"))
        .agg(F.count(F.lit(1)).alias("views"))
        .orderBy(F.col("views").desc(), "_id")
        .limit(top)
    )


def events_since(events: DataFrame, event_type: str, start: str) -> DataFrame:
    """Events of a type since a date, newest first."""
    return (
        temporal.since(events.where(F.col("event_type") == event_type), "timestamp", start)
        .select("session_id", "timestamp", "category")
        .orderBy(F.col("timestamp").desc(), "session_id")
    )


def daily_views_by_customer(events: DataFrame) -> DataFrame:
    """Product views per customer and day."""
    return (
        events.where(F.col("event_type") == "product_view")
        .groupBy("customer_unique_id", F.to_date("timestamp").alias("day"))
        .agg(F.count(F.lit(1)).alias("views"))
    )


def sessions_with_event(events: DataFrame, event_type: str, start: str) -> DataFrame:
    """Sessions with recent events of a type: how many, first and last."""
    return (
        temporal.since(events.where(F.col("event_type") == event_type), "timestamp", start)
        .groupBy("session_id")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
        )
    )


# --- sessions and carts ----------------------------------------------------------------------------


def active_carts(sessions: DataFrame, as_of: str) -> DataFrame:
    """Sessions that have not expired and hold at least one line."""
    return temporal.not_expired(sessions, "expires_at", as_of).where(non_empty(F.col("cart"))).select(
        "_id", "customer_unique_id", "cart", "expires_at"
    )


def active_cart_of(sessions: DataFrame, customer, as_of: str) -> DataFrame:
    """The customer's newest session that has not expired."""
    return (
        temporal.not_expired(sessions.where(F.col("customer_unique_id") == customer), "expires_at", as_of)
        .orderBy(F.col("created_at").desc(), "_id")
        .limit(1)
        .select("_id", "cart")
    )


def cart_lines(sessions: DataFrame) -> DataFrame:
    """One row per cart line; sessions with an empty or missing cart yield none."""
    return sessions.select("_id", F.explode("cart").alias("line")).select("_id", "line.*")


def cart_totals(sessions: DataFrame, session_id: str | None = None) -> DataFrame:
    """Value of every cart, folded inside its document: no rows move. Empty carts yield no row."""
    chosen = sessions if session_id is None else sessions.where(F.col("_id") == session_id)
    amounts = F.transform("cart", lambda line: line["quantity"] * line["unit_price"])
    return chosen.where(non_empty(F.col("cart"))).select("_id", _fold_sum(sessions, amounts).alias("total"))


def _fold_sum(sessions: DataFrame, amounts: Column) -> Column:
    price = sessions.schema["cart"].dataType.elementType["unit_price"].dataType
    kind = "decimal(22,2)" if price.typeName() == "decimal" else "double"
    return F.aggregate(amounts, F.lit(0).cast(kind), lambda total, x: (total + F.coalesce(x, F.lit(0))).cast(kind))


def cart_products(sessions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalogue rows of all products that lie in some cart."""
    wanted = sessions.select(F.explode("cart.product_id").alias("product_id")).distinct()
    return catalog.join(wanted, "product_id", "left_semi").select(
        "product_id", "name", "category_name_english", "avg_review_score"
    )


def enriched_cart_lines(sessions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Cart lines with the product's name, category and score."""
    products = catalog.select("product_id", "name", "category_name_english", "avg_review_score")
    return cart_lines(sessions).join(products, "product_id")


def sessions_of_customer(sessions: DataFrame, customer) -> DataFrame:
    """A customer's sessions, newest first."""
    return (
        sessions.where(F.col("customer_unique_id") == customer)
        .select("_id", "created_at", "cart")
        .orderBy(F.col("created_at").desc(), "_id")
    )


# --- places ----------------------------------------------------------------------------------------


def places_in_city(geolocation: DataFrame, state: str, city: str) -> DataFrame:
    return geolocation.where((F.col("geolocation_state") == state) & (F.col("geolocation_city") == city))


def places_of_zip(geolocation: DataFrame, zip_code) -> DataFrame:
    return geolocation.where(F.col("geolocation_zip_code_prefix") == zip_code)
