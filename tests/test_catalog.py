import pytest
from pyspark.sql import functions as F

import seeds
from helpers import plan_of
from tradewind.plans import catalog as C


@pytest.fixture(scope="module")
def products(spark):
    return seeds.catalog(spark)


@pytest.fixture(scope="module")
def events(spark):
    return seeds.events(spark)


@pytest.fixture(scope="module")
def sessions(spark):
    return seeds.sessions(spark)


def ids(df):
    return [r[0] for r in df.collect()]


def test_finds(products):
    assert ids(C.products_in_category(products, "eletronicos")) == ["phone"]
    assert sorted(ids(C.products_with_spec(products, "$.connectivity", "Bluetooth"))) == ["mouse", "phone"]
    assert ids(C.products_with_tag(products, "inalambrico")) == ["mouse"]
    assert [(r[0], r[3]) for r in C.best_rated(products).collect()] == [("towel", 4.7), ("phone", 4.5), ("mouse", 4.3)]
    assert ids(C.search_products(products, "Mouse")) == ["mouse"]
    assert ids(C.search_in_category(products, "eletronicos", "bluetooth")) == ["phone"]
    assert ids(C.category_name_matches(products, "ELECTRO")) == ["phone"]
    assert ids(C.heavy_products(products, "cama_mesa_banho")) == ["towel"]
    assert "category_name" in C.as_products(products).columns


def test_search_ranks_by_share_of_words(products):
    found = C.search_products(products, "bluetooth").collect()
    assert [r["product_id"] for r in found] == ["phone", "mouse"] and found[0]["score"] == 0.5


def test_scores_ignore_missing_and_nulls_sort_last(products):
    out = C.score_per_category(products).collect()
    assert out[0]["_id"] == "bed_bath_table" and out[-1]["_id"] is None and out[-1]["totalProducts"] == 1


def test_event_counts(events):
    assert [tuple(r) for r in C.events_by_type(events).collect()][0] == ("product_view", 3)
    assert C.events_by_type(events).count() == 5
    assert [tuple(r) for r in C.most_viewed(events).collect()] == [("mouse", 1), ("phone", 1), ("towel", 1)]


def test_session_timeline(events):
    out = C.session_timeline(events, "sess_abc123").collect()
    assert [r["event_type"] for r in out] == ["product_view", "product_view", "cart_add"]
    assert [r["search_query"] for r in out] == ["mouse inalambrico", "fone", None]


def test_carts(sessions, products):
    assert {r[0]: round(r[1], 2) for r in C.cart_totals(sessions).collect()} == {"sess_abc123": 289.80, "sess_def456": 99.80}
    assert C.cart_totals(sessions, "sess_ghi789").count() == 0
    assert sorted(ids(C.active_carts(sessions, "2024-06-21 00:00:00"))) == ["sess_abc123", "sess_def456"]
    assert ids(C.active_carts(sessions, "2024-06-21 14:45:00")) == ["sess_def456"]
    assert ids(C.active_cart_of(sessions, "ana", "2024-06-21 00:00:00")) == ["sess_abc123"]
    assert sorted(ids(C.cart_products(sessions, products))) == ["mouse", "phone", "towel"]
    assert C.enriched_cart_lines(sessions, products).count() == 3
    assert C.sessions_of_customer(sessions, "caio").first()["cart"] == []


def test_cart_totals_move_no_rows(sessions):
    assert "Exchange" not in plan_of(C.cart_totals(sessions))


def test_late_and_early_filters_differ(spark):
    products = spark.createDataFrame(
        [("p1", "x", 10, 1), ("p2", "x", 30, 3), ("p3", "x", None, 5)],
        "product_id string, product_category_name string, product_weight_g int, product_height_cm int",
    )
    events = spark.createDataFrame([("x", "search"), ("x", "search"), ("y", "cart_add")], "category string, event_type string")
    late = C.category_weights_late(products, events, "x").first()
    early = C.category_weights_early(products, events, "x").first()
    assert (late["avg_weight_g"], late["total_products"]) == (20.0, 3)
    assert (early["avg_weight_g"], early["total_products"], early["avg_height_cm"]) == (30.0, 1, 3.0)
    assert [tuple(e) for e in late["event_stats"]] == [("search", 2)]
    assert [p["product_id"] for p in late["sample_products"]] == ["p1", "p2", "p3"]
    rows_ = C.category_weights_early_products(products, events, "x").collect()
    assert [(r["product_id"], r["sample_count"]) for r in rows_] == [("p2", 1)]
    assert C.category_mean_late(products, "x", 20).first()["count"] == 3
    assert C.category_mean_early(products, "x", 20).first()["count"] == 1


def test_categories_without_events_get_an_empty_list(products, events):
    got = C.category_weights_late(products, events, "utilidades_domesticas").first()
    assert got["event_stats"] == [] and got["avg_weight_kg"] == 0.65


def test_limit_before_filter_and_null_category(spark):
    products = spark.createDataFrame(
        [("a", "x", None), ("b", "x", None), ("c", "y", 100), ("d", None, 500), ("e", "", 900)],
        "product_id string, product_category_name string, product_weight_g int",
    )
    assert C.largest_categories(products, top=1).count() == 0  # the largest has no weights
    weighted = {r["_id"]: r["top_products"] for r in C.weighted_categories(products).collect()}
    assert set(weighted) == {"y", None} and weighted[None] == [] and weighted["y"][0]["product_id"] == "c"


def test_top_per_group_is_cut_before_the_shuffle(products):
    assert "WindowGroupLimit" in plan_of(C.best_rated_per_category(products, 2))
    assert C.best_rated_per_category(products, 1).count() == 5


def test_places(spark):
    geo = spark.createDataFrame(
        [("01001", "sao paulo", "SP"), ("20040", "rio", "RJ")],
        "geolocation_zip_code_prefix string, geolocation_city string, geolocation_state string",
    )
    assert C.places_in_city(geo, "SP", "sao paulo").count() == 1
    assert C.places_of_zip(geo, "20040").first()["geolocation_state"] == "RJ"


def test_weight_ranges(products):
    assert ids(C.weight_range_regex(products, 200, 300, "elec")) == ["phone"]
    assert ids(C.weight_range_search(products, 200, 300, "electronics")) == ["phone"]
    assert C.daily_views_by_customer(seeds.events(products.sparkSession)).agg(F.sum("views")).first()[0] == 3
