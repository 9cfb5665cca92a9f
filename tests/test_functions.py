import datetime as dt
import json
import math
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_of
from tradewind.functions import documents as D
from tradewind.functions import numeric as N
from tradewind.functions import ranges as R
from tradewind.functions import temporal as T
from tradewind.functions import text as X
from tradewind.functions.geo import distance_km, planar, point
from tradewind.operators.privacy import protect_pii, reveal


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_average_is_not_rounded_twice(spark):
    # 10,000 x 0.01 in 20,001 rows: 0.004999..., which rounds to 0.00 and not to 0.01.
    df = spark.range(20001).select(F.when(F.col("id") < 10000, 0.01).otherwise(0.0).cast("decimal(10,2)").alias("x"))
    assert df.agg(N.rounded_avg("x").alias("v")).first()["v"] == Decimal("0.00")
    assert df.agg(F.round(F.avg("x"), 2).alias("v")).first()["v"] == Decimal("0.01")


def test_average_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (2,), (2,), (2,), (2,), (2,)], "x bigint")
    assert df.agg(N.rounded_avg("x").alias("v")).first()["v"] == Decimal("1.88")  # 1.875
    assert df.agg(N.rounded_avg(-F.col("x")).alias("v")).first()["v"] == Decimal("-1.88")


def test_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x bigint")
    assert df.agg(N.rounded_avg("x").alias("v")).first()["v"] is None
    assert df.where(F.lit(False)).agg(N.rounded_avg("x").alias("v")).first()["v"] is None


def test_percent_of_zero_is_null(spark):
    zero = F.lit(0).cast("decimal(12,2)")
    assert one(spark, N.percent(F.lit(5).cast("decimal(12,2)"), zero)) is None


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("",), ("0",), ("-1",), ("12.5",), ("x",), (None,)], "t string")
    out = df.select(N.positive_or_null(N.parse_number(F.col("t"), "decimal(8,2)")).alias("v")).collect()
    assert [r["v"] for r in out] == [None, None, None, Decimal("12.50"), None, None]


def test_closed_range_stops_at_midnight_of_the_last_day(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 12, 31, 0, 0),), (dt.datetime(2018, 12, 31, 12, 0),)], "t timestamp"
    )
    assert T.closed(df, "t", "2018-01-01", "2018-12-31").count() == 1
    assert T.half_open(df, "t", "2018-01-01", "2019-01-01").count() == 2


def test_range_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(T.half_open(orders, "o_orderdate", "1997-01-01", "1998-01-01").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_expiry_and_recent(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2),), (dt.datetime(2024, 1, 1),)], "t timestamp")
    assert T.within_last(df, "t", "2024-01-02 12:00:00", 24).count() == 1
    assert T.not_expired(df, "t", "2024-01-01 00:00:00").count() == 1
    assert one(spark, T.next_year("2024-05-05")) == 2025


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2018-01-01 10:00:00",), ("",), ("soon",)], "t string")
    out = [r[0] for r in df.select(T.parse_timestamp(F.col("t"))).collect()]
    assert out == [dt.datetime(2018, 1, 1, 10), None, None]


# --- ranges ---


def _range(lo, hi, bounds="[)"):
    cast = lambda v: F.lit(v).cast("int")
    return R.make_range(cast(lo), cast(hi), bounds)


def _inside(x, lo, hi, bounds):
    above = lo is None or x > lo or (x == lo and bounds[0] == "[")
    below = hi is None or x < hi or (x == hi and bounds[1] == "]")
    return above and below


BOUNDS = st.sampled_from(["[)", "[]", "(]", "()"])
END = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(END, END, BOUNDS, END, END, BOUNDS), min_size=10, max_size=25))
def test_range_predicates_match_points(spark, cases):
    # A quarter-step grid decides for continuous ranges with whole-number ends.
    grid = [i / 4 for i in range(-8, 25)]
    columns = []
    for i, (a, b, ab, c, d, cd) in enumerate(cases):
        x, y = _range(a, b, ab), _range(c, d, cd)
        columns += [R.overlaps(x, y).alias(f"o{i}"), R.contains_range(x, y).alias(f"c{i}")]
    got = spark.range(1).select(*columns).first()
    for i, (a, b, ab, c, d, cd) in enumerate(cases):
        first = {p for p in grid if _inside(p, a, b, ab)}
        second = {p for p in grid if _inside(p, c, d, cd)}
        assert got[f"o{i}"] == bool(first & second), cases[i]
        assert got[f"c{i}"] == (second <= first), cases[i]


def test_range_points_and_nulls(spark):
    r = _range(1, 3, "[)")
    assert [one(spark, R.contains_point(r, F.lit(x))) for x in (0, 1, 3)] == [False, True, False]
    assert one(spark, R.contains_point(_range(1, 3, "(]"), F.lit(3))) is True
    assert one(spark, R.overlaps(F.when(F.lit(False), r), r)) is None
    assert one(spark, R.contained_by(_range(1, 2), r)) is True


# --- JSON ---


def _contains(value, pattern, top=True):
    """Containment as documented for binary JSON in SQL databases."""
    if isinstance(pattern, dict):
        return isinstance(value, dict) and all(k in value and _contains(value[k], p, False) for k, p in pattern.items())
    if isinstance(pattern, list):
        return isinstance(value, list) and all(any(_contains(v, p, False) for v in value) for p in pattern)
    if top and isinstance(value, list):
        return any(_same(v, pattern) for v in value)
    return _same(value, pattern)


def _same(a, b):
    if isinstance(a, bool) or isinstance(b, bool) or a is None or b is None:
        return type(a) is type(b) and a == b
    return not isinstance(a, (dict, list)) and type(a == b) is bool and (
        (isinstance(a, str) == isinstance(b, str)) and a == b
    )


SCALAR = st.one_of(st.none(), st.booleans(), st.integers(0, 2), st.sampled_from(["a", "1", "b'c"]))
JSON = st.recursive(
    SCALAR, lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.sampled_from(["a", "b", "c d"]), x, max_size=3)), max_leaves=6
)


@settings(max_examples=30, deadline=None)
@given(st.lists(JSON, min_size=5, max_size=15), JSON)
def test_json_containment(spark, docs, pattern):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, t string")
    got = df.select("i", D.contains_json(F.parse_json("t"), pattern if isinstance(pattern, (dict, list)) else json.dumps(pattern)).alias("v"))
    assert {r["i"]: r["v"] for r in got.collect()} == {i: _contains(d, pattern) for i, d in enumerate(docs)}


def test_json_keys_and_arrays(spark):
    text = F.lit('{"a": null, "b": 1}')
    assert one(spark, D.has_key(text, "a")) is True
    assert one(spark, D.has_any_key(text, ["x", "b"])) is True
    assert one(spark, D.has_all_keys(text, ["a", "x"])) is False
    arr = F.array(F.lit("u1"), F.lit("u2"))
    assert one(spark, D.contains_all(arr, ["u1"])) is True
    assert one(spark, D.contains_all(arr, ["u1", "u3"])) is False
    assert one(spark, D.non_empty(F.lit(None).cast("array<string>"))) is False
    assert one(spark, D.parse_pairs(F.lit("color => blue, size => M"))) == {"color": "blue", "size": "M"}


def test_inequality_keeps_missing(spark):
    df = spark.createDataFrame([("",), ("x",), (None,)], "c string")
    assert {r["c"] for r in df.where(D.not_equal_or_missing(F.col("c"), "")).collect()} == {"x", None}


# --- text ---


def test_similarity_of_the_documented_pair(spark):
    assert one(spark, X.similarity(F.lit("helth beauty"), F.lit("health_beauty"))) == 0.6875
    assert one(spark, X.similarity(F.lit(""), F.lit(""))) == 0.0
    assert one(spark, X.similarity(F.lit("Same"), F.lit("same"))) == 1.0


def test_trigrams_pad_words(spark):
    assert sorted(one(spark, X.trigrams(F.lit("ab, c")))) == sorted(["  a", " ab", "ab ", "  c", " c "])


def test_text_score(spark):
    score = X.text_score([F.lit("red red plate"), F.lit("plate"), F.lit(None).cast("string")], ["red", "plate"])
    assert one(spark, score) == 2.0
    assert one(spark, X.matches_any([F.lit("reddish"), F.lit(None).cast("string")], ["red"])) is False
    assert X.search_terms("Red, red PLATE") == ["red", "plate"]


# --- places ---


def test_distances(spark):
    a, b = point(F.lit(-47.063), F.lit(-22.898)), point(F.lit(-43.176), F.lit(-22.910))
    assert math.isclose(one(spark, distance_km(a, b)), 398.129, abs_tol=0.001)
    assert math.isclose(one(spark, planar(point(F.lit(0.0), F.lit(0.0)), point(F.lit(3.0), F.lit(4.0)))), 5.0)
    assert one(spark, point(F.lit(1.0), F.lit(None).cast("double"))) is None


# --- privacy ---


def test_pii_round_trip_and_plan(spark, tmp_path):
    secrets = spark.createDataFrame([(bytearray(b"0123456789abcdef"), "pepper")], "key binary, salt string")
    secrets.write.parquet(str(tmp_path / "secrets"))
    secrets = spark.read.parquet(str(tmp_path / "secrets"))
    people = spark.createDataFrame([("ana@x", "1"), ("bia@x", "1"), (None, "2")], "mail string, doc string")
    hidden = protect_pii(people, secrets, ["mail"], ["doc"])
    assert "0123456789abcdef" not in plan_of(hidden) and "pepper" not in plan_of(hidden)
    docs = [r["doc"] for r in hidden.collect()]
    assert docs[0] == docs[1] != docs[2] and len(docs[0]) == 64
    assert sorted(r["mail"] or "" for r in reveal(hidden, secrets, ["mail"]).collect()) == ["", "ana@x", "bia@x"]
