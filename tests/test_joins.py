"""Distance, similarity and overlap joins against brute force over all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from tradewind.functions.ranges import make_range
from tradewind.operators import proximity
from tradewind.operators.matching import overlap_join, trigram_match
from tradewind.operators.proximity import nearest, within_radius
from tradewind.session import stored


def km(a, b):
    (x1, y1), (x2, y2) = a, b
    p1, p2 = math.radians(y1), math.radians(y2)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(x2 - x1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


def spots(rng, n, prefix, spread):
    out = []
    for i in range(n):
        if i % 3 == 0:  # a third of all rows on one place
            out.append((f"{prefix}{i:03}", 10.0, 50.0))
        else:
            out.append((f"{prefix}{i:03}", *spread(rng)))
    return out


SPREADS = {
    "town": lambda r: (10 + r.uniform(-0.3, 0.3), 50 + r.uniform(-0.3, 0.3)),
    "globe": lambda r: (r.uniform(-180, 180), math.degrees(math.asin(r.uniform(-1, 1)))),
    "seam": lambda r: (r.choice([-1, 1]) * r.uniform(179.8, 180), r.uniform(-1, 1)),
    "pole": lambda r: (r.uniform(-180, 180), r.choice([-1, 1]) * r.uniform(88, 90)),
}


@pytest.mark.parametrize("spread,radius", [("town", 5), ("town", 20), ("globe", 900), ("globe", 6000), ("seam", 30), ("pole", 60)])
def test_radius(spark, spread, radius):
    rng = random.Random(7)
    a, b = spots(rng, 60, "a", SPREADS[spread]), spots(rng, 80, "b", SPREADS[spread])
    left = spark.createDataFrame(a, "ai string, ax double, ay double")
    right = spark.createDataFrame(b + [("bnull", None, 1.0)], "bi string, bx double, by double")
    got = within_radius(left, right, radius, ("ax", "ay"), ("bx", "by")).select("ai", "bi").collect()
    want = {(i, j) for i, *p in a for j, *q in b if km(p, q) <= radius}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("spread", ["town", "globe"])
@pytest.mark.parametrize("k", [1, 3])
def test_nearest(spark, spread, k):
    rng = random.Random(3)
    a, b = spots(rng, 50, "a", SPREADS[spread]), spots(rng, 70, "b", SPREADS[spread])
    left = spark.createDataFrame(a, "ai string, ax double, ay double")
    right = spark.createDataFrame(b, "bi string, bx double, by double")
    got = nearest(left, right, k, "bi", ("ax", "ay"), ("bx", "by")).select("ai", "bi", "rank").collect()
    want = set()
    for i, x, y in a:
        ranked = sorted((math.hypot(x - p, y - q), j) for j, p, q in b)[:k]
        want |= {(i, j, n + 1) for n, (_, j) in enumerate(ranked)}
    assert {tuple(r) for r in got} == want


def test_nearest_with_too_few(spark):
    left = spark.createDataFrame([("a", 0.0, 0.0), ("b", 170.0, 80.0)], "ai string, ax double, ay double")
    right = spark.createDataFrame([("x", 1.0, 1.0), ("y", -170.0, -80.0)], "bi string, bx double, by double")
    assert nearest(left, right, 5, "bi", ("ax", "ay"), ("bx", "by")).count() == 4


def grams(t):
    import re

    return {f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", t.lower()) for i in range(len(w) + 1)}


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.9, 1.0])
def test_trigram_match(spark, threshold):
    rng = random.Random(5)
    words = ["health", "helth", "beauty", "beauti", "house", "house wares", "toys", "toy"]
    make = lambda: " ".join(rng.sample(words, rng.randint(1, 3)))
    a, b = [make() for _ in range(60)], [make() for _ in range(60)] + ["", "--", None]
    left, right = spark.createDataFrame([(t,) for t in a], "l string"), spark.createDataFrame([(t,) for t in b], "r string")
    got = {(r["l"], r["r"]): r["similarity"] for r in trigram_match(left, right, "l", "r", threshold).collect()}
    want = {}
    for x in set(a):
        for y in set(b) - {None}:
            g, h = grams(x), grams(y)
            if g and h and len(g & h) / len(g | h) >= threshold:
                want[x, y] = len(g & h) / len(g | h)
    assert got == want
    with pytest.raises(ValueError):
        trigram_match(left, right, "l", "r", 0)


def test_overlaps(spark):
    rng = random.Random(11)

    def make(n, prefix):
        out = []
        for i in range(n):
            lo = None if rng.random() < 0.1 else rng.randint(-800, 400)  # also before 1970
            hi = None if rng.random() < 0.1 else (lo or 0) + rng.choice([-1, 0, 1, 2, 15, 90, 400, 4000])
            out.append((f"{prefix}{i}", lo, hi, rng.choice(["[)", "[]", "(]", "()"])))
        return out

    def frame(data, prefix):
        day = lambda c: F.when(F.col(c).isNotNull(), F.timestamp_seconds(F.col(c) * 86400))
        df = spark.createDataFrame(data, f"{prefix}id string, lo int, hi int, bounds string")
        period = F.lit(None)
        for bounds in ("[)", "[]", "(]", "()"):
            r = make_range(day("lo"), day("hi"), bounds)
            period = F.when(F.col("bounds") == bounds, r).otherwise(period)
        return df.select(f"{prefix}id", period.alias(f"{prefix}r"))

    def hit(a, b):
        (_, al, ah, ab), (_, bl, bh, bb) = a, b

        def empty(lo, hi, s):
            return lo is not None and hi is not None and (lo > hi or (lo == hi and s != "[]"))

        def starts(lo, hi, inc_lo, inc_hi):
            return lo is None or hi is None or lo < hi or (lo == hi and inc_lo and inc_hi)

        return (
            not empty(al, ah, ab) and not empty(bl, bh, bb)
            and starts(al, bh, ab[0] == "[", bb[1] == "]") and starts(bl, ah, bb[0] == "[", ab[1] == "]")
        )

    a, b = make(60, "a"), make(60, "b")
    out = overlap_join(frame(a, "a"), frame(b, "b"), "ar", "br")
    got = [tuple(r) for r in out.select("aid", "bid").collect()]
    want = {(x[0], y[0]) for x in a for y in b if hit(x, y)}
    assert len(got) == len(set(got)) and set(got) == want


def test_plans_pair_by_keys_only(spark):
    spots_ = spark.createDataFrame([("a", 1.0, 2.0)], "i string, x double, y double")
    other = spots_.toDF("j", "u", "v")
    texts = spots_.select(F.col("i").alias("t")), other.select(F.col("j").alias("s"))
    period = make_range(F.lit("2018-01-01").cast("timestamp"), F.lit("2018-02-01").cast("timestamp"))
    left, right = spots_.select("i", period.alias("p")), other.select("j", period.alias("q"))
    for df in (
        within_radius(spots_, other, 10, ("x", "y"), ("u", "v")),
        nearest(spots_, other, 2, "j", ("x", "y"), ("u", "v")),
        trigram_match(*texts, "t", "s", 0.3),
        overlap_join(left, right, "p", "q"),
    ):
        plan = plan_of(df)
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
            assert word not in plan


def test_nearest_within_a_dense_cluster(spark):
    """10,000 places within 0.02 degrees and some far away: few rows meet for each, also for left places beside the cluster."""
    rng = random.Random(4)
    near = lambda: (10 + rng.uniform(0, 0.02), 50 + rng.uniform(0, 0.02))
    b = [(i, *near()) for i in range(10_000)] + [(10_000 + i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(50)]
    a = [(i, *near()) for i in range(300)] + [(300 + i, 10.5 + rng.uniform(0, 1), 50.0) for i in range(100)] + [(400, -170.0, -80.0)]
    left, right = spark.createDataFrame(a, "ai int, ax double, ay double"), spark.createDataFrame(b, "bi int, bx double, by double")
    homes = stored(right.selectExpr("bx AS _blng", "by AS _blat", "array(bi) AS ids"), "homes")
    levels, members = proximity._tree(homes, proximity._LEAF)
    assert members.count() == len(b) and len(levels) < 15
    looks = proximity._leaves_around(left.selectExpr("ax AS _alng", "ay AS _alat"), levels, 3)
    assert looks.join(members, ["step", "cx", "cy"]).count() < 200 * len(a)
    got = {}
    for r in nearest(left, right, 3, "bi", ("ax", "ay"), ("bx", "by")).select("ai", "bi", "rank").collect():
        got.setdefault(r["ai"], {})[r["rank"]] = r["bi"]
    for i, x, y in a[::7] + a[-1:]:
        ranked = sorted((math.hypot(x - p, y - q), j) for j, p, q in b)[:3]
        assert got[i] == {n + 1: j for n, (_, j) in enumerate(ranked)}
