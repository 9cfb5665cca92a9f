"""Exact summaries and quantiles of many columns of many tables together.

All columns are put into long form, one row for each value with the number of its column.

1. One pass counts the values of every column in buckets of equal ratio (sixteen to each power of two), with sums, least and
   greatest value of each bucket. A column has at most some 67,000 buckets whatever it holds, usually a few hundred.
2. The buckets tell, for every quantile, between which two values its ranks lie. Where more than ``INSIDE`` rows lie there,
   a pass cuts all such ranges into equal parts and keeps those with the ranks.
3. One pass over the columns that are still open takes the values at the ranks.

So the number of passes does not grow with columns or tables, and no task and not the driver holds more than small ranges.
NULL and NaN are no values; infinite ones are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows between the values around a quantile up to which they are ranked, and the parts a larger range is cut into.
INSIDE = 200_000
PARTS = 1024
#: Buckets for each power of two, and the number of the bucket of infinity.
PER_OCTAVE, INFINITE = 16, 40_000

Columns = list[tuple[str, str]]


def long_form(tables: dict[str, DataFrame], columns: Columns, wanted: set[int] | None = None) -> DataFrame:
    """(id, x): the values of the columns as doubles; id is the column's place in ``columns``."""
    parts = []
    for name, df in tables.items():
        own = [(i, c) for i, (table, c) in enumerate(columns) if table == name and (wanted is None or i in wanted)]
        if own:
            fields = [F.struct(F.lit(i).alias("id"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in own]
            parts.append(df.select(F.inline(F.array(*fields))))
    return reduce(DataFrame.unionByName, parts).where("x is not null and not isnan(x)")


def _bucket(x: Column) -> Column:
    size = F.floor(F.log2(F.abs(x)) * PER_OCTAVE).cast("int") + INFINITE // 2
    inside = F.when(x == 0, 0).when(x > 0, size).otherwise(-size)
    return F.when(F.abs(x) == math.inf, F.when(x > 0, INFINITE).otherwise(-INFINITE)).otherwise(inside)


@dataclass
class Summary:
    """What the buckets tell about a column."""

    count: int = 0
    mean: float | None = None
    std: float | None = None
    least: float | None = None
    most: float | None = None
    buckets: list = field(default_factory=list)


def summaries(long: DataFrame, n: int) -> list[Summary]:
    """The summary of each of the n columns of a long form."""
    found = long.groupBy("id", _bucket(F.col("x")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean"), F.var_pop("x").alias("spread")
    )
    out = [Summary() for _ in range(n)]
    for row in found.collect():  # bounded by the buckets of a column
        out[row["id"]].buckets.append(row)
    for s in out:
        s.buckets.sort(key=lambda r: r["bucket"])
        if not s.buckets:
            continue
        s.count, s.least, s.most = sum(r["n"] for r in s.buckets), s.buckets[0]["low"], s.buckets[-1]["high"]
        if math.isinf(s.least) or math.isinf(s.most):
            s.mean, s.std = s.least + s.most, math.nan
            continue
        s.mean = sum(r["n"] / s.count * r["mean"] for r in s.buckets)
        if s.count > 1:
            s.std = math.sqrt(sum(r["n"] * (r["spread"] + (r["mean"] - s.mean) * (r["mean"] - s.mean)) for r in s.buckets) / (s.count - 1))
    return out


@dataclass(eq=False)
class _Target:
    """A quantile: the ranks around it, and the range of values that holds them."""

    id: int
    at: float
    total: int
    low: float = 0.0
    high: float = 0.0
    below: int = 0
    inside: int = 0
    ends: tuple[float, float] | None = None

    @property
    def ranks(self) -> tuple[int, int]:
        first = math.floor(self.at)
        return first, min(first + 1, self.total - 1)

    def choose(self, below: int, parts: list) -> None:
        """Keep the parts, in order, that hold the ranks; each has n, low and high, and ``below`` rows come before the first."""
        kept = []
        for part in parts:
            if below + part["n"] > self.ranks[0] and below <= self.ranks[1]:
                kept.append((below, part))
            below += part["n"]
        self.below, self.inside = kept[0][0], sum(p["n"] for _, p in kept)
        self.low, self.high = kept[0][1]["low"], kept[-1][1]["high"]
        if self.low == self.high:
            self.ends = self.low, self.high
        elif len(kept) == 2:
            # the two ranks lie on both sides of a cut: the greatest value below it and the least above it
            self.ends = kept[0][1]["high"], kept[1][1]["low"]

    def value(self) -> float:
        (a, b), share = self.ends, self.at - math.floor(self.at)
        if a == b or share == 0:
            return a
        # no difference of infinities
        return a * (1 - share) + b * share if math.isinf(a) or math.isinf(b) else a + (b - a) * share


def _inside(tables: dict[str, DataFrame], columns: Columns, targets: list[_Target]) -> DataFrame:
    """(i, x) of the values in the range of each target, with its bounds."""
    spark = next(iter(tables.values())).sparkSession
    ranges = spark.createDataFrame([(i, t.id, t.low, t.high) for i, t in enumerate(targets)], "i int, id int, low double, high double")
    long = long_form(tables, columns, {t.id for t in targets})
    return long.join(F.broadcast(ranges), "id").where("x between low and high")  # one row for each quantile of a column


def quantiles(tables: dict[str, DataFrame], columns: Columns, found: list[Summary], probabilities: list[float]) -> dict[tuple[int, float], float | None]:
    """The quantile with linear interpolation for each (column, probability); None for a column without values."""
    targets = {(i, p): _Target(i, (s.count - 1) * p, s.count) for i, s in enumerate(found) if s.count for p in probabilities}
    for t in targets.values():
        t.choose(0, found[t.id].buckets)
    while wide := [t for t in targets.values() if t.ends is None and t.inside > INSIDE]:
        share = (F.col("x") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)  # halves: the width itself may be too large a number
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).alias("part")
        counted = _inside(tables, columns, wide).groupBy("i", part).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        parts: dict[int, list] = {}
        for row in counted.collect():  # at most PARTS rows for each target
            parts.setdefault(row["i"], []).append(row)
        for i, t in enumerate(wide):
            t.choose(t.below, sorted(parts[i], key=lambda r: r["part"]))
    if last := [t for t in targets.values() if t.ends is None]:
        ranked = _inside(tables, columns, last).groupBy("i", "x").agg(F.count(F.lit(1)).alias("n"))
        ranked = ranked.withColumn("upto", F.sum("n").over(Window.partitionBy("i").orderBy("x")))  # at most INSIDE rows for each target
        spark = ranked.sparkSession
        wanted = spark.createDataFrame([(i, *(r - t.below for r in t.ranks)) for i, t in enumerate(last)], "i int, first long, second long")
        ranked = ranked.join(F.broadcast(wanted), "i")
        holds = lambda rank: (F.col("upto") > F.col(rank)) & (F.col("upto") - F.col("n") <= F.col(rank))
        hits = ranked.groupBy("i").agg(*(F.max(F.when(holds(r), F.col("x"))).alias(r) for r in ("first", "second")))
        for row in hits.collect():
            last[row["i"]].ends = row["first"], row["second"]
    return {(i, p): targets[i, p].value() if (i, p) in targets else None for i in range(len(columns)) for p in probabilities}
