"""Joins by similarity of texts and by overlap of ranges."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import ranges, text
from tradewind.session import stored

_TINY = 1e-9


def trigram_match(
    left: DataFrame, right: DataFrame, left_text: str, right_text: str, threshold: float, score: str = "similarity"
) -> DataFrame:
    """Distinct pairs of texts whose trigram similarity is at least ``threshold`` (above 0).

    Equal texts on one side are one text here; join the result back for rows. Two sets that reach the
    threshold share at least one of the rarest trigrams of each: of a set of n only the
    ``n - ceil(threshold * n) + 1`` rarest need to be looked at. So a trigram that most texts contain
    is never used to form pairs. Texts meet only within classes of similar size, and only if what is left of
    both sets behind the shared trigram could still reach the threshold.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")

    def texts(df: DataFrame, column: str) -> DataFrame:
        return (
            df.where(F.col(column).isNotNull())
            .select(F.col(column).alias("t"))
            .distinct()
            .withColumn("grams", text.trigrams(F.col("t")))
            .where(F.size("grams") > 0)
        )

    a, b = texts(left, left_text), texts(right, right_text)
    frequency = (
        a.select(F.explode("grams").alias("gram"))
        .unionByName(b.select(F.explode("grams").alias("gram")))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("df"))
    )

    def rare(df: DataFrame, prefix: str) -> DataFrame:
        """The rarest trigrams of every text, one row each."""
        n = F.col("n")
        keep = n - F.ceil(n * threshold - _TINY) + 1
        order = Window.partitionBy("t").orderBy("df", "gram")
        return (
            df.select("t", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
            .join(frequency, "gram")
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= keep)
            .select("gram", F.col("t").alias(f"{prefix}t"), F.col("n").alias(f"{prefix}n"), F.col("place").alias(f"{prefix}p"))
        )

    # sizes of a matching pair differ by a factor of 1 / threshold at most: one class, or two neighbouring ones
    def size_class(n: str) -> Column:
        return F.col(n) if threshold == 1 else F.floor(F.log(F.col(n)) / -math.log(threshold) + _TINY)

    sized = rare(a, "a").withColumn("class", F.explode(F.array(*(size_class("an").cast("long") + d for d in (-1, 0, 1)))))
    small, large = F.least("an", "bn"), F.greatest("an", "bn")
    # at the first shared trigram in the common order, the shared part is at most it and the shorter rest
    reachable = 1 + F.least(F.col("an") - F.col("ap"), F.col("bn") - F.col("bp"))
    candidates = (
        sized.join(rare(b, "b").withColumn("class", size_class("bn").cast("long")), ["gram", "class"])
        .where(small >= large * threshold - _TINY)
        .where(reachable >= (F.col("an") + F.col("bn")) * (threshold / (1 + threshold)) - _TINY)
        .select("at", "bt")
        .distinct()
    )
    whole = candidates.join(a.select(F.col("t").alias("at"), F.col("grams").alias("ag")), "at").join(
        b.select(F.col("t").alias("bt"), F.col("grams").alias("bg")), "bt"
    )
    return (
        whole.withColumn(score, text.jaccard(F.col("ag"), F.col("bg")))
        .where(F.col(score) >= threshold)
        .select(F.col("at").alias(left_text), F.col("bt").alias(right_text), score)
    )


#: Starts of ranges in a block, as a power of two.
_BLOCK_BITS = 8
_EARLIEST, _LATEST = -(1 << 63), (1 << 63) - 1


def _with_ends(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """The rows with a range that is not empty, numbered, with their ends in microseconds; written once, so numbers stay."""
    r = F.col(column)
    lo, hi = (F.unix_micros(r[end].cast("timestamp")) for end in ("lower", "upper"))
    kept = df.where(r.isNotNull() & ~ranges.is_empty(r)).select(
        "*",
        F.monotonically_increasing_id().alias(f"_{prefix}row"),
        F.coalesce(lo, F.lit(_EARLIEST)).alias(f"_{prefix}lo"),
        F.coalesce(hi, F.lit(_LATEST)).alias(f"_{prefix}hi"),
    )
    return stored(kept, "ranges")


def _swept(a: DataFrame, b: DataFrame) -> DataFrame:
    """(side, row, kind, before_a, before_b) of every start and end, in one order of time: how many starts of each side come before.

    At one moment starts of b come first, then those of a, then ends. The line is cut into parts of about equal size by
    sampled quantiles, between rows where many share a moment; each part is counted for itself.
    """

    def events(df: DataFrame, side: str, tie: int) -> DataFrame:
        both = F.array(
            F.struct(F.col(f"_{side}lo").alias("t"), F.lit(tie).alias("tie"), F.lit("start").alias("kind")),
            F.struct(F.col(f"_{side}hi").alias("t"), F.lit(2).alias("tie"), F.lit("end").alias("kind")),
        )
        return df.select(F.lit(side).alias("side"), F.col(f"_{side}row").alias("row"), F.inline(both))

    order = ["t", "tie", "side", "row"]
    line = events(a, "a", 1).unionByName(events(b, "b", 0)).repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    line = stored(line, "ends-of-ranges")
    is_start = {s: ((F.col("kind") == "start") & (F.col("side") == s)).cast("long") for s in "ab"}
    # one row for each part: a window over them all is small
    parts = line.groupBy("part").agg(*(F.sum(is_start[s]).alias(s) for s in "ab"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"parts_{s}") for s in "ab"))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = line.select("part", "side", "row", "kind", *(F.coalesce(F.sum(is_start[s]).over(within), F.lit(0)).alias(s) for s in "ab"))
    ranked = counted.join(F.broadcast(parts), "part")
    return stored(ranked.select("side", "row", "kind", *((F.col(s) + F.col(f"parts_{s}")).alias(f"before_{s}") for s in "ab")), "swept-ranges")


def _starts_within(swept: DataFrame, of: str, within: str) -> DataFrame:
    """Pairs of rows where a range of side ``of`` starts within one of side ``within``.

    The starts that lie within a range follow each other in the order of the line, so a range looks into consecutive blocks of
    starts: no more pairs are formed than there are, but for the rest of its first and last block.
    """
    starts = swept.where((F.col("side") == of) & (F.col("kind") == "start")).select(F.col("row").alias(f"_{of}row"), F.col(f"before_{of}").alias("rank"))
    bound = lambda kind: F.max(F.when(F.col("kind") == kind, F.col(f"before_{of}")))
    spans = swept.where(F.col("side") == within).groupBy(F.col("row").alias(f"_{within}row")).agg(bound("start").alias("from"), bound("end").alias("to"))
    blocks = F.sequence(F.shiftright("from", _BLOCK_BITS), F.shiftright(F.col("to") - 1, _BLOCK_BITS))
    looks = spans.where("`from` < `to`").withColumn("block", F.explode(blocks))
    pairs = starts.withColumn("block", F.shiftright("rank", _BLOCK_BITS)).join(looks, "block")
    return pairs.where("rank >= `from` and rank < `to`").select("_arow", "_brow")


def overlap_join(left: DataFrame, right: DataFrame, left_range: str, right_range: str) -> DataFrame:
    """Pairs of rows whose ranges overlap, honouring bound flags and unbounded ends.

    Of two ranges that overlap one starts within the other: a left one no earlier than the right one, or a right one
    later than the left one. Both cases are found by a sweep over the line of all starts and ends, which is cut into parts; so
    long and open ranges cost what they match, and no moment or range gathers rows in one task. Each pair is found once. Column
    names of the two sides must differ. The sides and the line are written to the shared folder.
    """
    a, b = _with_ends(left, left_range, "a"), _with_ends(right, right_range, "b")
    swept = _swept(a, b)
    pairs = _starts_within(swept, "a", "b").unionByName(_starts_within(swept, "b", "a"))
    found = pairs.join(a, "_arow").join(b, "_brow").where(ranges.overlaps(F.col(left_range), F.col(right_range)))
    return found.select(*left.columns, *right.columns)
