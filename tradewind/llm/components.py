"""Connected components of an undirected graph of long ids, by large-star and small-star rounds.

Every round is a handful of joins and minima over the links that are left, written to the shared folder; the number
of rounds grows with the logarithm of the longest chain. A vertex with very many links is handled by a minimum that
is combined before the shuffle and by a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import drop, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is linked to the least of its neighbours and itself."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    above = both.where("v > u")
    return above.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour below a vertex, and the vertex, is linked to the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    """Number of links and two sums; equal before and after a round that changed nothing."""
    mix = F.xxhash64("u", "v")
    row = links.agg(F.count(F.lit(1)), F.bit_xor(mix), F.sum(mix.bitwiseAND(F.lit((1 << 40) - 1)).cast("decimal(13,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component) for every vertex that has a link; component is the least vertex reachable.

    Rows with a null end or equal ends are no links; repeated links count once.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stored(pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "links")
    before = _state(current)
    while before[0]:
        following = stored(_small_star(_large_star(current)), "links")
        after = _state(following)
        drop(current)
        current = following
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots)
