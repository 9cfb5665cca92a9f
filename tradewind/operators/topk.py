"""First row, top k and nested top k per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of every group in the given order.

    The filter on ``row_number`` lets every task drop all but its own first k rows of a group before
    the shuffle, so the size of a group does not matter. Spark does that up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, which is raised to k here where it is lower.
    ``order`` must be total to be repeatable.
    """
    name, limit = rank or _RANK, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(df.sparkSession.conf.get(limit, "1000")) < k:
        df.sparkSession.conf.set(limit, str(k))
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return ranked if rank else ranked.drop(name)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_per_group(df, keys, order, 1)


def nested_top(df: DataFrame, keys: list[str], order: list[Column], k: int, fields: list[Column], name: str) -> DataFrame:
    """One row per key with an array of its first ``k`` rows as structs, in order."""
    top = top_per_group(df, keys, order, k, rank=_RANK)
    rows = F.array_sort(F.collect_list(F.struct(F.col(_RANK), F.struct(*fields).alias("row"))))
    return top.groupBy(*keys).agg(F.transform(rows, lambda r: r["row"]).alias(name))


def attach_nested(left: DataFrame, nested: DataFrame, left_key: str, nested_key: str, name: str) -> DataFrame:
    """Left join of a nested array; rows without a match get an empty array, as do rows with a NULL key."""
    side = nested.withColumnRenamed(nested_key, "_nested_key")
    joined = left.join(side, F.col(left_key) == F.col("_nested_key"), "left").drop("_nested_key")
    kind = nested.schema[name].dataType
    return joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))
