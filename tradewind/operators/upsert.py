"""Loads that keep what is there: insert if absent, in one batch or onto stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.topk import first_per_key


def insert_new(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The target with the incoming rows whose key it does not have. Existing rows win.

    Within the incoming rows the first per key in ``order`` wins; the default order is by all
    columns, so the outcome does not depend on how the input is split.
    """
    return target.unionByName(new_rows(target, incoming, keys, order), allowMissingColumns=True)


def new_rows(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Only the rows ``insert_new`` adds."""
    ranking = order or [F.col(c).asc_nulls_last() for c in incoming.columns if c not in keys and _orderable(incoming, c)]
    first = first_per_key(incoming, keys, ranking or [F.col(keys[0])])
    known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_t_{k}") for k in keys])
    return first.join(known, match, "left_anti")


def _orderable(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("variant", "map")
