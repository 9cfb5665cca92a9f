"""Registered queries: each Spark query over the test tables beside the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.session import configure
from tradewind.sources.star_views import Shop

Query = Callable[[SparkSession, str], DataFrame]


def on_shop(build: Callable[[Shop], DataFrame]) -> Query:
    """A registered query from a function of the shop views."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(Shop(configure(spark), sf_dir)))

    return run


def with_nulls(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be missing as doubles: some clients have no missing integer."""
    for name in columns:
        df = df.withColumn(name, df[name].cast("double"))
    return df


def portable(df: DataFrame) -> DataFrame:
    """Plain column types for comparison with another engine.

    Decimals become doubles, integers bigint, dates and timestamps text, intervals seconds.
    """
    from pyspark.sql import functions as F

    columns = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "decimal" or kind == "float":
            c = c.cast("double")
        elif kind in ("byte", "short", "integer"):
            c = c.cast("bigint")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind.startswith("interval") or "daytimeinterval" in type(f.dataType).__name__.lower():
            c = (F.unix_micros(F.timestamp_micros(F.lit(0)) + c) / 1_000_000).cast("double")
        columns.append(c.alias(f.name))
    return df.select(*columns)
