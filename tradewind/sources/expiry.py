"""Documents that expire, laid out by the day of their expiry.

A sweep drops the folders of whole days without reading them and filters one day; a reader of live rows reads no expired day. Rows
without an expiry have a folder of their own. A change of an expiry moves rows between days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.temporal import bound
from tradewind.operators.topk import first_per_key
from tradewind.session import stored
from tradewind.sources.sinks import exists

DAY = "expiry_day"


def _day(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def _write(rows: DataFrame, path: str) -> None:
    """Put the days of ``rows`` in the place of what is stored of them; a large day is several files."""
    placed = rows.hint("rebalance", F.col(DAY))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def write_by_expiry(df: DataFrame, path: str, column: str) -> None:
    """Store rows by the day on which ``column`` says they expire; days that are written again are replaced."""
    _write(df.withColumn(DAY, _day(F.col(column))), path)


def read_by_expiry(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows with their day (NULL for rows without an expiry)."""
    found = spark.read.parquet(path)
    schema = found.drop(DAY).schema.add(DAY, "string")  # days stay text
    return spark.read.schema(schema).parquet(path)


def read_live(spark: SparkSession, path: str, column: str, as_of: str) -> DataFrame:
    """The rows that have not expired at ``as_of``; folders of earlier days are not read."""
    rows = read_by_expiry(spark, path)
    today = _day(F.lit(as_of).cast("timestamp"))
    live = F.col(DAY).isNull() | ((F.col(DAY) >= today) & (F.col(column) > bound(rows, column, as_of)))
    return rows.where(live).drop(DAY)


def _drop_days(spark: SparkSession, path: str, drop) -> list[str]:
    """Remove the folders of the days that ``drop`` names; only their names are looked at."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(where):
        name, _, day = status.getPath().getName().partition("=")
        if name == DAY and drop(day):
            fs.delete(status.getPath(), True)
            gone.append(day)
    return sorted(gone)


def sweep(spark: SparkSession, path: str, column: str, as_of: str) -> list[str]:
    """Remove what has expired at ``as_of``; returns the days that were dropped whole.

    Of the day of ``as_of`` the rows that expire later are kept: they are written aside first and then take the place of the
    day. The sweep may be repeated.
    """
    if not exists(spark, path):
        return []
    today = spark.sql("SELECT date_format(cast(:t AS timestamp), 'yyyy-MM-dd')", args={"t": as_of}).first()[0]
    rows = read_by_expiry(spark, path)
    kept = stored(rows.where((F.col(DAY) == today) & (F.col(column) > bound(rows, column, as_of))), "unexpired")
    empty = kept.isEmpty()
    if not empty:
        _write(kept, path)
    # a folder without a day holds the rows that never expire
    return _drop_days(spark, path, lambda day: day[:1].isdigit() and (day < today or (empty and day == today)))


def change_expiry(spark: SparkSession, path: str, column: str, key: str, changes: DataFrame) -> None:
    """Give rows another expiry: ``changes`` has ``key``, the stored value as ``old`` and the new one as ``new``.

    Only the days of old and new values are read and written. A key has one row; so the change may be repeated after a failure.
    """
    changes = stored(changes.select(F.col(key).alias("_key"), "old", "new"), "changes")
    # one row for each day that rows leave or come to
    days = {r[0] for c in ("old", "new") for r in changes.select(_day(F.col(c))).distinct().collect()}
    touched = F.col(DAY).isin([d for d in days if d is not None])
    rows = read_by_expiry(spark, path).where(touched | F.col(DAY).isNull() if None in days else touched)
    moved = rows.join(changes.drop("old").withColumn("_changed", F.lit(True)), rows[key] == F.col("_key"), "left")
    value = F.when(F.col("_changed"), F.col("new")).otherwise(F.col(column)).cast(rows.schema[column].dataType)
    moved = moved.withColumn(column, value).withColumn(DAY, _day(F.col(column))).select(*rows.columns)
    result = stored(first_per_key(moved, [key], [F.col(column)]), "changed-days")
    _write(result, path)
    filled = {r[0] for r in result.select(DAY).distinct().collect()}
    _drop_days(spark, path, lambda day: day in days - filled or (None in days - filled and not day[:1].isdigit()))
