"""Writers and data layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tradewind.functions.temporal import YEAR_COLUMN
from tradewind.operators.upsert import new_rows
from tradewind.session import stored

NULL_MARKER = "\\N"

#: Partition values of a load that are filtered by name; a load with more reads the range they lie in.
PARTITIONS_NAMED = 1000


def append(df: DataFrame, path: str) -> None:
    """Append to a stored table. The partitions of the frame are the batches."""
    df.write.mode("append").parquet(path)


# What a text field cannot hold in a tab-separated line, and what stands for it.
_TSV_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def append_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated text without header, NULL as ``\\N``; tabs, line breaks and backslashes in texts are escaped.

    One record is one line, so a file can be split; ``files.read_tsv`` reads it back.
    """

    def field(f) -> Column:
        value = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "string":
            for raw, escaped in _TSV_ESCAPES:
                value = F.replace(value, F.lit(raw), F.lit(escaped))
        elif f.dataType.typeName().startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        else:
            value = value.cast("string")
        return F.coalesce(value, F.lit(NULL_MARKER))

    df.select(F.concat_ws("\t", *(field(f) for f in df.schema.fields)).alias("value")).write.mode("append").text(path)


def append_quoted_csv(df: DataFrame, path: str) -> None:
    """CSV with every field quoted; NULL is an empty field."""
    df.write.mode("append").options(quoteAll=True, nullValue="", emptyValue="", escape='"', header=False).csv(path)


def append_documents(df: DataFrame, path: str) -> None:
    """JSON documents, one per line; NULL fields are left out."""
    df.write.mode("append").option("ignoreNullFields", True).json(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def is_loaded(spark: SparkSession, path: str) -> bool:
    """The table is stored and holds at least one row; reads no more than one."""
    return exists(spark, path) and not spark.read.parquet(path).isEmpty()


def load_once(df: DataFrame, path: str) -> bool:
    """Write unless the table already has rows. True when written."""
    if is_loaded(df.sparkSession, path):
        return False
    append(df, path)
    return True


def insert_new_into(
    incoming: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None, quarantine: str | None = None
) -> int:
    """Append the rows whose key is not stored yet. Running it again adds nothing.

    The incoming rows are computed once, into the shared folder. Of the stored table only the partitions they fall into are read,
    and there only blocks whose keys lie between the least and the greatest incoming one: rows are written in order
    of their keys, so that a narrow load skips most blocks. Rows with a NULL in the key have no place in a keyed table: they go to
    ``quarantine`` (a Parquet folder), or are left out where none is named. The number of such rows is returned.
    """
    spark, keep = incoming.sparkSession, partition_by or []
    batch = stored(incoming, "incoming")
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    bounded = list(dict.fromkeys(k for k in [*keys, *keep] if isinstance(batch.schema[k].dataType, AtomicType)))
    ends = [f(F.when(keyed, F.col(k))).alias(f"{f.__name__}_{k}") for k in bounded for f in (F.min, F.max)]
    facts = batch.agg(F.count_if(~keyed).alias("unkeyed"), F.count_if(keyed).alias("keyed"), *ends).first()
    if quarantine:
        append(batch.where(~keyed), quarantine)
    if not facts["keyed"]:
        return facts["unkeyed"]
    rows = batch.where(keyed)
    target = spark.read.parquet(path) if exists(spark, path) else rows.where(F.lit(False))
    for column in bounded:
        if column in target.columns:
            kind = target.schema[column].dataType
            low, high = (F.lit(facts[f"{end}_{column}"]).cast(kind) for end in ("min", "max"))
            inside = F.col(column).between(low, high)
            target = target.where(inside | F.col(column).isNull() if column in keep else inside)
    for column in keep:
        if column in target.columns:
            # a few values are named one by one; more of them are a range, which has been asked for already
            values = [r[0] for r in rows.select(column).distinct().limit(PARTITIONS_NAMED + 1).collect()]
            if len(values) <= PARTITIONS_NAMED:
                target = target.where(F.col(column).isin([v for v in values if v is not None]) | F.col(column).isNull())
    fresh = new_rows(target, rows, keys)
    if keep:
        placed = fresh.hint("rebalance", *[F.col(c) for c in keep]).sortWithinPartitions(*keep, *keys)
        placed.write.mode("append").partitionBy(*keep).parquet(path)
    else:
        append(fresh.repartitionByRange(*keys).sortWithinPartitions(*keys), path)
    return facts["unkeyed"]


def with_year(order: DataFrame, column: str = "order_purchase_timestamp") -> DataFrame:
    return order.withColumn(YEAR_COLUMN, F.year(column))


def write_by_year(order: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Year-partitioned table.

    Rows are brought together by year, so that a task writes into few folders, but a year is cut into
    as many tasks as its size asks for (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): a year
    holding a large share of the rows is not written by one task.
    """
    with_year(order).hint("rebalance", F.col(YEAR_COLUMN)).write.mode(mode).partitionBy(YEAR_COLUMN).parquet(path)


def write_clustered(df: DataFrame, path: str, column: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Rows in order of a column, so that the minimum and maximum kept per block let readers skip blocks.

    Equal values may end up in several files: a random second key splits a value that is very common.
    """
    spread = F.xxhash64(*[c for c in df.columns if df.schema[c].dataType.typeName() not in ("variant", "map")])
    keyed = df.withColumn("_spread", spread)
    ranged = (
        keyed.repartitionByRange(files, column, "_spread") if files else keyed.repartitionByRange(column, "_spread")
    )
    ranged.sortWithinPartitions(column).drop("_spread").write.mode(mode).parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, mode: str = "overwrite") -> None:
    """Catalogue table bucketed and sorted by its join key: tables bucketed alike join without a shuffle."""
    df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
