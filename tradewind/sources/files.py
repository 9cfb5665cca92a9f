"""Readers for the text files, documents and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.temporal import YEAR_COLUMN
from tradewind.schemas import COLLECTIONS, CSV_COLUMNS


# Tables whose texts hold line breaks; only their files have to be read whole.
MULTI_LINE = {"review"}


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header line into given types. A byte-order mark is dropped by the reader.

    A file is split between tasks unless ``multi_line``: quoted line breaks can only be found from the start of a file.
    """
    return spark.read.schema(schema).options(header=True, multiLine=multi_line, escape='"', enforceSchema=True).csv(path)


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV of a table with every field as text, under the table's column names, by position."""
    return read_csv(spark, path, ", ".join(f"{c} string" for c in CSV_COLUMNS[table]), table in MULTI_LINE)


def read_inferred(
    spark: SparkSession, path: str, text_columns: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with inferred types for exploration; codes with leading zeros are kept as text.

    Types are inferred from one pass over the file. The columns listed are read as text, not cast
    back from numbers, so that their zeros survive.
    """
    inferred = spark.read.options(header=True, inferSchema=True, multiLine=multi_line, escape='"').csv(path)
    keep = set(text_columns or [])
    schema = ", ".join(
        f"`{f.name}` {'string' if f.name in keep else f.dataType.simpleString()}" for f in inferred.schema.fields
    )
    return read_csv(spark, path, schema, multi_line)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``sinks.append_tsv`` writes: escapes resolved, ``\\N`` as NULL. One record a line, so files are split."""
    parts = F.split("value", "\t", -1)
    wanted = T.StructType.fromDDL(schema).fields

    def field(i: int, f: T.StructField):
        raw = F.get(parts, F.lit(i))
        value = F.when(raw != "\\N", raw)
        if f.dataType.typeName() == "string":
            # split at escaped backslashes, so that what follows one is never taken for an escape
            pieces = F.transform(
                F.split(value, r"\\\\", -1),
                lambda x: F.replace(F.replace(F.replace(x, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
            )
            return F.array_join(pieces, "\\").alias(f.name)
        return value.cast(f.dataType).alias(f.name)

    return spark.read.text(path).select(*(field(i, f) for i, f in enumerate(wanted)))


def read_documents(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """JSON documents of a collection, one per line; missing fields are NULL."""
    return spark.read.schema(COLLECTIONS[collection]).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]X").json(path)


def read_raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents as VARIANT, untouched, for validation."""
    return spark.read.option("singleVariantColumn", "doc").json(path)


def read_table(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """A stored table; with ``view`` it can also be named in SQL."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_year(spark: SparkSession, path: str, year: int) -> DataFrame:
    """One year of a year-partitioned table; the other years are not listed or read."""
    return spark.read.parquet(path).where(F.col(YEAR_COLUMN) == year)
