"""Intermediate tables in the shared folder: they cut the lineage and survive the loss of an executor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.session import workspace


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written once under ``spark.checkpoint.dir`` and read from there."""
    spark: SparkSession = df.sparkSession
    path = workspace(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing needs any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = {name.rsplit("/", 1)[0] for name in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
