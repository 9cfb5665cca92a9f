"""Protection of personal columns over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.privacy import decrypt, encrypt, salted_hash


def read_key(spark, path: str) -> DataFrame:
    """A one-row key table from a file of 16, 24 or 32 bytes."""
    return spark.read.format("binaryFile").load(path).select(F.col("content").alias("key"))


def read_secrets(spark, key_path: str, salt_path: str) -> DataFrame:
    """Key and salt from two files, as the one-row table that ``protect_pii`` takes."""
    salt = read_key(spark, salt_path).select(F.hex("key").alias("salt"))
    return read_key(spark, key_path).select("key", salt.scalar().alias("salt"))


def protect_pii(df: DataFrame, secrets: DataFrame, to_encrypt: list[str], to_hash: list[str]) -> DataFrame:
    """Encrypt some columns and replace others by salted hashes.

    ``secrets`` has one row with ``key`` (binary) and, for hashes, ``salt`` (text). It enters as a
    scalar sub-query, so neither value appears in a plan.
    """
    out = df
    for column in to_encrypt:
        out = out.withColumn(column, encrypt(F.col(column), secrets.select("key").scalar()))
    for column in to_hash:
        out = out.withColumn(column, salted_hash(F.col(column), secrets.select("salt").scalar()))
    return out


def reveal(df: DataFrame, secrets: DataFrame, columns: list[str]) -> DataFrame:
    """Decrypt columns written by ``protect_pii``."""
    for column in columns:
        df = df.withColumn(column, decrypt(F.col(column), secrets.select("key").scalar()))
    return df
