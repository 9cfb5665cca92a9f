"""Retention: expiry of documents, archiving and splitting of year partitions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.temporal import YEAR_COLUMN, bound, plus
from tradewind.sources.sinks import insert_new_into, with_year

# Ages in years up to which a partition stays active or archived; expiry of documents.
ACTIVE_YEARS = 5
ARCHIVED_YEARS = 10
EVENT_TTL = "90 days"
SESSION_TTL = "24 hours"


def with_event_ttl(events: DataFrame, column: str = "ttl_expire") -> DataFrame:
    """Expiry of events: the stored value where there is one, otherwise 90 days after the event."""
    return _with_ttl(events, column, plus("timestamp", EVENT_TTL))


def with_session_ttl(sessions: DataFrame, column: str = "expires_at") -> DataFrame:
    """Expiry of sessions: the stored value where there is one, otherwise 24 hours after creation."""
    return _with_ttl(sessions, column, plus("created_at", SESSION_TTL))


def _with_ttl(df: DataFrame, column: str, derived: Column) -> DataFrame:
    value = F.coalesce(F.col(column), derived) if column in df.columns else derived
    return df.withColumn(column, value)


def ttl_split(df: DataFrame, column: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Live and expired rows. A row expires at the stored moment; rows without one never do."""
    expired = F.coalesce(F.col(column) <= bound(df, column, as_of), F.lit(False))
    return df.where(~expired), df.where(expired)


def classify_partitions(years: DataFrame, as_of_year: int, has_backup: Column | None = None) -> DataFrame:
    """What the retention policy asks for each year: ``active``, ``archive`` or ``delete``.

    Years past the archive horizon are deleted only if there is a backup.
    """
    age = F.lit(as_of_year) - F.col(YEAR_COLUMN)
    safe = F.lit(False) if has_backup is None else F.coalesce(has_backup, F.lit(False))
    action = (
        F.when(age <= ACTIVE_YEARS, "active").when((age <= ARCHIVED_YEARS) | ~safe, "archive").otherwise("delete")
    )
    return years.withColumn("age", age).withColumn("action", action)


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


_LEDGER = "file string, rows bigint, mixed bigint, total decimal(38,0), batch string, state string"


def bag_digest(columns: list[str]) -> list[Column]:
    """Number of rows and two digests of their contents, equal for equal bags of rows in any order."""
    a, b = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    return [F.count(F.lit(1)).alias("rows"), F.bit_xor(a).alias("mixed"), F.sum(b.cast("decimal(20,0)")).cast("decimal(38,0)").alias("total")]


def archive_year(spark: SparkSession, table_path: str, archive_path: str, year: int) -> str:
    """Move one year out of a year-partitioned table into the archive. Returns a message.

    The files of the partition are listed once, and a digest of each file's rows is taken in one pass. A ledger beside the archive
    tells by name and digest which files it holds. Only the others are copied, row by row without a shuffle: into a
    staging folder whose digest has to be theirs, then, once the ledger says so, file by file into the archive; a move that was interrupted is
    finished first. Only then are the listed files removed. So rows that come late join what is archived, rows appended
    meanwhile stay in the table, foreign rows in the archive stay there, and every step may be repeated after a failure. A row that
    comes again in another file is one more row. No other year is read or rewritten.
    """
    # The two messages.
    name, archived = f"order_{year}", f"arch_order_{year}"
    source, fs = _files(spark, f"{table_path}/{YEAR_COLUMN}={year}")
    target, target_fs = _files(spark, f"{archive_path}/{archived}")
    ledger = f"{archive_path}/{archived}.ledger"

    def note(rows: list[tuple], batch: str, state: str) -> None:
        spark.createDataFrame([(*r, batch, state) for r in rows], _LEDGER).coalesce(1).write.mode("append").parquet(ledger)

    def move(batch: str) -> None:
        staging = _files(spark, f"{archive_path}/_staging-{batch}")[0]
        target_fs.mkdirs(target)
        for s in target_fs.listStatus(staging) if target_fs.exists(staging) else ():
            if s.getPath().getName().startswith("part-"):
                target_fs.rename(s.getPath(), spark._jvm.org.apache.hadoop.fs.Path(target, s.getPath().getName()))
        target_fs.delete(staging, True)

    noted = [tuple(r) for r in spark.read.schema(_LEDGER).parquet(ledger).collect()] if _exists(spark, ledger) else []  # a row or two for each file
    finished = {r[4] for r in noted if r[5] == "done"}
    for batch in sorted({r[4] for r in noted} - finished):
        move(batch)
        note([r[:4] for r in noted if r[4] == batch], batch, "done")
    held = {r[:4] for r in noted}

    listed = [s.getPath() for s in fs.listStatus(source) if s.isFile()] if fs.exists(source) else []
    data = {f.getName(): f for f in listed if not f.getName().startswith(("_", "."))}
    if not data:
        return f"Partition {name} does not exist"
    rows = spark.read.parquet(*(f.toString() for f in data.values()))
    columns = rows.columns
    file = F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("file")
    # a file without rows has no digest and nothing to copy
    digests = {r["file"]: tuple(r) for r in rows.select(file, "*").groupBy("file").agg(*bag_digest(columns)).collect()}
    fresh = [f for f, digest in digests.items() if digest not in held]
    if fresh:
        batch = uuid.uuid4().hex
        staging = f"{archive_path}/_staging-{batch}"
        copied = spark.read.schema(rows.schema).parquet(*(data[f].toString() for f in fresh))
        copied.withColumn(YEAR_COLUMN, F.lit(year)).write.parquet(staging)
        n, mixed, total = spark.read.parquet(staging).agg(*bag_digest(columns)).first()
        want = [digests[f] for f in fresh]
        if (n, mixed, total) != (sum(w[1] for w in want), reduce(lambda x, w: x ^ w[2], want, 0), sum(w[3] for w in want)):
            raise RuntimeError(f"{staging} does not hold the rows of {source}")
        note(want, batch, "moving")
        move(batch)
        note(want, batch, "done")
    for f in listed:
        fs.delete(f, False)
    if not fs.listStatus(source):
        fs.delete(source, True)
    return f"Partition {name} archived as archive.{archived}"


def _exists(spark: SparkSession, path: str) -> bool:
    where, fs = _files(spark, path)
    return fs.exists(where)


def split_open_partition(spark: SparkSession, open_path: str, table_path: str, keys: list[str]) -> None:
    """Move rows kept in one open-ended partition into the years of the main table.

    A row belongs to the year its purchase timestamp lies in. Rows the table already has are left
    alone, so the job can be repeated.
    """
    insert_new_into(with_year(spark.read.parquet(open_path)), table_path, keys, [YEAR_COLUMN])
