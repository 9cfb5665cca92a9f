"""Filtered copies of a table that is kept up by loads.

A table's folder holds ``rows``, partitioned by load and version, and ``loads``, a ledger of what has been written
completely. A load that is written again gets a new version; the ledger's last entry for it counts. A filtered copy is a table of
the same form in ``copies/<name>``. Refreshing it takes the loads whose version its ledger lacks, reads nothing but their
partitions, and notes them when their rows are written. So a refresh may be repeated after a failure, and a reader of the
table or of a copy never sees half a load. Who wants the filtered rows reads the copy by name.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradewind.sources.sinks import exists

#: Named row filters that get a copy of their own (what a partial index covers).
NAMED_FILTERS: dict[str, str] = {
    "late_orders": "order_delivered_customer_date > order_estimated_delivery_date",
    "boleto_or_voucher": "payment_type IN ('boleto', 'voucher')",
    "weight_from_20": "product_weight_g >= 20",
    "score_from_4": "avg_review_score >= 4.0",
    "product_views": "event_type = 'product_view'",
}
LOAD, VERSION = "load", "load_version"
_LEDGER = f"{LOAD} string, {VERSION} string, noted timestamp, columns string"
#: Loads that one pass of a refresh takes; their versions are literals of its partition filter.
LOADS_AT_ONCE = 500


def _current(spark: SparkSession, path: str) -> DataFrame:
    """(load, load_version) of every load of a table, its last complete version."""
    if not exists(spark, f"{path}/loads"):
        return spark.createDataFrame([], _LEDGER).select(LOAD, VERSION)
    ledger = spark.read.schema(_LEDGER).parquet(f"{path}/loads")
    return ledger.groupBy(LOAD).agg(F.max_by(VERSION, F.struct("noted", VERSION)).alias(VERSION))


def _note(spark: SparkSession, path: str, loads: list[tuple[str, str]], columns: str) -> None:
    """Enter loads with their versions and the table's columns (a schema as JSON) into the ledger."""
    rows = spark.createDataFrame(loads, f"{LOAD} string, {VERSION} string").withColumns({"noted": F.current_timestamp(), "columns": F.lit(columns)})
    rows.coalesce(1).write.mode("append").parquet(f"{path}/loads")


def _columns(spark: SparkSession, path: str) -> str:
    """The columns of the load that was noted last."""
    return spark.read.schema(_LEDGER).parquet(f"{path}/loads").agg(F.max_by("columns", F.struct("noted", VERSION))).first()[0]


def write_load(df: DataFrame, path: str, load: str) -> None:
    """Write the rows of one load; the same load again takes the place of its earlier rows."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError("a load is named by letters, digits, _ . and -")
    version = uuid.uuid4().hex
    df.write.parquet(f"{path}/rows/{LOAD}={load}/{VERSION}={version}")
    _note(df.sparkSession, path, [(load, version)], df.schema.json())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all loads, with the load they came from."""
    return _rows(spark, path, _columns(spark, path)).join(_current(spark, path), [LOAD, VERSION], "left_semi").drop(VERSION)


def _rows(spark: SparkSession, path: str, columns: str) -> DataFrame:
    # the names of loads and versions are text, also where they look like numbers
    schema = StructType.fromJson(json.loads(columns)).add(LOAD, "string").add(VERSION, "string")
    return spark.read.schema(schema).parquet(f"{path}/rows")


def copy_path(path: str, name: str) -> str:
    return f"{path}/copies/{name}"


def refresh(spark: SparkSession, path: str, name: str) -> int:
    """Bring the copy of a named filter up to date; how many loads it lacked."""
    copy, taken, columns = copy_path(path, name), 0, _columns(spark, path)
    while True:
        lacking = _current(spark, path).join(_current(spark, copy), [LOAD, VERSION], "left_anti")
        part = lacking.orderBy(LOAD).limit(LOADS_AT_ONCE).collect()
        if not part:
            return taken
        fresh = _rows(spark, path, columns).where(F.col(VERSION).isin([r[VERSION] for r in part])).where(NAMED_FILTERS[name])
        # what a failed refresh may have left of these versions is replaced
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD, VERSION).parquet(f"{copy}/rows")
        _note(spark, copy, [(r[LOAD], r[VERSION]) for r in part], columns)
        taken += len(part)


def read_filtered(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of a named filter, from its copy as it was refreshed last."""
    copy = copy_path(path, name)
    rows = _rows(spark, copy, _columns(spark, path))
    return rows.join(_current(spark, copy), [LOAD, VERSION], "left_semi").drop(VERSION)
