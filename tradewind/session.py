"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings. Timestamps carry no offset in the inputs, so the zone is pinned.
# The skew settings let a join on a key that holds a large share of the rows be split at run time,
# also where the split costs one more exchange further up.
# Sessions of a customer are merged inside each task before they are brought together.
# Order tables are joined on (order_id, order_purchase_timestamp); an input already partitioned
# by order_id alone may be reused for that.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "tradewind") -> SparkSession:
    """A session for tests and benches on one machine; clusters bring their own."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or 8))
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites of every column expression are only of use while debugging, and cost build time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _own_folder() -> str:
    """A folder for this process alone, removed when it ends; for local sessions that name no shared folder."""
    folder = tempfile.mkdtemp(prefix="tradewind-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where nothing is named and the session is local: on a
    cluster the executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _own_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written once into the shared folder and read from there."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
