import datetime as dt
import os
import re

from pyspark.sql import functions as F

from helpers import plan_of, rows
from tradewind.sources import expiry as X

SCHEMA = "id int, expires timestamp"


def table(spark, path):
    at = lambda day, hour: dt.datetime(2024, 5, day, hour)
    data = [(1, at(1, 3)), (2, at(2, 8)), (3, at(2, 20)), (4, at(3, 0)), (5, None), (6, at(9, 9))]
    X.write_by_expiry(spark.createDataFrame(data, SCHEMA), path, "expires")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_sweep_drops_days_and_filters_one(spark, tmp_path):
    path = str(tmp_path / "docs")
    table(spark, path)
    later = os.path.getmtime(f"{path}/expiry_day=2024-05-03")
    live = X.read_live(spark, path, "expires", "2024-05-02 08:00:00")
    assert ids(live) == [3, 4, 5, 6]
    assert re.search(r"PartitionFilters: \[[^\]]*expiry_day", plan_of(live))
    for _ in range(2):  # may be repeated
        X.sweep(spark, path, "expires", "2024-05-02 08:00:00")
        assert ids(X.read_by_expiry(spark, path)) == [3, 4, 5, 6]
    assert os.path.getmtime(f"{path}/expiry_day=2024-05-03") == later and not os.path.exists(f"{path}/expiry_day=2024-05-01")
    assert X.sweep(spark, path, "expires", "2024-05-03 12:00:00") == ["2024-05-02", "2024-05-03"]
    assert ids(X.read_by_expiry(spark, path)) == [5, 6]


def test_changes_move_rows_between_days(spark, tmp_path):
    path = str(tmp_path / "docs")
    table(spark, path)
    far = dt.datetime(2024, 6, 1)
    changes = [(1, dt.datetime(2024, 5, 1, 3), far), (2, dt.datetime(2024, 5, 2, 8), None), (5, None, dt.datetime(2024, 5, 2, 1))]
    for _ in range(2):  # may be repeated
        X.change_expiry(spark, path, "expires", "id", spark.createDataFrame(changes, "id int, old timestamp, new timestamp"))
        got = {r["id"]: r["expires"] for r in X.read_by_expiry(spark, path).collect()}
        assert len(got) == X.read_by_expiry(spark, path).count() == 6
        assert (got[1], got[2], got[5], got[3]) == (far, None, dt.datetime(2024, 5, 2, 1), dt.datetime(2024, 5, 2, 20))
    assert not os.path.exists(f"{path}/expiry_day=2024-05-01")
    days = X.read_by_expiry(spark, path).where("expires is not null").select("id", (F.col("expiry_day") == F.date_format("expires", "yyyy-MM-dd")).alias("right"))
    assert all(r[1] for r in rows(days))
