import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tradewind.operators import lifecycle as Y
from tradewind.session import workspace
from tradewind.sources import sinks as K
from tradewind.streaming import events as S


def make_orders(spark, years):
    data = [(f"o{y}{i}", dt.datetime(y, 6, 1 + i)) for y in years for i in range(5)]
    return spark.createDataFrame(data, "order_id string, order_purchase_timestamp timestamp")


def test_archive_a_year(spark, tmp_path):
    table, archive = str(tmp_path / "order"), str(tmp_path / "archive")
    K.write_by_year(make_orders(spark, [2016, 2017]), table)
    kept = {f: os.path.getmtime(f"{table}/purchase_year=2017/{f}") for f in os.listdir(f"{table}/purchase_year=2017")}
    assert Y.archive_year(spark, table, archive, 2016) == "Partition order_2016 archived as archive.arch_order_2016"
    assert [r[0] for r in spark.read.parquet(table).select("purchase_year").distinct().collect()] == [2017]
    assert spark.read.parquet(f"{archive}/arch_order_2016").count() == 5
    assert Y.archive_year(spark, table, archive, 2016) == "Partition order_2016 does not exist"
    assert kept == {f: os.path.getmtime(f"{table}/purchase_year=2017/{f}") for f in os.listdir(f"{table}/purchase_year=2017")}


def test_archive_loses_no_row(spark, tmp_path):
    table, archive = str(tmp_path / "order"), str(tmp_path / "archive")
    orders = K.with_year(make_orders(spark, [2016]))
    foreign = orders.limit(1).withColumn("order_id", F.lit("zzz"))
    K.append(foreign, f"{archive}/arch_order_2016")
    K.write_by_year(orders.where("order_id = 'o20160'").drop("purchase_year"), table)  # as many rows, other content
    assert "archived" in Y.archive_year(spark, table, archive, 2016)
    assert rows(spark.read.parquet(archive + "/arch_order_2016").select("order_id")) == [("o20160",), ("zzz",)]
    late = orders.where("order_id <> 'o20160'").union(orders.where("order_id = 'o20161'"))  # late rows, one of them twice
    K.write_by_year(late.drop("purchase_year"), table)
    for _ in range(2):  # may be repeated
        Y.archive_year(spark, table, archive, 2016)
    assert spark.read.parquet(archive + "/arch_order_2016").count() == 7
    assert not [f for f in os.listdir(archive) if f.startswith("_")]


def test_archive_after_a_failure(spark, tmp_path, monkeypatch):
    """Lost before, while and after the staged files are moved: a repetition ends with every row once."""
    orders = make_orders(spark, [2016])
    for n, when in enumerate(("mkdirs", "moving", "done")):
        table, archive = str(tmp_path / f"order{n}"), str(tmp_path / f"archive{n}")
        K.write_by_year(orders, table)
        create, reads = type(spark).createDataFrame, []

        def failing(self, rows, schema=None, *args, when=when, reads=reads, **kwargs):
            state = rows[0][-1] if rows and schema == Y._LEDGER else None
            if state == when and not reads:
                reads.append(1)
                raise OSError("lost")
            return create(self, rows, schema, *args, **kwargs)

        monkeypatch.setattr(type(spark), "createDataFrame", failing)
        if when == "mkdirs":
            monkeypatch.setattr(Y, "_exists", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            Y.archive_year(spark, table, archive, 2016)
        monkeypatch.undo()
        Y.archive_year(spark, table, archive, 2016)
        assert rows(spark.read.parquet(f"{archive}/arch_order_2016").select("order_id")) == rows(orders.select("order_id"))
        assert not os.path.exists(f"{table}/purchase_year=2016")


def test_digests_of_bags(spark):
    df = spark.range(10).selectExpr("id AS a", "id AS b")
    digest = df.groupBy(F.lit("f").alias("file")).agg(*Y.bag_digest(["a", "b"]))
    assert digest.first()["rows"] == 10
    again = df.repartition(3).groupBy(F.lit("f").alias("file")).agg(*Y.bag_digest(["a", "b"])).first()
    assert tuple(again) == tuple(digest.first())
    assert tuple(df.union(df.limit(1)).groupBy(F.lit("f").alias("file")).agg(*Y.bag_digest(["a", "b"])).first()) != tuple(again)


def test_split_the_open_partition(spark, tmp_path):
    table, rest = str(tmp_path / "order"), str(tmp_path / "rest")
    K.write_by_year(make_orders(spark, [2018]), table)
    K.append(make_orders(spark, [2018, 2019, 2020]), rest)
    for _ in range(2):  # may be repeated
        Y.split_open_partition(spark, rest, table, ["order_id", "order_purchase_timestamp"])
    assert rows(spark.read.parquet(table).groupBy("purchase_year").count()) == [(2018, 5), (2019, 5), (2020, 5)]


def test_policy(spark):
    years = spark.createDataFrame([(2025,), (2020,), (2019,), (2015,), (2014,), (2013,)], "purchase_year int")
    got = Y.classify_partitions(years, 2025, F.col("purchase_year") != 2013)
    assert {r["purchase_year"]: r["action"] for r in got.collect()} == {
        2025: "active", 2020: "active", 2019: "archive", 2015: "archive", 2014: "delete", 2013: "archive"}
    assert "delete" not in {r["action"] for r in Y.classify_partitions(years, 2025).collect()}


def test_expiry(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, None), (2, t, dt.datetime(2024, 1, 5))], "id int, timestamp timestamp, ttl_expire timestamp")
    live, gone = Y.ttl_split(df, "ttl_expire", "2024-01-05 00:00:00")
    assert ([r["id"] for r in live.collect()], [r["id"] for r in gone.collect()]) == ([1], [2])
    filled = Y.with_event_ttl(df).orderBy("id").collect()
    assert [r["ttl_expire"] for r in filled] == [dt.datetime(2024, 3, 31), dt.datetime(2024, 1, 5)]


def feed(spark, path, batches, schema):
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
        yield i


SCHEMA = "event_id int, timestamp timestamp, customer_unique_id string, event_type string"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def collected(spark, path, root, build):
    """One run over what is new, into the same sink and state."""
    stream = build(spark.readStream.schema(SCHEMA).parquet(path))
    query = (stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{root}/state")
             .trigger(availableNow=True).start(f"{root}/rows"))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    batches = [
        [(1, at(10), "a", "view"), (2, at(10, 30), "a", "view"), (3, at(13), "a", "cart")],
        [(4, at(10, 45), "a", "view"), (5, at(15), "a", "view")],  # the first one comes too late
    ]
    for _ in feed(spark, path, batches, SCHEMA):
        out = collected(spark, path, str(tmp_path), S.event_counts)
    assert rows(out) == [(at(10), "view", 2), (at(13), "cart", 1)]


def test_sessions_end_after_a_pause(spark, tmp_path):
    path = str(tmp_path / "in")
    batches = [[(1, at(10), "a", "x"), (2, at(10, 20), "a", "x"), (3, at(11, 30), "a", "x"), (4, at(14), "b", "x")]]
    for _ in feed(spark, path, batches, SCHEMA):
        out = collected(spark, path, str(tmp_path), S.session_summaries)
    assert rows(out) == [("a", at(10), at(10, 50), 2), ("a", at(11, 30), at(12), 1)]


def test_arrivals_are_kept_once_across_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    batches = [[(1, at(10), "a", "x"), (1, at(10), "a", "x")], [(1, at(10), "a", "x"), (2, at(10, 5), "a", "x")]]
    for _ in feed(spark, path, batches, SCHEMA):
        out = collected(spark, path, str(tmp_path), lambda df: S.deduplicated(df, ["event_id"]))
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2]
    assert out.where("event_id = 2").first()["ttl_expire"] == dt.datetime(2024, 3, 31, 10, 5)


def test_workspace_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    a, b = workspace(spark, "x"), workspace(spark, "x")
    assert a != b and (root is None or a.startswith(root))


def test_a_second_run_reads_only_new_files(spark, tmp_path):
    """Open windows come from the state; files that were read are not read again."""
    folder, root = tmp_path / "feed", str(tmp_path / "run")
    schema = "timestamp timestamp, event_type string, customer_unique_id long"

    def arrive(name, *times):
        rows = [(dt.datetime(2024, 1, 1, h, m), "view", 1) for h, m in times]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / name))

    def run(build, held, where):
        stream = build(spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(folder)))
        return rows(S.with_open(S.advance(stream, where), held(spark, where)).drop("session_end"))

    arrive("one", (0, 5), (0, 10), (1, 50))
    counts, sessions = root + "-counts", root + "-sessions"
    day = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    assert run(S.event_counts, S.open_counts, counts) == sorted([(day(0), "view", 2, False), (day(1), "view", 1, True)], key=repr)
    assert run(S.session_summaries, S.open_sessions, sessions) == sorted([(1, day(0, 5), 2, False), (1, day(1, 50), 1, True)], key=repr)
    for file in (folder / "one").glob("part-*"):
        file.write_text("not parquet: reading this file again would fail")
    for file in (folder / "one").glob(".*.crc"):
        file.unlink()
    arrive("two", (2, 5), (5, 0))
    want = [(day(0), "view", 2, False), (day(1), "view", 1, False), (day(2), "view", 1, False), (day(5), "view", 1, True)]
    assert run(S.event_counts, S.open_counts, counts) == sorted(want, key=repr)
    want = [(1, day(0, 5), 2, False), (1, day(1, 50), 2, False), (1, day(5), 1, True)]
    assert run(S.session_summaries, S.open_sessions, sessions) == sorted(want, key=repr)
