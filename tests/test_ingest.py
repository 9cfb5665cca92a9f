import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tradewind.operators.upsert import insert_new
from tradewind.plans import reports as R
from tradewind.schemas import COLLECTIONS, CSV_COLUMNS, TABLES
from tradewind.sources import files as S
from tradewind.sources import load as L
from tradewind.sources import sinks as K

HEADERS = {
    "geolocation": "zip,lat,lng,city,state",
    "product_category": "name,english",
    "customer": "id,uid,zip,city,state",
    "seller": "id,zip,city,state",
    "product": "id,cat,nl,dl,pq,wg,lc,hc,wc",
    "order": "id,cid,status,ts,aa,dcc,dcu,edd",
    "order_item": "oid,iid,pid,sid,sld,pr,fv",
    "payment": "oid,seq,type,inst,val",
    "review": "rid,oid,sc,ct,msg,cd,at",
}
LINES = {
    "geolocation": ["01001,-23.5,-46.6,sao paulo,SP", "01001,-23.4,-46.5,sao bernardo,SP", "20040,-22.9,-43.2,rio,RJ"],
    "product_category": ["eletronicos,electronics"],
    "customer": ["c1,u1,01001,sao paulo,SP", "c2,u1,01001,sao paulo,SP", "c3,u2,20040,rio,RJ"],
    "seller": ["s1,20040,rio,RJ"],
    "product": ["p1,eletronicos,15,,1,350,30,10,20", "p2,,,,,0,1,1,1", "p3,jogos,1,1,1,-1,1,1,1", "p4,jogos,1,1,1,,1,1,1"],
    "order": [
        "o1,c1,delivered,2017-05-15 10:30:00,2017-05-15 11:00:00,,2017-05-20 09:00:00,2017-05-25 00:00:00",
        "o2,c3,shipped,2018-01-02 10:00:00,,,,2018-01-20 00:00:00",
        "o2,c3,shipped,2018-01-02 10:00:00,,,,2018-01-20 00:00:00",
    ],
    "order_item": ["o1,1,p1,s1,2017-05-18 23:59:59,199.90,15.50", "o9,1,p1,s1,2017-05-18 23:59:59,1.00,1.00"],
    "payment": ["o1,1,credit_card,3,199.90"],
    "review": ['r1,o1,5,,"Gostei, ""banana"" nan\nsegunda linha",2017-05-26 00:00:00,'],
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    out = {}
    for name, lines in LINES.items():
        path = folder / f"{name}.csv"
        path.write_text("\n".join([HEADERS[name], *lines]) + "\n", encoding="utf-8-sig")  # with a byte-order mark
        out[name] = S.read_raw(spark, str(path), name)
    return out


def test_raw_fields_by_position_and_text(raw):
    assert raw["customer"].columns == CSV_COLUMNS["customer"]
    assert raw["customer"].first()["zip_code_prefix"] == "01001"
    assert raw["customer"].first()["customer_id"] == "c1"


def test_clean_tables(raw):
    t = L.clean_tables(raw)
    assert {n: df.count() for n, df in t.items()} == {
        "geolocation": 2, "product_category": 1, "customer": 2, "seller": 1, "product": 4, "order": 2,
        "order_item": 1, "payment": 1, "review": 1}
    for name, df in t.items():
        have = dict(df.dtypes)
        want = {c.split(" ")[0]: c for c in TABLES[name].split(", ")} if name != "order" else {}
        assert all(c in have for c in want if c not in ("specifications", "photo_urls")), name
    assert t["geolocation"].where("zip_code_prefix = '01001'").first()["city"] == "sao bernardo"
    assert {r["product_id"]: r["product_weight_g"] for r in t["product"].collect()} == {
        "p1": Decimal("350.00"), "p2": None, "p3": None, "p4": None}
    assert [r["customer_id"] for r in t["customer"].orderBy("customer_id").collect()] == ["c1", "c3"]
    order = t["order"].where("order_id = 'o1'").first()
    assert order["order_delivered_carrier_date"] is None and order["order_approved_at"] == dt.datetime(2017, 5, 15, 11)
    assert order["promotion_period"] is None
    review = t["review"].first()
    assert review["review_comment_title"] is None and "banana" in review["review_comment_message"]
    assert "nan\n" in review["review_comment_message"]  # only real nulls become NULL
    assert t["order_item"].first()["order_purchase_timestamp"] == dt.datetime(2017, 5, 15, 10, 30)


def test_left_form_keeps_orphans(raw):
    order = L.clean_order(raw["order"]).distinct()
    out = L.clean_order_item(raw["order_item"], order, "left")
    assert rows(out.select("order_id", "order_purchase_timestamp")) == [
        ("o1", dt.datetime(2017, 5, 15, 10, 30)), ("o9", None)]


def test_catalogue_and_categories(raw):
    docs = {r["product_id"]: r for r in L.catalog_documents(raw["product"], raw["product_category"]).collect()}
    assert docs["p1"]["category_name_english"] == "electronics" and docs["p1"]["product_description_lenght"] == 0
    assert docs["p2"]["product_category_name"] == "" and docs["p2"]["category_name_english"] == ""
    assert docs["p4"]["product_weight_g"] == 0
    assert set(docs["p1"].asDict()) <= {c.split(" ")[0] for c in COLLECTIONS["products_catalog"].split(", ")}
    master = L.category_master(raw["product_category"], L.clean_product(raw["product"]))
    assert rows(master) == [("eletronicos", "electronics"), ("jogos", None)]
    assert L.geolocation_documents(raw["geolocation"]).count() == 3
    assert L.renamed(raw["seller"], {"seller_id": "id"}).columns == ["id"]
    assert L.concatenated([raw["seller"], raw["seller"]]).count() == 2


def test_inferred_types_keep_zip_codes(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("zip,n,x\n01001,1,1.5\n20040,2,2.5\n")
    df = S.read_inferred(spark, str(path), ["zip"])
    assert dict(df.dtypes) == {"zip": "string", "n": "int", "x": "double"} and df.first()["zip"] == "01001"


def test_insert_new_keeps_existing_rows(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2), (None, 1)], "k string, v int")
    assert rows(insert_new(target, incoming, ["k"])) == sorted([("a", 1), ("b", 2), (None, 1)], key=repr)
    once = insert_new(target, incoming.where("k is not null"), ["k"])
    assert rows(insert_new(once, incoming.where("k is not null"), ["k"])) == rows(once)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("b", "x\ty", 2), ("c", "", 3)], "k string, t string, n int")
    K.append_tsv(df, str(tmp_path / "tsv"))
    lines = "".join(p.read_text() for p in (tmp_path / "tsv").glob("part-*")).splitlines()
    assert sorted(lines) == ["a\t\\N\t1", "b\tx\\ty\t2", "c\t\t3"]
    K.append_quoted_csv(df, str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part-*"))
    assert '"b","x\ty","2"' in text
    K.append_documents(df, str(tmp_path / "json"))
    assert "null" not in "".join(p.read_text() for p in (tmp_path / "json").glob("part-*"))
    assert not K.is_loaded(spark, str(tmp_path / "t"))
    assert K.load_once(df, str(tmp_path / "t")) and not K.load_once(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    K.insert_new_into(df, str(tmp_path / "u"), ["k"])
    K.insert_new_into(df, str(tmp_path / "u"), ["k"])
    assert S.read_table(spark, str(tmp_path / "u"), "stored_u").count() == 3
    assert spark.sql("select count(*) from stored_u").first()[0] == 3


def test_documents_round_trip(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"_id":"s1","cart":[{"product_id":"p","quantity":2,"unit_price":1.5}],"created_at":"2024-06-20T14:30:00Z"}\n{"_id":"s2"}\n')
    df = S.read_documents(spark, str(path), "user_sessions")
    assert df.where("_id = 's1'").first()["cart"][0]["quantity"] == 2
    assert df.where("_id = 's1'").first()["created_at"] == dt.datetime(2024, 6, 20, 14, 30)
    assert df.where("_id = 's2'").first()["cart"] is None
    assert S.read_raw_documents(spark, str(path)).select(F.try_variant_get("doc", "$._id", "string")).count() == 2


@pytest.fixture(scope="module")
def by_year(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("orders") / "order")
    data = [(f"o{i}", dt.datetime(2016 + i % 3, 1 + i % 12, 1), i) for i in range(90)]
    K.write_by_year(spark.createDataFrame(data, "order_id string, order_purchase_timestamp timestamp, n int"), path)
    return path


def test_year_layout_prunes(spark, by_year):
    df = spark.read.parquet(by_year)
    assert sorted(p for p in os.listdir(by_year) if "=" in p) == [f"purchase_year={y}" for y in (2016, 2017, 2018)]
    report = R.range_summary(df, "2018-01-01", "2018-12-31")
    assert "PartitionFilters: [isnotnull(purchase_year" in plan_of(report)
    assert report.first()["filas"] == 30 and R.partition_summary(df).count() == 3
    assert S.read_year(spark, by_year, 2017).count() == 30
    files = {r[0] for r in S.read_year(spark, by_year, 2017).select(F.input_file_name()).distinct().collect()}
    assert all("purchase_year=2017" in f for f in files)


def test_clustered_layout_has_narrow_blocks(spark, tmp_path):
    df = spark.range(1000).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(100)).cast("int").alias("v"))
    K.write_clustered(df, str(tmp_path / "c"), "v", files=4)
    out = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).agg(F.min("v").alias("a"), F.max("v").alias("b")).orderBy("a").collect()
    assert len(out) > 1 and all(x["b"] <= y["a"] for x, y in zip(out, out[1:]))


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.sql(f"create database if not exists bucketed_test location '{tmp_path}'")
    try:
        for name in ("a", "b"):
            df = spark.range(200).select(F.col("id").alias("order_id"), F.lit(name).alias(name))
            K.write_bucketed(df, f"bucketed_test.{name}", ["order_id"], 4)
        limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = spark.table("bucketed_test.a").join(spark.table("bucketed_test.b"), "order_id")
        assert "Exchange" not in plan_of(joined) and joined.count() == 200
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    finally:
        spark.sql("drop database if exists bucketed_test cascade")


def test_tsv_round_trip(spark, tmp_path):
    rows_in = [(1, "a\tb\nc\rd\\e", dt.datetime(2020, 1, 2, 3, 4, 5)), (2, "\\N", None), (3, None, None), (4, "", None), (5, "\\\\n\\t", None)]
    schema, path = "id int, note string, at timestamp", str(tmp_path / "tsv")
    K.append_tsv(spark.createDataFrame(rows_in, schema), path)
    assert rows(S.read_tsv(spark, path, schema)) == sorted(rows_in, key=repr)


def test_large_files_are_split(spark, tmp_path):
    path = str(tmp_path / "big.csv")
    with open(path, "w") as file:
        file.write("order_id,customer_id\n")
        file.writelines(f"o{i},c{i}\n" for i in range(200_000))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        df = S.read_csv(spark, path, "order_id string, customer_id string")
        assert df.rdd.getNumPartitions() > 3 and df.count() == 200_000
        assert S.read_csv(spark, path, "order_id string, customer_id string", multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_insert_reads_only_the_years_it_touches(spark, by_year, tmp_path):
    keys, away = ["order_id", "order_purchase_timestamp"], str(tmp_path / "away")
    new = [("o1", dt.datetime(2017, 2, 1), 1), ("x1", dt.datetime(2017, 2, 1), 1), (None, dt.datetime(2017, 2, 1), 1)]
    incoming = K.with_year(spark.createDataFrame(new, "order_id string, order_purchase_timestamp timestamp, n int"))
    target = str(tmp_path / "order")
    K.write_by_year(spark.read.parquet(by_year).drop("purchase_year"), target)
    os.rename(f"{target}/purchase_year=2018", str(tmp_path / "kept"))
    os.makedirs(f"{target}/purchase_year=2018")
    with open(f"{target}/purchase_year=2018/part-broken.parquet", "w") as file:
        file.write("not parquet: reading this year would fail")
    for _ in range(2):
        assert K.insert_new_into(incoming, target, keys, ["purchase_year"], quarantine=away) == 1
    assert spark.read.parquet(f"{target}/purchase_year=2017").count() == 31
    assert spark.read.parquet(away).count() == 2


def test_insert_skips_blocks_and_reads_the_load_once(spark, tmp_path, monkeypatch):
    """A narrow load filters the stored keys by its least and greatest; the incoming rows are computed once."""
    target, seen, computed = str(tmp_path / "items"), [], []
    K.insert_new_into(spark.range(10_000).select("id", F.col("id").alias("n")), target, ["id"])
    find, keep = K.new_rows, K.stored
    monkeypatch.setattr(K, "new_rows", lambda t, rows, keys: (seen.append((plan_of(t), rows.inputFiles())), find(t, rows, keys))[1])
    monkeypatch.setattr(K, "stored", lambda df, purpose: (computed.append(purpose), keep(df, purpose))[1])
    load = spark.range(9_990, 10_010).select("id", F.lit(0).cast("bigint").alias("n")).union(spark.sql("select cast(null as bigint), 1L"))
    for _ in range(2):  # may be repeated
        assert K.insert_new_into(load, target, ["id"]) == 1
    assert computed == ["incoming"] * 2 and all("incoming-" in f for _, files in seen for f in files)
    assert "GreaterThanOrEqual(id,9990)" in seen[0][0] and "LessThanOrEqual(id,10009)" in seen[0][0]
    stored = spark.read.parquet(target)
    assert stored.count() == 10_010 and stored.where("id = 9999").first()["n"] == 9999
    assert K.insert_new_into(load.where("id is null"), target, ["id"]) == 1 and stored.count() == 10_010


def test_insert_with_many_partition_values(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "PARTITIONS_NAMED", 3)
    path = str(tmp_path / "parts")
    rows_in = spark.range(40).select("id", (F.col("id") % 8).alias("part"))
    for _ in range(2):
        K.insert_new_into(rows_in, path, ["id"], ["part"])
    assert spark.read.parquet(path).count() == 40
