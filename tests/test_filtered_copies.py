import glob
import os

import pytest

from tradewind.sources import filtered as L


def test_filtered_copies(spark, tmp_path, monkeypatch):
    """First fill, second load, a load again with other rows, a load without a row of the filter, and many loads in passes."""
    path, schema, name = str(tmp_path / "table"), "product_id int, product_weight_g int", "weight_from_20"

    def load(which, *weights):
        L.write_load(spark.createDataFrame([(i, w) for i, w in enumerate(weights)], schema), path, which)

    def copied():
        return sorted(r["product_weight_g"] for r in L.read_filtered(spark, path, name).collect())

    load("1", 5, 20, 30)
    assert L.refresh(spark, path, name) == 1 and copied() == [20, 30]
    load("2", 40, None)
    assert copied() == [20, 30]
    assert L.refresh(spark, path, name) == 1 and copied() == [20, 30, 40]
    load("1", 50, 1)
    assert sorted(r["product_weight_g"] or 0 for r in L.read_table(spark, path).collect()) == [0, 1, 40, 50]
    assert L.refresh(spark, path, name) == 1 and copied() == [40, 50]
    load("2", 3)
    assert L.refresh(spark, path, name) == 1 and copied() == [50]
    assert L.refresh(spark, path, name) == 0
    monkeypatch.setattr(L, "LOADS_AT_ONCE", 2)
    for i in range(3, 8):
        load(str(i), 10 * i)
    assert L.refresh(spark, path, name) == 5 and copied() == [30, 40, 50, 50, 60, 70]
    with pytest.raises(ValueError):
        load("a/b", 1)


def test_a_refresh_reads_the_loads_it_lacks(spark, tmp_path):
    path, name = str(tmp_path / "table"), "weight_from_20"
    for which in ("a", "b"):
        L.write_load(spark.range(30).selectExpr("id AS product_id", "cast(id AS int) AS product_weight_g"), path, which)
        L.refresh(spark, path, name)
        for file in glob.glob(f"{path}/rows/load={which}/*/*.parquet"):
            with open(file, "w") as broken:
                broken.write("not parquet: reading this load again would fail")
        for file in glob.glob(f"{path}/rows/load={which}/*/.*.crc"):
            os.remove(file)
        L.write_load(spark.range(0).selectExpr("id AS product_id", "cast(id AS int) AS product_weight_g"), path, "0")
    assert L.read_filtered(spark, path, name).count() == 20


def test_an_unfinished_refresh_is_repeated(spark, tmp_path, monkeypatch):
    path, name = str(tmp_path / "table"), "weight_from_20"
    L.write_load(spark.range(30).selectExpr("id AS product_id", "cast(id AS int) AS product_weight_g"), path, "a")
    note = L._note
    monkeypatch.setattr(L, "_note", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        L.refresh(spark, path, name)
    assert L.read_filtered(spark, path, name).count() == 0
    monkeypatch.setattr(L, "_note", note)
    assert L.refresh(spark, path, name) == 1 and L.read_filtered(spark, path, name).count() == 10
