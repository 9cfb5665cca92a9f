import random
import re

from pyspark.sql import functions as F

from helpers import plan_of, rows
from tradewind.functions import text
from tradewind.sources import token_table as K


def test_search_equals_the_scan(spark, tmp_path):
    rng, path = random.Random(9), str(tmp_path / "tokens")
    words = ["plate", "bolt", "Plate,", "nut", "ação", "the", "the"]
    make = lambda: " ".join(rng.choices(words, k=rng.randrange(6)))
    data = [(i, make() if i % 7 else None, make()) for i in range(200)]
    df = spark.createDataFrame(data, "id int, name string, description string")
    K.write_tokens(df.where("id < 150"), "id", ["name", "description"], path)
    K.write_tokens(df.where("id >= 150"), "id", ["name", "description"], path, mode="append")
    for query in ("plate bolt", "AÇÃO", "none", "the"):
        terms, columns = text.search_terms(query), [F.col("name"), F.col("description")]
        want = df.where(text.matches_any(columns, terms)).select("id", F.round(text.text_score(columns, terms), 9))
        assert rows(K.search(spark, path, query).select("id", F.round("score", 9))) == rows(want)
    best = [tuple(r) for r in K.search(spark, path, "plate", top=5).select(F.round("score", 9), "id").collect()]
    everything = rows(K.search(spark, path, "plate").select(F.round("score", 9), "id"))
    assert best == sorted(everything, key=lambda r: (-r[0], r[1]))[:5]
    got = {r["token"]: r["documents"] for r in K.frequencies(spark, path).collect()}
    assert got["bolt"] == df.where(text.matches_any([F.col("name"), F.col("description")], ["bolt"])).count()
    assert rows(K.frequencies(spark, path, ["nut"])) == [("nut", got["nut"])]


def test_search_reads_the_buckets_of_its_terms(spark, tmp_path):
    path = str(tmp_path / "tokens")
    df = spark.range(300).select("id", F.concat(F.lit("word"), F.col("id")).alias("name"))
    K.write_tokens(df, "id", ["name"], path)
    found = K.search(spark, path, "word5")
    plan = plan_of(found)
    assert found.count() == 1
    # the hash of the term is a literal by then
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (=|IN) \(?\d+", plan) and re.search(r"PushedFilters: \[[^\]]*token", plan)


def test_entries_move_once(spark, tmp_path, monkeypatch):
    """Only the table itself is dealt by bucket; counts in documents and documents of words need no exchange of all entries."""
    path, plans = str(tmp_path / "tokens"), []
    write = type(spark.range(0).write).parquet
    monkeypatch.setattr(type(spark.range(0).write), "parquet", lambda self, *a, **b: plans.append(plan_of(self._df)) or write(self, *a, **b))
    df = spark.createDataFrame([(i, "a b a", "b c") for i in range(20)], "id int, name string, description string")
    K.write_tokens(df, "id", ["name", "description"], path)
    assert sum(p.count("Exchange hashpartitioning(token") for p in plans) == 0 and not any("id#" in x for p in plans for x in re.findall(r"Exchange hashpartitioning\(bucket#[^)]*token#[^)]*", p))
    stored = rows(spark.read.parquet(f"{path}/tokens").where("id = 3").select("token", "field", "count", "size"))
    assert stored == [("a", "name", 2, 3), ("b", "description", 1, 2), ("b", "name", 1, 3), ("c", "description", 1, 2)]
    assert rows(K.frequencies(spark, path)) == [("a", 20), ("b", 20), ("c", 20)]


def test_ids_that_come_again_count_once(spark, tmp_path):
    path = str(tmp_path / "tokens")
    df = spark.createDataFrame([(1, "a b"), (1, "a c c"), (None, "a"), (None, "a d"), (2, "a"), (3, "")], "id int, name string")
    K.write_tokens(df.where("id = 1 and name = 'a b' or id >= 2"), "id", ["name"], path)
    K.write_tokens(df.where("id is null or name = 'a c c'"), "id", ["name"], path, mode="append")
    assert rows(K.frequencies(spark, path)) == [("a", 3), ("b", 1), ("c", 1), ("d", 1)]


def test_words_are_counted_row_by_row(spark, tmp_path, monkeypatch):
    """Arrays of a document hold words and numbers only: no records are made or sorted inside them, and of a table with one field no constants move."""
    plans, write = [], type(spark.range(0).write).parquet
    monkeypatch.setattr(type(spark.range(0).write), "parquet", lambda self, *a, **b: plans.append(plan_of(self._df)) or write(self, *a, **b))
    df = spark.createDataFrame([(1, "b a b", "b c C"), (2, None, ""), (3, "", "É é a1")], "id int, name string, description string")
    K.write_tokens(df, "id", ["name"], str(tmp_path / "one"))
    assert not any("struct(" in line for line in plans[0].splitlines() if "lambda" in line) and "name AS field" not in plans[0].split("Exchange")[-1]
    K.write_tokens(df, "id", ["name", "description"], str(tmp_path / "two"))
    read = lambda name: rows(spark.read.parquet(str(tmp_path / name / "tokens")).select("id", "token", "field", "count", "size", "first"))
    assert read("one") == [(1, "a", "name", 1, 3, True), (1, "b", "name", 2, 3, True)]
    assert read("two") == [
        (1, "a", "name", 1, 3, True),
        (1, "b", "description", 1, 3, False),
        (1, "b", "name", 2, 3, True),
        (1, "c", "description", 2, 3, True),
        (3, "a1", "description", 1, 3, True),
        (3, "é", "description", 2, 3, True),
    ]
