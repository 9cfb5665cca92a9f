import math

import numpy as np
import pytest

from tradewind.llm import toxicity
from tradewind.llm.queries import op12_toxicity

LABELS = "doc_id long, quality int, toxic int, text string"


def test_held_out_documents(spark):
    """Labelled documents that were not learned from are told apart; about one toxic label in twenty is on a text without a sign of it."""
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op12_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic, other = [p for t, p in held if t], [p for t, p in held if not t]
    assert len(toxic) > 50 and np.mean(toxic) > 0.88 and np.mean(other) < 0.01


def test_counts_and_ratios_by_hand(spark):
    texts = [("abcd", 1), ("ABCD abcd", 1), ("xyz", 0), ("xyz abcd", 0), ("", 0), (None, 1)]
    counts = {r["bucket"]: (r["toxic"], r["other"]) for r in toxicity.feature_counts(spark.createDataFrame(texts, "text string, toxic int").repartition(3)).collect()}

    def bucket(gram):
        return int(toxicity.buckets(np.frombuffer(gram, np.uint8))[0])

    assert counts[bucket(b"abc")] == (2, 1) and counts[bucket(b"xyz")] == (0, 2)
    found = toxicity.ratios(spark.createDataFrame([(1, 90, 10), (2, 50, 50), (3, 1, 80)], "bucket long, toxic long, other long"), 100, 100)
    found = {r["bucket"]: r["ratio"] for r in found.collect()}
    assert set(found) == {1, 3} and math.isclose(found[1], math.log(90.5 / 10.5))


def test_fit_separates():
    ratio = np.array([2.0, -2.0, 0.5])
    features = [np.array([0, 2]), np.array([0]), np.array([1, 2]), np.array([1])] * 20
    toxic = np.array([1.0, 1, 0, 0] * 20)
    gain, bias = toxicity.fit(ratio, features, toxic)
    assert all((bias + gain[f].sum() > 0) == t for f, t in zip(features, toxic))


def test_many_documents_in_one_bucket(spark):
    """Counts beyond one and two bytes add up; labels that are not sent give the same rows."""
    rows = spark.range(70_000).selectExpr("'abc' AS text", "cast(id % 7 = 0 AS int) AS toxic").coalesce(1)
    assert [tuple(r)[1:] for r in toxicity.feature_counts(rows).collect()] == [(10_000, 60_000)]


def test_labels_joined_in_a_shuffle(spark, documents, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    sent = sorted(tuple(r) for r in toxicity.labelled(documents, labels).select("doc_id", "toxic").collect())
    monkeypatch.setattr(toxicity, "LABELS_SENT", 0)
    assert sent == sorted(tuple(r) for r in toxicity.labelled(documents, labels).select("doc_id", "toxic").collect())


@pytest.mark.parametrize("labels", [[], [(1, 1, None, "clash")], [(7, 1, 1, "clash"), (7, 0, 0, "clash"), (9, 1, 1, "x")]])
def test_awkward_rows(spark, awkward, labels):
    """Nulls, empty and very long texts, repeated rows and labels, labels of one kind or none: a score for every row."""
    rows = toxicity.judged(awkward, spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [None]


def test_no_rows(spark, nothing):
    assert toxicity.judged(nothing, spark.createDataFrame([(1, 1, 1, "x")], LABELS)).collect() == []
