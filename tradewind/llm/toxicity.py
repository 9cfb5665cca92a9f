"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the hashed n-grams of its bytes in lower case, each once. For every n-gram the documents of both labels that
have it are counted over all labelled training rows; the smoothed ratio of its shares among toxic and other documents, as a logarithm,
is the value of the feature where it occurs. n-grams whose ratio is within the noise of its counts are left out. On these values a
logistic regression is fitted, to a sample of at most ``SAMPLE`` documents of each label, those with the least hashes.

The counts grow with the corpus; what reaches the driver is the ``FEATURES`` ratios that stand out most and the sample's features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import stored
from tradewind.llm.text import crc_bucket, keys, mixed, slices
from tradewind.operators.topk import top_per_group

FOLDS = 5
#: Lengths of the n-grams, in bytes.
LENGTHS = (3, 4, 5, 6, 7, 8)
BUCKET_BITS = 22
#: Buckets whose counts travel together.
BLOCK = 4096
#: A ratio counts from so many standard errors on; of those that do, the FEATURES that stand out most are kept.
EVIDENCE, FEATURES = 4.0, 8_192
SMOOTHING = 0.5
#: Labelled documents of each label that the weights are fitted to.
SAMPLE = 2048
ROUNDS, PENALTY = 400, 1e-4
#: Labels that are sent to all tasks; more are joined in a shuffle.
LABELS_SENT = 1_000_000


def buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of every n-gram of a text, repeats included; ``data`` has its bytes in lower case."""
    found = [np.zeros(0, np.int64)]
    wide, key = data.astype(np.uint64), keys(LENGTHS[-1], 900)
    total = np.zeros(len(data) + 1, np.uint64)
    for n in range(1, min(LENGTHS[-1], len(data)) + 1):
        # the sum over n bytes from that over one less
        total = total[:-1] + wide[n - 1 :] * key[n - 1]
        if n in LENGTHS:
            found.append((mixed(total + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return np.concatenate(found)


def _lowered(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's bytes with A-Z in lower case; a null text has none."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    for text in texts.cast(pa.large_binary()):
        yield table[np.frombuffer(text.as_py() or b"", np.uint8)]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the documents that may be learned from: labelled, and crc32(doc_id as text) mod 5 not 0.

    A document with several labels is toxic if one of them says so; labels without a value are none.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = stored(known.agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic")), "labels")
    if known.count() <= LABELS_SENT:
        known = F.broadcast(known)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.where(crc_bucket("doc_id", FOLDS) != 0).join(known, "doc_id")


def feature_counts(training: DataFrame) -> DataFrame:
    """(bucket, toxic, other): documents of each label that have an n-gram of the bucket; tasks count first, by blocks of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((1 << BUCKET_BITS, 2), np.int32)
        for batch in slices(batches, "text"):
            for data, toxic in zip(_lowered(batch.column(0)), batch.column(1).to_pylist()):
                counts[np.unique(buckets(data)), toxic] += 1
        blocks = counts.reshape(-1, BLOCK * 2)
        some = np.flatnonzero(blocks.any(1))
        for at in range(0, len(some), 64):
            part = some[at : at + 64]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([narrow(blocks[b]) for b in part])], ["block", "counts"])

    def narrow(block: np.ndarray) -> bytes:
        """The counts in the fewest bytes that hold the largest."""
        most = block.max()
        return block.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.int32).tobytes()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = counts.as_buffer()
                value = np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.int32}[data.size // (BLOCK * 2)])
                sums[block] = sums[block] + value if block in sums else value.astype(np.int64)
        for block, total in sums.items():
            table = total.reshape(BLOCK, 2)
            some = np.flatnonzero(table.any(1))
            columns = [pa.array(block * BLOCK + some), pa.array(table[some, 1]), pa.array(table[some, 0])]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "toxic", "other"])

    found = training.select("text", "toxic").mapInArrow(run, "block long, counts binary")
    return found.repartition("block").mapInArrow(add, "bucket long, toxic long, other long")


def ratios(counts: DataFrame, toxic: int, other: int) -> DataFrame:
    """(bucket, ratio) of the features that stand out; toxic and other are how many documents of each label there are."""
    p, q = F.col("toxic") + SMOOTHING, F.col("other") + SMOOTHING
    ratio = F.log(p / (toxic + 2 * SMOOTHING)) - F.log(q / (other + 2 * SMOOTHING))
    strength = F.abs(ratio) / F.sqrt(1 / p + 1 / q)
    found = counts.select("bucket", ratio.alias("ratio"), strength.alias("strength")).where(F.col("strength") >= EVIDENCE)
    return found.orderBy(F.desc("strength"), "bucket").limit(FEATURES).select("bucket", "ratio")


@dataclass
class Model:
    """The classifier: for each feature the product of ratio and weight, in the order of ``bucket``, and what it starts from."""

    bucket: np.ndarray
    gain: np.ndarray
    bias: float

    def places(self) -> np.ndarray:
        """For each bucket its place among the features, or -1."""
        out = np.full(1 << BUCKET_BITS, -1, np.int32)
        out[self.bucket] = np.arange(len(self.bucket))
        return out

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.gain[features].sum(), -500, 500))))


def features_of(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The features a text has, each once."""
    found = places[buckets(data)]
    return np.unique(found[found >= 0])


def sample_features(training: DataFrame, bucket: np.ndarray) -> DataFrame:
    """(toxic, features) of the sample: which of the features each of its documents has."""
    mix = F.xxhash64("doc_id", "text").alias("mix")
    chosen = top_per_group(training.select("toxic", mix, "doc_id").distinct(), ["toxic"], ["mix", "doc_id"], SAMPLE).drop("toxic")
    rows = training.withColumn("mix", mix).join(F.broadcast(chosen), ["doc_id", "mix"], "left_semi")  # twice SAMPLE rows
    rows = rows.dropDuplicates(["doc_id", "mix"]).select("text", "toxic")
    held = training.sparkSession.sparkContext.broadcast(bucket)  # at most FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Model(held.value, np.zeros(0), 0.0).places()
        for batch in slices(batches, "text"):
            found = [features_of(data, places) for data in _lowered(batch.column(0))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([f.astype(np.int16) for f in found], pa.list_(pa.int16()))], ["toxic", "features"])

    return rows.mapInArrow(run, "toxic int, features array<short>")


def fit(ratio: np.ndarray, features: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """(gain, bias): weights of a logistic regression on the ratios of the features that occur, times the ratios.

    Accelerated gradient steps of a length that the data suggest, halved where the loss jumps. Without documents of both labels
    all weights are zero and the score is the smoothed share of toxic ones.
    """
    n = len(toxic)
    start = float(np.log((toxic.sum() + SMOOTHING) / (n - toxic.sum() + 2 * SMOOTHING)))
    if not n or not len(ratio) or toxic.all() or not toxic.any():
        return np.zeros(len(ratio)), start
    row = np.repeat(np.arange(n), [len(f) for f in features])
    column = np.concatenate(features)
    value = ratio[column]
    step = 4 / (np.bincount(row, value * value, n).mean() + 1)
    weight, bias = np.zeros(len(ratio)), start
    ahead, ahead_bias, momentum = weight.copy(), bias, 1.0
    last = np.inf
    for _ in range(ROUNDS):
        z = np.bincount(row, value * ahead[column], n) + ahead_bias
        loss = np.logaddexp(0, z).sum() / n - (toxic * z).sum() / n + PENALTY / 2 * (ahead @ ahead)
        if loss > last * 1.5:
            step, ahead, ahead_bias, momentum = step / 2, weight.copy(), bias, 1.0
            continue
        last = min(last, loss)
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - toxic) / n
        slope = np.bincount(column, value * error[row], len(ratio)) + PENALTY * ahead
        following, following_bias = ahead - step * slope, ahead_bias - step * error.sum()
        grown = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = following + (momentum - 1) / grown * (following - weight)
        ahead_bias = following_bias + (momentum - 1) / grown * (following_bias - bias)
        weight, bias, momentum = following, following_bias, grown
    return weight * ratio, float(bias)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier of the labelled documents outside fold 0."""
    training = stored(labelled(docs, labels), "labelled")
    sizes = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    table = ratios(feature_counts(training), sizes.get(1, 0), sizes.get(0, 0)).orderBy("bucket").collect() if len(sizes) == 2 else []
    bucket = np.array([r["bucket"] for r in table], np.int64)
    ratio = np.array([r["ratio"] for r in table], float)
    rows = sample_features(training, bucket).toArrow()
    toxic = rows["toxic"].to_numpy().astype(float)
    features = [f.values.to_numpy().astype(np.int64) for f in rows["features"]]
    gain, bias = fit(ratio, features, toxic)
    if len(sizes) == 2:
        # the sample has other shares of the labels than the corpus
        bias += float(np.log(sizes[1] / sizes[0]) - np.log(toxic.sum() / (len(toxic) - toxic.sum())))
    return Model(bucket, gain, bias)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; only the text is an input of the score."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        places = model.places()
        for batch in slices(batches, "text"):
            found = np.array([model.score(features_of(data, places)) for data in _lowered(batch.column(2))], float)
            columns = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def held_out() -> Column:
    return crc_bucket("doc_id", FOLDS) == 0


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, learning from ``labels`` (doc_id, toxic).

    score is the probability of toxic, predicted 1 from 0.5 on. A null or empty text has the score of no features. held_out is
    whether crc32(doc_id as text) mod 5 is 0, null for a null doc_id. Without labels of both kinds every score is the smoothed
    share of toxic ones among the labels. Repeated rows get a row each; no rows give no rows. Other columns are not read.
    """
    return scored(docs, trained(docs, labels))
