"""SimHash near-dedup with pivot distance tables.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints that differ in at most two bits are
linked, and documents are grouped by the links.

How pairs meet: the fingerprint is cut into four blocks of 16 bits. Two fingerprints within two bits agree in two whole
blocks at least, so a row for each of the six pairs of blocks lets every such pair meet, with 32 bits in common. The
pivot table holds the Hamming distances of each fingerprint to fixed reference fingerprints; the distances of a
pair within two bits differ by at most two in every coordinate, so a pair whose largest coordinate difference is above
that is discarded, and the survivors are verified bit by bit.

A bucket of more than ``DENSE`` fingerprints (many near copies of one text) would form pairs with the square of its
size. Its fingerprints meet at midpoints instead: each is written under itself and under every flip of one bit
outside the common blocks. Two fingerprints share such a point exactly when they differ in at most two bits, and a point
has at most 33 fingerprints, which are linked in a star. So nothing is capped and nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import components
from tradewind.llm.tables import stored
from tradewind.llm.text import keys

RADIUS = 2
BLOCK = 16
PIVOTS = 12
#: Fingerprints in a bucket from which on it is searched by midpoints.
DENSE = 64


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a long. A null text has no words and fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_digest
        for batch in batches:
            out = []
            for text in batch.column(1).cast(pa.large_binary()):
                words = (text.as_py() or b"").lower().split()
                if not words:
                    out.append(0)
                    continue
                parts = zip(*(words[i:] for i in range(min(shingle, len(words)))))
                hashes = np.frombuffer(b"".join([digest(b" ".join(part), seed) for part in parts]), np.uint8).reshape(-1, 8)
                ones = np.unpackbits(hashes, axis=1).sum(0, dtype=np.int64)
                out.append(int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], ["doc_id", "fp"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(run, "doc_id long, fp long")


def _pivots() -> list[int]:
    return [int(np.int64(p)) for p in keys(PIVOTS, 20).view(np.int64)]


def _table(fp: Column) -> Column:
    """Distances to the reference fingerprints."""
    return F.array(*(F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("byte") for p in _pivots()))


def _far(a: Column, b: Column) -> Column:
    """Whether the largest difference between two rows of the pivot table is above the radius."""
    return F.greatest(*(F.abs(a[i] - b[i]) for i in range(PIVOTS))) > RADIUS


def _buckets(fps: DataFrame) -> DataFrame:
    """(bucket, fp, pivots, node): six rows per fingerprint, one for each pair of blocks."""
    block = [F.shiftrightunsigned("fp", BLOCK * i).bitwiseAND(F.lit((1 << BLOCK) - 1)) for i in range(4)]
    rows = [
        F.shiftleft(F.lit(4 * i + j) + 16 * F.col("turn").cast("long"), 32).bitwiseOR(F.shiftleft(block[i], BLOCK)).bitwiseOR(block[j])
        for i in range(4)
        for j in range(i)
    ]
    return fps.select("fp", "node", _table(F.col("fp")).alias("pivots"), F.explode(F.array(*rows)).alias("bucket"))


def _free_flips(bucket: Column, fp: Column) -> Column:
    """The fingerprint and its flips of one bit outside the two blocks that name the bucket."""
    which = F.shiftright(bucket, 32).bitwiseAND(F.lit(15))
    sets = None
    for i in range(4):
        for j in range(i):
            bits = [b for b in range(64) if b // BLOCK not in (i, j)]
            masks = [0] + [(1 << b) - (1 << 64 if b == 63 else 0) for b in bits]
            flips = F.array(*(fp.bitwiseXOR(F.lit(m).cast("long")) for m in masks))
            sets = F.when(which == 4 * i + j, flips) if sets is None else sets.when(which == 4 * i + j, flips)
    return sets


def links(fps: DataFrame, dense: int = DENSE) -> DataFrame:
    """(a, b): nodes whose fingerprints of one turn are within the radius, directly or over a third within it of both.

    ``fps`` has rows (turn, fp, node) with distinct (turn, fp). In buckets that are not dense the pairs are complete; in
    dense ones each midpoint gives a star around its least fingerprint, so the components are the same.
    """
    rows = _buckets(fps)
    crowded = rows.groupBy("bucket").count().where(F.col("count") > dense).select("bucket")
    few = rows.join(crowded, "bucket", "left_anti")
    x, y = few.alias("x"), few.alias("y")
    near = (
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.fp") < F.col("y.fp"))
        & ~_far(F.col("x.pivots"), F.col("y.pivots"))
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= RADIUS)
    )
    pairs = x.join(y, near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    many = rows.join(crowded, "bucket", "left_semi").select("bucket", "fp", "node")
    points = many.select("bucket", "node", F.explode(_free_flips(F.col("bucket"), F.col("fp"))).alias("point"))
    stars = points.groupBy("bucket", "point").agg(F.collect_set("node").alias("nodes")).where(F.size("nodes") > 1)
    hub = stars.select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b")).where("a <> b")
    return pairs.union(hub).distinct()


def grouped(docs: DataFrame, shingle: int = 3, seed: int = 42, dense: int = DENSE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the least doc_id that is reachable over links of at most two bits, the row's own included. Rows
    with the same fingerprint are linked, among them all texts without words (fingerprint zero). A repeated doc_id
    gives a row for each; a null doc_id is kept and never is the least, unless a component has no other. Empty input
    gives no rows; other columns are not read.
    """
    prints = stored(fingerprints(docs, shingle, seed), "fingerprints")
    first = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    nodes = first.select(F.lit(0).alias("turn"), "fp", F.col("fp").alias("node"))
    groups = components(links(nodes, dense), "a", "b")
    named = first.join(groups, first.fp == groups.vertex, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = named.join(least, "component").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(by_print, "fp").select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without all but one document of each group: the one with the least doc_id stays.

    Rows that repeat a doc_id are one document: they stay if one of them is the least of its group, so no text is lost
    with a copy of another. Rows without a doc_id stay. No rows give no rows.
    """
    rows = grouped(docs.where("doc_id is not null"), **options)
    gone = rows.groupBy("doc_id").agg(F.max("component_id").alias("best")).where("best < doc_id").select(F.col("doc_id").alias("__copy"))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__copy"), "left_anti")
