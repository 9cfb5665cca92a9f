"""Words, hashes and bounded batches: numpy helpers for functions that run inside tasks.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
A null text has no words. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step looks at; a longer single text is one step of its own.
STEP_BYTES = 2 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def crc_bucket(column: str, n: int):
    """crc32 of the value as text, modulo n (null for null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing step of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def keys(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mixed(base) | np.uint64(1)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; every batch has at least one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        edges = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = int(edges[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(edges, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """The words of a batch of texts as flat arrays.

    ``data`` holds the bytes of all texts, ``offset`` where each text begins; ``start`` and ``end`` hold
    the bytes of each word, ``first`` the number of the first word of each text (one more at the end).
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pa.compute.fill_null(texts.cast(pa.large_binary()), b"")
        _, offsets, values = texts.buffers()
        offset = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        self.data = data[offset[0] : offset[-1]]
        self.offset = offset - offset[0]
        if lower:
            # numbers of a byte turn over: A to Z are those below 26
            self.data = self.data + (((self.data - np.uint8(65)) < 26).view(np.uint8) << 5)
        solid = (self.data != 32) & ((self.data - np.uint8(9)) > 4)
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offset] = True
        before = np.concatenate(([False], solid[:-1])) if len(solid) else solid
        after = np.concatenate((solid[1:], [False])) if len(solid) else solid
        self.start = np.flatnonzero(solid & (~before | edge[:-1]))
        self.end = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.offset)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def row(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


class Hasher:
    """64-bit hashes of stretches of bytes from one running sum; powers and the room for the sum are kept between calls."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.table = keys(256, 77)
        self.power = self.inverse = self.part = self.total = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(data)
        if n >= len(self.power):
            size = max(n + 1, STEP_BYTES)
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))
            self.part, self.total = np.zeros(size, np.uint64), np.zeros(size + 1, np.uint64)
        part, total = self.part[:n], self.total[: n + 1]
        np.multiply(self.table.take(data, out=part, mode="clip"), self.power[:n], out=part)
        np.cumsum(part, out=total[1:])
        return mixed((total[end] - total[start]) * self.inverse[start])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n neighbours, whatever text they belong to; one per start."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k, key in enumerate(keys(n, 4211)):
        out += hashes[k : len(hashes) - n + 1 + k] * key
    return mixed(out)


def gram_starts(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the stretches of n neighbours lie within one text."""
    inside = np.ones(max(0, total - n + 1), bool)
    for back in range(1, n):
        at = first[1:-1] - back
        at = at[(at >= 0) & (at < len(inside))]
        inside[at] = False
    return inside
