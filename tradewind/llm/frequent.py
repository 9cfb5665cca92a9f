"""Tables keyed by token: the frequent part travels to the tasks, the rest is joined.

The distinct tokens of a corpus have no bound, but few of them make up most of it. The tokens from some count on, at most
``limit`` of them, are looked up in memory; rows go through a shuffle only for the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 250_000
#: Keys with equal first bits that a lookup steps over one by one.
STEPS = 32


def at_least(table: DataFrame, count: str, limit: int = LIMIT) -> DataFrame:
    """The rows whose count reaches the lowest threshold (in steps of a quarter of a power of two) with at most ``limit`` rows."""
    step = F.floor(F.log2(F.col(count).cast("double")) * 4).cast("long")
    # one row per step: at most 4 * 63
    sizes = {row["step"]: row["n"] for row in table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, lowest = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > limit:
            break
        lowest = at
    if lowest is None:
        return table.where(F.lit(False))
    return table.where(step >= lowest)


def arrays(table: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    """A bounded table as two arrays in the order of the key, for ``Lookup``."""
    found = table.select(key, value).toArrow()
    keys = found[key].to_numpy().astype(np.int64)
    order = np.argsort(keys)
    return keys[order], found[value].to_numpy()[order]


class Lookup:
    """Values by 64-bit key, sorted by it; what is not there has no value.

    Keys are hashes: their first bits tell the place but for few steps. Where they do not, the place is searched for.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(8, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        ends = np.cumsum(np.bincount(self._head(keys), minlength=1 << bits))
        self.start = np.concatenate(([0], ends[:-1])).astype(np.int32)
        self.steps = int(np.diff(ends, prepend=0).max())

    def _head(self, keys: np.ndarray) -> np.ndarray:
        """The first bits, in the order of signed keys."""
        return ((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).view(np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        """How many keys are less than each."""
        if self.steps > STEPS:
            return np.searchsorted(self.keys, keys)
        place = self.start.take(self._head(keys))
        # most are there after the first look
        left = np.flatnonzero((self.keys.take(place, mode="clip") < keys) & (place < len(self.keys)))
        for _ in range(self.steps):
            if not len(left):
                break
            place[left] += 1
            at = place.take(left)
            left = left[(at < len(self.keys)) & (self.keys.take(at, mode="clip") < keys.take(left))]
        return place

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value) of each key; the value of missing ones is 0."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), self.values.dtype)
        place = np.minimum(self._place(keys), len(self.keys) - 1)
        found = self.keys.take(place) == keys
        return found, np.where(found, self.values.take(place), 0)


def pair_counts(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs and how often each occurs."""
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    at = np.flatnonzero(new)
    return row[at], key[at], np.diff(np.append(at, len(row)))


def counted(pieces: Iterator[tuple[list, np.ndarray]], most: int = 200_000, kind: pa.DataType = pa.binary()) -> Iterator[pa.RecordBatch]:
    """(token, n) batches from (tokens, counts) of many slices; counts of a token are added up within some slices."""
    held: dict = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), kind), pa.array(list(held.values()), pa.int64())], ["token", "n"]
        )

    for tokens, counts in pieces:
        get = held.get
        for token, n in zip(tokens, counts.tolist()):
            held[token] = get(token, 0) + n
        if len(held) > most:
            yield out()
            held.clear()
    if held:
        yield out()
