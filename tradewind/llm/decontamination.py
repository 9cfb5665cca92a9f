"""Benchmark decontamination with SimHash windows.

A window of a document is as many words as a benchmark item has. Windows and items get a SimHash of their weighted
five-word shingles. The fingerprints of the items of one length lie in a multi-index: the 64 bits are cut into
``RADIUS`` + 1 blocks, so any fingerprint within the radius agrees with the window's in one whole block at least and is
found. Found pairs within the radius are verified by the exact weighted similarity of their shingles.

The weight of a shingle falls with the number of items that have it. A window can only reach the similarity if the shingles
that occur in some item make up that share of its weight; windows below are left out before they are fingerprinted. That
bound is exact, so it loses nothing, and it spares nearly all of the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import Hasher, Words, gram_starts, grams, slices

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
#: Bytes of benchmark text that travel to the executors at once; a larger benchmark is taken in parts of this size.
PART_BYTES = 16 << 20
#: Windows fingerprinted in one numpy step.
STEP = 4096


def simhash(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of shingle hashes with their weights."""
    n, m = hashes.shape
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(n, m, 8), axis=2)
    lean = np.einsum("nmb,nm->nb", bits.astype(np.float32), weights.astype(np.float32))
    above = 2 * lean > weights.sum(1, dtype=np.float32)[:, None]
    return np.packbits(above, axis=1).view(">u8").reshape(n).astype(np.uint64)


class Benchmark:
    """Items by length, with their shingles, weights and fingerprints in a multi-index."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS):
        self.radius = radius
        words = Words(pa.array([text for _, text in items], pa.string()), lower=True)
        hashes = Hasher()(words.data, words.start, words.end)
        by_item = []
        seen: Counter = Counter()
        for i in range(len(items)):
            own = hashes[words.first[i] : words.first[i + 1]]
            shingles = grams(own, min(SHINGLE, len(own))) if len(own) else own
            by_item.append(shingles)
            seen.update(set(shingles.tolist()))
        self.most = float(np.log1p(len(items)))
        self.known = np.array(sorted(seen), np.uint64)
        self.weight = np.array([np.log1p(len(items) / seen[int(s)]) for s in self.known])
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.lengths: dict[int, list[int]] = {}
        for i, n in enumerate(words.count.tolist()):
            if n:
                self.lengths.setdefault(n, []).append(i)
        self.ids = [item for item, _ in items]
        self.shingles = [Counter(s.tolist()) for s in by_item]
        self.prints = np.zeros(len(items), np.uint64)
        cuts = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << int(b - a)) - 1)) for a, b in zip(cuts, cuts[1:])]
        self.tables: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for n, own in self.lengths.items():
            rows = np.stack([by_item[i] for i in own])
            self.prints[own] = simhash(rows, self.weights(rows))
            self.tables[n] = []
            for shift, mask in self.blocks:
                key = (self.prints[own] >> shift) & mask
                order = np.argsort(key, kind="stable")
                self.tables[n].append((key[order], np.array(own)[order]))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each shingle among the known ones, -1 for others."""
        number = np.full(len(hashes), -1, np.int64)
        if len(self.known):
            at = np.flatnonzero(self.filter[(hashes >> np.uint64(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
            number[at] = np.where(self.known[place] == hashes[at], place, -1)
        return number

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        number = self.find(hashes.ravel())
        return np.where(number >= 0, self.weight[number], self.most).reshape(hashes.shape)

    def near(self, n: int, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) for every fingerprint of an item of n words within the radius."""
        pairs = []
        for (shift, mask), (key, item) in zip(self.blocks, self.tables[n]):
            own = (prints >> shift) & mask
            low, high = np.searchsorted(key, own), np.searchsorted(key, own, side="right")
            count = high - low
            window = np.repeat(np.arange(len(prints)), count)
            within = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
            pairs.append(np.stack([window, item[np.repeat(low, count) + within]]))
        window, item = np.unique(np.concatenate(pairs, axis=1), axis=1)
        keep = np.bitwise_count(prints[window] ^ self.prints[item]) <= self.radius
        return zip(window[keep].tolist(), item[keep].tolist())

    def similarity(self, shingles: np.ndarray, weights: np.ndarray, item: int) -> float:
        """Shared weight over united weight, repeated shingles counted as often as they occur."""
        mine, other = Counter(shingles.tolist()), self.shingles[item]
        weight = dict(zip(shingles.tolist(), weights.tolist()))
        shared = sum(weight[s] * min(c, other[s]) for s, c in mine.items() if s in other)
        total = sum(weight[s] * c for s, c in mine.items())
        united = total + sum(self.weight[self.place(s)] * c for s, c in other.items()) - shared
        return shared / united

    def place(self, shingle: int) -> int:
        return int(np.searchsorted(self.known, np.uint64(shingle)))


def matches(texts: pa.Array, bench: Benchmark, hasher: Hasher, least: float) -> dict[tuple[int, int], tuple[float, int]]:
    """(row, item number) -> (similarity, first word) of the most similar window, the first on ties."""
    words = Words(texts, lower=True)
    hashes = hasher(words.data, words.start, words.end)
    best: dict[tuple[int, int], tuple[float, int]] = {}
    last = words.first[1:]
    for width in sorted({min(SHINGLE, n) for n in bench.lengths}):
        shingles = grams(hashes, width)
        number = bench.find(shingles)
        number[~gram_starts(words.first, width, len(hashes))] = -1
        known = np.flatnonzero(number >= 0)
        if not len(known):
            continue
        lengths = [n for n in sorted(bench.lengths) if min(SHINGLE, n) == width]
        reach = np.zeros(len(shingles) + 1, np.int64)
        np.add.at(reach, np.maximum(known - (lengths[-1] - width), 0), 1)
        np.add.at(reach, known + 1, -1)
        starts = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
        row = np.searchsorted(words.first, starts, side="right") - 1
        weight = np.where(number >= 0, bench.weight[number], bench.most)
        total = np.concatenate(([0.0], np.cumsum(weight)))
        inside = np.concatenate(([0.0], np.cumsum(np.where(number >= 0, weight, 0.0))))
        for n in lengths:
            m = n - width + 1
            fits = starts + n <= last[row]
            s, r = starts[fits], row[fits]
            enough = inside[s + m] - inside[s] >= (least - 1e-9) * (total[s + m] - total[s])
            s, r = s[enough], r[enough]
            for a in range(0, len(s), STEP):
                at = s[a : a + STEP, None] + np.arange(m)
                own, heavy = shingles[at], weight[at]
                for window, item in bench.near(n, simhash(own, heavy)):
                    value = bench.similarity(own[window], heavy[window], item)
                    if value >= least:
                        key = int(r[a + window]), item
                        found = value, int(s[a + window] - words.first[key[0]])
                        if key not in best or (-found[0], found[1]) < (-best[key][0], best[key][1]):
                            best[key] = found
    return best


def _parts(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in lists of at most about PART_BYTES of text, in order of their ids."""
    part, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    for row in rows.orderBy("item_id", "text").toLocalIterator():  # one part at a time
        part.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size > PART_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, item_id, similarity, start_word, n_words): each document and item that it holds.

    One row for a document's best window of each item, the first on ties. Letters A-Z count as lower case. Items without
    words match nothing; an item of fewer than five words has one shingle, all of it. A null text has no windows. Rows
    are judged on their own: repeated rows repeat their matches, a null doc_id is kept. An empty benchmark gives no rows.
    text_key is Spark's hash of the text, to tell apart rows that repeat a doc_id.
    """
    schema = "doc_id long, text_key long, item_id long, similarity double, start_word long, n_words long"
    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))
    result = None
    for part in _parts(benchmark):
        items = docs.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            bench, hasher = Benchmark(items.value), Hasher()
            size = {i: n for n, own in bench.lengths.items() for i in own}
            for batch in slices(batches):
                found = matches(batch.column(2), bench, hasher, similarity)
                if found:
                    rows = pa.array([row for row, _ in found], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array([bench.ids[i] for _, i in found], pa.int64()),
                            pa.array([v for v, _ in found.values()], pa.float64()),
                            pa.array([s for _, s in found.values()], pa.int64()),
                            pa.array([size[i] for _, i in found], pa.int64()),
                        ],
                        ["doc_id", "text_key", "item_id", "similarity", "start_word", "n_words"],
                    )

        rows = own.mapInArrow(run, schema)
        result = rows if result is None else result.union(rows)
    return docs.sparkSession.createDataFrame([], schema) if result is None else result


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    found = contaminated(docs, benchmark, similarity).select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__text")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__text"))
    return docs.join(found, same, "left_anti")
