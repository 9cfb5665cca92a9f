"""Byte-level BPE: encoding by corpus-level merge replay, and decoding.

The distinct pre-tokens of a slice of documents that have not been seen before form one corpus. An inverted index leads
from the rank of a token pair to the positions where the pair stands. Merges are applied in rank order over the whole
corpus; each merge visits only the positions of its pair and updates only the pairs on both sides of them.

A merge can create a pair of lower rank than itself when a vocabulary reaches one token in two ways. Such words are
taken out and encoded alone, always by their lowest pair, so that every word comes out as the library gives it.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.pretokens import PreTokens, class_table, ranges
from tradewind.llm.text import Hasher, slices

#: Words whose ids a task keeps; the table is emptied when it is full.
KEPT_WORDS = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 bytes and rank, one per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def lowest_first(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One word's ids: the leftmost pair of the lowest rank is merged until no pair is in the vocabulary."""
    parts = [bytes([b]) for b in word]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def replay(words: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """The ids of every word (not empty), by merges in rank order over all words together."""
    text = b"".join(words)
    size = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(size) - size
    part: list[bytes | None] = [text[i : i + 1] for i in range(len(text))]
    after = list(range(1, len(text) + 1))
    before = list(range(-1, len(text) - 1))
    for b, n in zip(begin.tolist(), size.tolist()):
        before[b] = -1
        after[b + n - 1] = -1
    index: dict[int, list[int]] = {}
    pair_rank = np.full(65536, -1, np.int64)
    for pair, r in ranks.items():
        if len(pair) == 2:
            pair_rank[pair[0] * 256 + pair[1]] = r
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    if len(data) > 1:
        rank = pair_rank[data[:-1] * 256 + data[1:]]
        rank[begin[1:] - 1] = -1
        at = np.flatnonzero(rank >= 0)
        order = at[np.argsort(rank[at], kind="stable")]
        found, first = np.unique(rank[order], return_index=True)
        for r, positions in zip(found.tolist(), np.split(order, first[1:])):
            index[r] = positions.tolist()
    heap = list(index)
    heapq.heapify(heap)
    odd: set[int] = set()
    get = ranks.get
    while heap:
        now = heapq.heappop(heap)
        for i in sorted(index.pop(now)):
            j = after[i]
            left = part[i]
            if left is None or j < 0:
                continue
            whole = left + part[j]
            if get(whole) != now:
                continue
            part[i], part[j] = whole, None
            k = after[j]
            after[i] = k
            if k >= 0:
                before[k] = i
                r = get(whole + part[k])
                if r is not None:
                    if r <= now:
                        odd.add(i)
                    if r in index:
                        index[r].append(i)
                    elif r > now:
                        index[r] = [i]
                        heapq.heappush(heap, r)
            h = before[i]
            if h >= 0:
                r = get(part[h] + whole)
                if r is not None:
                    if r <= now:
                        odd.add(i)
                    if r in index:
                        index[r].append(h)
                    elif r > now:
                        index[r] = [h]
                        heapq.heappush(heap, r)
    out = []
    for b, n in zip(begin.tolist(), size.tolist()):
        out.append([ranks[p] for p in part[b : b + n] if p is not None])
    for word in {int(np.searchsorted(begin, i, side="right")) - 1 for i in odd}:
        out[word] = lowest_first(words[word], ranks)
    return out


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    The ids are those of the whole text without special tokens, whose strings are ordinary text; ids_sha256 is over
    the decimal ids joined by one space, decoded_sha256 over the bytes that the ids decode to. A null or empty text has
    no tokens, and the digests of nothing. Rows are independent: repeated rows and null ids are kept, other
    columns are not read. ``vocabulary`` is the path of a rank file on the driver.
    """
    spark = docs.sparkSession
    ranks_of = spark.sparkContext.broadcast((read_ranks(vocabulary), ranges()))  # one vocabulary: some MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, classes = ranks_of.value
        table, hasher = class_table(classes), Hasher()
        token = {i: b for b, i in ranks.items()}
        known: dict[bytes, tuple[int, str, bytes]] = {}
        for batch in slices(batches):
            found = PreTokens(batch.column(1), table)
            words, number = found.distinct(hasher)
            fresh = [w for w in words if w not in known]
            if len(known) + len(fresh) > KEPT_WORDS:
                known.clear()
                fresh = words
            for w, ids in zip(fresh, replay(fresh, ranks)):
                known[w] = len(ids), " ".join(map(str, ids)), b"".join([token[i] for i in ids])
            entries = [known[w] for w in words]
            texts, parts = [e[1] for e in entries], [e[2] for e in entries]
            sizes = np.array([e[0] for e in entries], np.int64)
            total = np.concatenate(([0], np.cumsum(sizes[number])))
            ids_sha, decoded_sha = [], []
            for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                at = number[a:b].tolist()
                ids_sha.append(sha256(" ".join([texts[i] for i in at]).encode()).hexdigest())
                decoded_sha.append(sha256(b"".join([parts[i] for i in at])).hexdigest())
            counts = total[found.first[1:]] - total[found.first[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
