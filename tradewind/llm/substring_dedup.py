"""Substring dedup: windows of 50 words that another document has too are removed from all but the first.

1. Every window has a key, the least hash of the 12-word grams in it, so equal windows have equal keys. Neighbouring windows
   with one key form a piece. Pieces whose key occurs in one document only are done: none of their windows repeats.
2. The other pieces are cut out of the texts. Equal pieces become one, with the least doc_id that has it.
3. Pieces are dealt to shards by key, so that equal windows meet in one shard, and the number of shards grows with the
   text. Each shard builds a compressed FM-index of its pieces and streams the pieces through it; the matching
   statistics give for each window the least doc_id that has it.
4. Every document drops the words of the windows whose least doc_id is smaller than its own.

A key with very many different pieces (a passage that stands in very many contexts) is dealt window by window, each by
its own hash, so that it spreads over the shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.fm_index import FMIndex
from tradewind.llm.tables import stored
from tradewind.llm.text import Hasher, Words, gram_starts, grams, slices

WINDOW = 50
GRAM = 12
#: Windows in a piece at most.
PIECE = 64
#: Different pieces of one key from which on its windows are dealt one by one.
HOT = 2000
#: Bytes of text in a shard.
SHARD_BYTES = 3 << 20


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if width > have else out


def pieces_of(words: Words, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word within it, windows, key) of every piece of a batch."""
    none = np.zeros(0, np.int64)
    if len(words) < WINDOW:
        return none, none, none, none
    key = _least(grams(hasher(words.data, words.start, words.end), GRAM), WINDOW - GRAM + 1)
    at = np.flatnonzero(gram_starts(words.first, WINDOW, len(words)))
    if not len(at):
        return none, none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (key[at[1:]] != key[at[:-1]])
    begin = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    begin = np.flatnonzero(within % PIECE == 0)
    windows = np.diff(np.append(begin, len(at)))
    row = np.searchsorted(words.first, at[begin], side="right") - 1
    return row, at[begin] - words.first[row], windows, key[at[begin]].view(np.int64)


def pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, windows, key) of every piece of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches):
            row, start, windows, key = pieces_of(Words(batch.column(2)), hasher)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(start, pa.int32()), pa.array(windows, pa.int32()), pa.array(key)],
                ["doc_id", "text_key", "start", "windows", "key"],
            )

    return docs.mapInArrow(run, "doc_id long, text_key long, start int, windows int, key long")


def _cut(texts: DataFrame) -> DataFrame:
    """The pieces with their words, joined by one space, from texts with lists of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            for doc, text_key, text, listed in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode().split()
                for p in listed:
                    end = p["start"] + p["windows"] + WINDOW - 1
                    out.append((doc, text_key, p["start"], p["key"], b" ".join(words[p["start"] : end])))
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text_key", "start", "key", "words"]
            )

    return texts.select("doc_id", "text_key", "text", "pieces").mapInArrow(
        run, "doc_id long, text_key long, start int, key long, words binary"
    )


def _single_windows(distinct: DataFrame) -> DataFrame:
    """(key, words_key, offset, window, doc_id): every window of a piece for itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            out: list[tuple] = []
            for key, words_key, words, doc in zip(*(c.to_pylist() for c in batch.columns)):
                own = words.split(b" ")
                out += [(key, words_key, i, b" ".join(own[i : i + WINDOW]), doc) for i in range(len(own) - WINDOW + 1)]
            columns = list(zip(*out)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "words_key", "offset", "window", "doc_id"]
            )

    return distinct.select("key", "words_key", "words", "doc_id").mapInArrow(
        run, "key long, words_key long, offset int, window binary, doc_id long"
    )


def search(table: pa.Table) -> pa.Table:
    """One shard: (key, words_key, least), the least doc_id of each window of each piece."""
    contents = table["words"].combine_chunks()
    words = Words(contents)
    _, number = np.unique(Hasher()(words.data, words.start, words.end), return_inverse=True)
    begin = words.first[:-1] + np.arange(len(words.count))
    text = np.zeros(len(words) + len(words.count), np.int64)
    inside = np.ones(len(text), bool)
    inside[begin + words.count] = False
    text[inside] = number + 1
    owner = np.repeat(table["doc_id"].to_numpy(), words.count + 1)
    found = FMIndex(text, owner, WINDOW).least_owners(text, begin, words.count)
    edges = np.concatenate(([0], np.cumsum(np.maximum(words.count - WINDOW + 1, 0))))
    least = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(found))
    return pa.table({"key": table["key"], "words_key": table["words_key"], "least": least})


def _in_shards(distinct: DataFrame) -> DataFrame:
    """The least doc_ids of the windows of distinct pieces (key, words_key, words, doc_id), shard by shard."""
    size = distinct.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = int(size) // SHARD_BYTES + 1
    dealt = distinct.withColumn("shard", F.pmod(F.hash("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(search, "key long, words_key long, least array<long>")


def repeated_windows(cut: DataFrame) -> DataFrame:
    """(key, words_key, least): for each different piece the least doc_id of each of its windows."""
    distinct = cut.groupBy("key", "words").agg(F.min("doc_id").alias("doc_id"))
    distinct = stored(distinct.withColumn("words_key", F.xxhash64("words")), "pieces-distinct")
    crowded = distinct.groupBy("key").count().where(F.col("count") > HOT).select("key")
    few = distinct.join(crowded, "key", "left_anti")
    single = _single_windows(distinct.join(crowded, "key", "left_semi"))
    single = stored(single.withColumn("window_key", F.xxhash64("window")), "pieces-single")
    alone = single.groupBy(F.col("window_key").alias("key"), F.col("window").alias("words")).agg(F.min("doc_id").alias("doc_id"))
    alone = alone.withColumn("words_key", F.lit(-1).cast("long"))
    columns = ["key", "words_key", "words", "doc_id"]
    shards = stored(few.select(columns).union(alone.select(columns)), "pieces-dealt")
    found = stored(_in_shards(shards), "pieces-found")
    by_window = found.where("words_key = -1").select(F.col("key").alias("window_key"), F.col("least")[0].alias("one"))
    again = (
        single.select("key", "words_key", "offset", "window_key")
        .join(by_window, "window_key")
        .groupBy("key", "words_key")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("offset", "one"))), lambda s: s["one"]).alias("least"))
    )
    return found.where("words_key <> -1").union(again)


def _digest(words: list[bytes]) -> str:
    return sha256(b" ".join(words)).hexdigest()


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``.

    A word goes if a window of ``WINDOW`` words that covers it also starts in a row with a smaller doc_id; windows are judged
    on the input. Texts under 50 words, and null texts (no words), stay as they are. Rows with the same doc_id do not
    count for each other; a row without a doc_id neither loses words nor takes any. Repeated rows each get a row.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            split = [(t or "").encode().split() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(w) for w in split], pa.int64()), pa.array([_digest(w) for w in split])],
                ["doc_id", "text_key", "n_words", "whole_sha256"],
            )

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            removed, digest = [], []
            for text, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                for g in gone:
                    change[g["start"]] += 1
                    change[g["end"]] -= 1
                keep = np.cumsum(change)[:-1] == 0
                removed.append(len(words) - int(keep.sum()))
                digest.append(_digest([w for w, k in zip(words, keep.tolist()) if k]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digest)],
                ["doc_id", "text_key", "n_removed", "kept_sha256"],
            )

    cut_out = pieces(own.where("doc_id is not null"))
    repeated = cut_out.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key")
    listed = cut_out.join(repeated, "key", "left_semi").groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("start", "windows", "key")).alias("pieces")
    )
    texts = stored(own.join(listed, ["doc_id", "text_key"]).distinct(), "texts-with-repeats")
    cut = _cut(texts)
    found = repeated_windows(cut)
    mine = cut.select("doc_id", "text_key", "start", "key", F.xxhash64("words").alias("words_key")).join(found, ["key", "words_key"])
    # runs of windows that an earlier document has: from the first word of the first to the last word of the last
    at = F.posexplode(F.transform("least", lambda x: x < F.col("doc_id")))
    hits = mine.where(F.exists("least", lambda x: x < F.col("doc_id"))).select("doc_id", "text_key", "start", at.alias("i", "hit")).where("hit")
    gone = hits.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct((F.col("start") + F.col("i")).alias("start"), (F.col("start") + F.col("i") + WINDOW).alias("end"))).alias("gone")
    )
    short = texts.select("doc_id", "text_key", "text").join(gone, ["doc_id", "text_key"]).mapInArrow(
        shortened, "doc_id long, text_key long, n_removed long, kept_sha256 string"
    )
    short = short.withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_text"})
    every = own.mapInArrow(whole, "doc_id long, text_key long, n_words long, whole_sha256 string")
    return every.join(short, (F.col("doc_id") == F.col("of_doc")) & (F.col("text_key") == F.col("of_text")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
