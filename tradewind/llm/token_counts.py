"""Token counts of byte-level BPE without ids.

1. The distinct pre-tokens of all texts, with how often each occurs.
2. The pieces of each are counted once, by the tokenizer's own library.
3. The pre-token frequencies of each document are joined to the counts and summed up.

Step 3 looks the frequent pre-tokens up in memory (a bounded table) and joins the others.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frequent import Lookup, arrays, at_least, counted, pair_counts
from tradewind.llm.pretokens import PreTokens, class_table, ranges
from tradewind.llm.tables import stored
from tradewind.llm.text import Hasher, slices

MOST_TOKENS = 1024
#: Pre-tokens given to the library in one call.
STEP = 20_000


def special_strings(definition: str) -> list[str]:
    """The strings that the library takes out of a text before all else, each one token."""
    added = json.loads(definition).get("added_tokens", [])
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
        raise ValueError("added tokens that look at what is beside them are not supported")
    return sorted((a["content"] for a in added), key=len, reverse=True)


def without_specials(texts: pa.Array, specials: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(parts, row of each part, specials in each row): the texts cut at the special strings."""
    n = len(texts)
    has = np.zeros(n, bool)
    for s in specials:
        has |= pa.compute.fill_null(pa.compute.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
    number = np.zeros(n, np.int64)
    if not has.any():
        return texts, np.arange(n), number
    cut = re.compile("|".join(map(re.escape, specials)))
    parts, row = [], []
    for i, (text, special) in enumerate(zip(texts.to_pylist(), has.tolist())):
        own = cut.split(text) if special else [text]
        number[i] = len(own) - 1
        parts += own
        row += [i] * len(own)
    return pa.array(parts, pa.string()), np.array(row), number


def distinct_pretokens(docs: DataFrame, specials: list[str]) -> DataFrame:
    """(token, n): the bytes of every distinct pre-token and how often it occurs."""
    classes = docs.sparkSession.sparkContext.broadcast(ranges())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, hasher = class_table(classes.value), Hasher()

        def pieces():
            for batch in slices(batches):
                found = PreTokens(without_specials(batch.column(0), specials)[0], table)
                tokens, number = found.distinct(hasher)
                yield tokens, np.bincount(number, minlength=len(tokens))

        yield from counted(pieces())

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "token binary, n long")
    return rows.groupBy("token").agg(F.sum("n").alias("n"))


def piece_counts(distinct: DataFrame, definition: str) -> DataFrame:
    """(key, n, pieces): hash of the pre-token, its occurrences and its tokens."""
    held = distinct.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library, hasher = Tokenizer.from_str(held.value), Hasher()
        library.no_truncation()
        library.no_padding()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                tokens = part.column(0).to_pylist()
                size = np.array([len(t) for t in tokens], np.int64)
                end = np.cumsum(size)
                key = hasher(np.frombuffer(b"".join(tokens), np.uint8), end - size, end)
                found = library.encode_batch([t.decode() for t in tokens], add_special_tokens=False)
                pieces = pa.array([len(e.ids) for e in found], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column(1), pieces], ["key", "n", "pieces"])

    return distinct.mapInArrow(run, "key long, n long, pieces int")


def per_document(docs: DataFrame, definition: str, most: int = MOST_TOKENS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    n_tokens is what the library gives for the whole text without begin or end tokens; special strings in a text are one
    token each. A null text counts as empty: no bytes, no tokens. Repeated rows and null ids each keep their row; other
    columns are not read. ``definition`` is the content of the tokenizer's file.
    """
    spark = docs.sparkSession
    specials = special_strings(definition)
    pieces = stored(piece_counts(distinct_pretokens(docs, specials), definition), "pretoken-pieces")
    known = spark.sparkContext.broadcast((ranges(), *arrays(at_least(pieces, "n"), "key", "pieces")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, keys, values = known.value
        table, hasher, lookup = class_table(classes), Hasher(), Lookup(keys, values)
        for batch in slices(batches):
            rows = batch.num_rows
            texts, part_row, special = without_specials(batch.column(2), specials)
            found = PreTokens(texts, table)
            row = np.repeat(part_row, np.diff(found.first))
            key = hasher(found.data, found.start, found.end).view(np.int64)
            frequent, count = lookup(key)
            own = special + np.bincount(row, count, rows).astype(np.int64)
            size = pa.compute.fill_null(pa.compute.binary_length(batch.column(2)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), size, pa.array(own), batch.column(0), pa.array(np.zeros(rows, np.int64))],
                ["row", "doc_id", "n_bytes", "counted", "key", "n"],
            )
            rare_row, rare_key, n = pair_counts(row[~frequent], key[~frequent])
            at, zero = pa.array(rare_row), pa.array(np.zeros(len(n), np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.nulls(len(n), pa.int64()), zero, zero, pa.array(rare_key), pa.array(n)],
                ["row", "doc_id", "n_bytes", "counted", "key", "n"],
            )

    # a row for each document with what is counted already (its key is its number, to spread them) and one for each rare pre-token
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = source.mapInArrow(run, "row long, doc_id long, n_bytes long, counted long, key long, n long")
    joined = rows.join(pieces.select("key", "pieces"), "key", "left")
    total = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_bytes").alias("n_bytes"),
        F.sum(F.col("counted") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("n_tokens"),
    )
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > most).alias("over_limit"))
