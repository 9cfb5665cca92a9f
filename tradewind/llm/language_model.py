"""A hashed maximum-entropy language model, and the unigram base it is held against.

The next token is predicted from features of the tokens before it: the last one, the last two together, and the one
before the last alone (a skip). The softmax is factored by classes: the most frequent tokens are dealt to classes by rank, as many
to a class as there are classes, all others form one last class. P(token) = P(class) * P(token in class); within the last class
tokens have their smoothed share of the counts, so every text has a probability.

Features index hashed rows of weights. Training is ``ROUNDS`` passes over all training documents. In a round every
task goes over its documents in small batches with AdaGrad steps from the current weights; the changes of all tasks are averaged, weighed by tokens, in a shuffle by block of rows; the next round starts
there.

The model grows with the corpus: the number of classes with the fourth root of its tokens, so the tokens of the softmax and the rows of
weights with the square root. At 5 billion tokens that is 88 classes, 7,656 tokens and 2 x 262,144 rows, some 180 MB.

Counts cover all training documents. What a task cannot look up in the bounded table of frequent tokens is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.frequent import Lookup, arrays, at_least, counted, pair_counts
from tradewind.llm.tables import stored
from tradewind.llm.text import Hasher, Words, crc_bucket, mixed, slices

FOLDS, HELD_OUT = 7, 2
#: Classes for each fourth root of a token, and rows of weights for each square root; at least so many of both.
CLASSES_PER_ROOT, LEAST_CLASSES = 1 / 3, 16
ROWS_PER_ROOT, LEAST_ROWS = 4, 1 << 12
BLOCK = 256
ROUNDS = 2
STEP = 0.15
#: Tokens in one gradient step.
BATCH = 8192
#: Gradients of fewer than so many equal rows of a step are added row by row for all at once, longer ones each for itself.
LIGHT = 8
#: Counts of so many of the most frequent tokens are looked up in every task; those of others are joined.
FREQUENT = 1_000_000
END = np.uint64(0xD1B54A32D192ED03)


def tokens(texts: pa.Array, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, Words]:
    """(hash of each token, first token of each text, words): the words in lower case and an end after each text."""
    words = Words(texts, lower=True)
    first = words.first + np.arange(len(words.first))
    out = np.full(first[-1], END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[first[1:] - 1] = False
    out[inside] = hasher(words.data, words.start, words.end)
    return out, first, words


def word_counts(docs: DataFrame) -> DataFrame:
    """(key, n): hash of every distinct word of ``docs`` and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()

        def pieces():
            for batch in slices(batches):
                words = Words(batch.column(0), lower=True)
                key = hasher(words.data, words.start, words.end).view(np.int64)
                yield np.unique(key, return_counts=True)

        for batch in counted(((k.tolist(), n) for k, n in pieces()), kind=pa.int64()):
            yield batch

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "token long, n long")
    return rows.groupBy(F.col("token").alias("key")).agg(F.sum("n").alias("n"))


def sizes(tokens: int) -> tuple[int, int]:
    """(classes, rows of weights of each table) for a corpus of so many tokens; rows are a power of two."""
    classes = max(LEAST_CLASSES, round(tokens**0.25 * CLASSES_PER_ROOT))
    rows = LEAST_ROWS
    while rows < ROWS_PER_ROOT * tokens**0.5 / 2**0.5:
        rows *= 2
    return classes, rows


@dataclass
class Model:
    """Everything a task needs to score; its size is that of ``sizes``."""

    keys: np.ndarray  # hashes of the vocabulary, sorted
    place: np.ndarray  # class * width + position of each
    bias: np.ndarray  # log share of each class, and of each place within its class
    others: float  # log of the smoothed total of the last class
    class_rows: np.ndarray
    token_rows: np.ndarray

    @property
    def width(self) -> int:
        """Classes, and places in each of them."""
        return self.bias.shape[1]

    @property
    def outside(self) -> int:
        """The place of every token that is not in the vocabulary: the last class."""
        return (self.width - 1) * self.width

    def places(self, token: np.ndarray) -> np.ndarray:
        found, place = Lookup(self.keys, self.place)(token.view(np.int64))
        return np.where(found, place, self.outside)


def features(token: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Hashes of the features of each token's context: the last token, the last two, the one before the last."""
    back1, back2 = np.zeros(len(token), np.uint64), np.zeros(len(token), np.uint64)
    back1[1:], back2[2:] = token[:-1], token[:-2]
    starts = first[:-1]
    back1[starts] = 0
    back2[starts] = 0
    second = starts[np.diff(first) > 1] + 1
    back2[second] = 0
    return [
        mixed(back1 + np.uint64(0x1111)),
        mixed(back1 * np.uint64(0x9E3779B97F4A7C15) + mixed(back2 + np.uint64(0x2222))),
        mixed(back2 + np.uint64(0x3333)),
    ]


def exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(exponentials of rows of scores, their sums, logs of the sums of the scores as given).

    The largest score is taken off only in rows whose sum would leave the range of the numbers.
    """
    with np.errstate(over="ignore"):
        p = np.exp(x)
    total = p @ np.ones(x.shape[1], x.dtype)
    far = np.flatnonzero(~((total > 1e-20) & (total < 1e20)))
    if not len(far):
        return p, total, np.log(total)
    most = x[far].max(1)
    p[far] = np.exp(x[far] - most[:, None])
    total[far] = p[far].sum(1)
    log = np.log(total)
    log[far] += most
    return p, total, log


def _rows(feature: np.ndarray, n: int) -> np.ndarray:
    return (feature >> np.uint64(40)).astype(np.int64) & (n - 1)


def logits(model: Model, found: list[np.ndarray], place: np.ndarray) -> tuple:
    """Scores of the classes for each token, and of the places for tokens of the vocabulary, with their rows."""
    kind = place // model.width
    class_at = [_rows(f, len(model.class_rows)) for f in found]
    score = model.class_rows.take(class_at[0], axis=0)
    score += model.bias[0]
    for rows in class_at[1:]:
        score += model.class_rows.take(rows, axis=0)
    known = np.flatnonzero(kind != model.width - 1)
    own = kind.take(known)
    turn = own.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    token_at = [_rows(mixed(f.take(known) + turn), len(model.token_rows)) for f in found]
    within = model.bias.take(1 + own, axis=0)
    for rows in token_at:
        within += model.token_rows.take(rows, axis=0)
    return score, class_at, kind, known, within, token_at


def log_probability(model: Model, token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(natural log probability but for the share within the last class, whether the token is in the last class)."""
    place = model.places(token)
    found = features(token, first)
    out = np.zeros(len(token))
    for a in range(0, len(token), BATCH):
        part = slice(a, a + BATCH)
        score, _, kind, known, within, _ = logits(model, [f[part] for f in found], place[part])
        value = (score[np.arange(len(kind)), kind] - exponentials(score)[2]).astype(float)
        value[known] += within[np.arange(len(known)), place[part][known] % model.width] - exponentials(within)[2]
        out[part] = value
    return out, place == model.outside


def _sorted(rows: np.ndarray, most: int) -> np.ndarray:
    """The order that sorts row numbers below ``most``; a stable sort of numbers of 16 bits is a radix sort."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    for shift in range(16, (most - 1).bit_length(), 16):
        order = order.take(np.argsort((rows >> shift).astype(np.uint16).take(order), kind="stable"))
    return order


def _added(values: np.ndarray, rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct numbers of ``rows``, all below ``most``; sums of the rows of ``values`` that have each)."""
    order = _sorted(rows, most)
    ordered = rows.take(order)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(np.append(first, len(order)))
    # those with most rows first, so the k-th rows of all that have so many are added to the head of the sums
    by_count = np.argsort((LIGHT - np.minimum(count, LIGHT)).astype(np.uint16), kind="stable")
    first, count = first.take(by_count), count.take(by_count)
    found, out = ordered.take(first), values.take(order.take(first), axis=0)
    longer = np.cumsum(np.bincount(np.minimum(count, LIGHT), minlength=LIGHT + 1)[::-1])[::-1]
    for k in range(1, LIGHT - 1):
        size = longer[k + 1]
        if not size:
            break
        out[:size] += values.take(order.take(first[:size] + k), axis=0)
    many = longer[LIGHT]
    if many:
        size = count[:many] - (LIGHT - 1)
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(first[:many] + (LIGHT - 1) - (ends - size), size)
        out[:many] += np.add.reduceat(values.take(order.take(at), axis=0), ends - size, axis=0)
    return found, out


def _descend(weights: np.ndarray, spread: np.ndarray, rows: np.ndarray, gradient: np.ndarray) -> None:
    """One AdaGrad step on the rows that occur, with the gradients of equal rows added up."""
    found, total = _added(gradient, rows, len(weights))
    grown = spread.take(found) + np.einsum("ij,ij->i", total, total) / np.float32(weights.shape[1])
    spread[found] = grown
    total *= (np.float32(STEP) / np.sqrt(grown + np.float32(1e-3)))[:, None]
    # a row is put in place as one value
    changed = weights.take(found, axis=0)
    changed -= total
    whole = np.dtype((np.void, weights.itemsize * weights.shape[1]))
    weights.view(whole)[found, 0] = changed.view(whole)[:, 0]


def train_on(model: Model, spread: list[np.ndarray], token: np.ndarray, first: np.ndarray) -> None:
    """Gradient steps over the tokens of a slice of documents; changes the weights of ``model``."""
    place = model.places(token)
    found = features(token, first)
    for a in range(0, len(token), BATCH):
        part = slice(a, a + BATCH)
        score, class_at, kind, known, within, token_at = logits(model, [f[part] for f in found], place[part])
        for scores, own, weights, grown, at in (
            (score, kind, model.class_rows, spread[0], class_at),
            (within, place[part][known] % model.width, model.token_rows, spread[1], token_at),
        ):
            if len(own):
                step, total, _ = exponentials(scores)
                step *= (1 / total)[:, None]
                step[np.arange(len(own)), own] -= 1
                for rows in at:
                    _descend(weights, grown, rows, step)


def start_model(words: DataFrame, documents: int, total: int) -> Model:
    """Vocabulary, classes and biases from the counts; all weights zero. The end is a token, one for each document."""
    end = (int(END.view(np.int64)), documents)
    width, rows = sizes(total + documents)
    vocabulary = width * (width - 1)
    top = words.orderBy(F.desc("n"), "key").limit(vocabulary).collect()  # as many as the softmax has tokens
    ranked = sorted([(row["key"], row["n"]) for row in top] + [end], key=lambda x: (-x[1], x[0]))[:vocabulary]
    counts = np.zeros((width, width))
    for i, (_, n) in enumerate(ranked):
        counts[i // width, i % width] = n
    counts[-1, 0] = total + documents - counts.sum()
    # classes and places without a token have no share; the last class is there for tokens that were never seen
    taken = np.arange(width * width).reshape(width, width) < len(ranked)
    there = taken.any(1)
    there[-1] = True
    share, inside = np.full(width, -np.inf), np.full((width, width), -np.inf)
    share[there] = np.log((counts.sum(1)[there] + 1) / (counts.sum() + there.sum()))
    inside[taken] = np.log(((counts + 0.1) / np.where(taken, counts + 0.1, 0).sum(1, keepdims=True).clip(0.1))[taken])
    inside[~taken.any(1)] = 0
    keys = np.array([k for k, _ in ranked], np.int64)
    order = np.argsort(keys)
    empty = [np.zeros((rows, width), np.float32) for _ in range(2)]
    return Model(keys[order], np.arange(len(ranked))[order], np.vstack([share, inside]).astype(np.float32), 0.0, *empty)


def one_round(docs: DataFrame, model: Model) -> Model:
    """The model after every task has gone over its documents once, the changes of the tasks averaged by tokens."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    half = len(model.class_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = held.value
        own = Model(start.keys, start.place, start.bias, start.others, start.class_rows.copy(), start.token_rows.copy())
        spread, hasher, seen = [np.zeros(half, np.float32), np.zeros(half, np.float32)], Hasher(), 0
        for batch in slices(batches):
            token, first, _ = tokens(batch.column(0), hasher)
            train_on(own, spread, token, first)
            seen += len(token)
        if seen:
            change = np.concatenate([own.class_rows - start.class_rows, own.token_rows - start.token_rows])
            blocks = change.astype(np.float16).reshape(2 * half // BLOCK, -1)
            for a in range(0, len(blocks), 64):
                part = blocks[a : a + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(a, a + len(part)), pa.int32()), pa.array([seen] * len(part), pa.int64()), pa.array([b.tobytes() for b in part])],
                    ["block", "seen", "change"],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the blocks of a partition, taken batch by batch."""
        sums: dict[int, np.ndarray] = {}
        seen: dict[int, int] = {}
        for batch in batches:
            for block, n, change in zip(*(c.to_pylist() for c in batch.columns)):
                value = np.frombuffer(change, np.float16).astype(np.float64) * n
                sums[block] = sums[block] + value if block in sums else value
                seen[block] = seen.get(block, 0) + n
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([(sums[b] / seen[b]).astype(np.float32).tobytes() for b in sums])],
                ["block", "change"],
            )

    changes = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "block int, seen long, change binary")
    means = changes.repartition("block").mapInArrow(add, "block int, change binary").collect()  # the size of the model
    weights = np.concatenate([model.class_rows, model.token_rows]).reshape(2 * half // BLOCK, -1)
    for row in means:
        weights[row["block"]] += np.frombuffer(row["change"], np.float32)
    weights = weights.reshape(2 * half, model.width)
    return Model(model.keys, model.place, model.bias, model.others, weights[:half].copy(), weights[half:].copy())


def scored(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    The model learns from the rows whose crc32(doc_id as text) mod 7 is not 2. Tokens are the words in lower case (A-Z) and an
    end. base_score sums log10((c + 1) / (N + V + 1)), score is the model's log10 probability. A null text counts as
    empty: one token, the end. A null doc_id has no remainder: its row is scored, held_out is null, and nothing is learned
    from it. Repeated rows are learned from and scored as often as they occur. Without training rows every token is unknown.
    """
    spark = docs.sparkSession
    fold = crc_bucket("doc_id", FOLDS)
    training = docs.where(fold != HELD_OUT).select("text")
    words = stored(word_counts(training), "word-counts")
    figures = words.agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("distinct")).first()
    documents, total = training.count(), figures["words"] or 0
    train_tokens, distinct = total + documents, figures["distinct"] + (documents > 0)

    model = start_model(words, documents, total)
    for _ in range(rounds if documents else 0):
        model = one_round(training, model)
    in_softmax = set(model.keys.tolist())
    other = words.where(~F.col("key").isin(sorted(in_softmax))).agg(F.sum(F.col("n") + 1).alias("mass")).first()["mass"] or 0
    model.others = float(np.log10(other + 1))

    known = spark.sparkContext.broadcast((model, documents, *arrays(at_least(words, "n", FREQUENT), "key", "n")))
    unit = float(np.log10(train_tokens + distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ends, keys, values = known.value
        hasher, lookup = Hasher(), Lookup(keys, values)
        names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "key", "n", "share"]
        for batch in slices(batches):
            rows = batch.num_rows
            token, first, words = tokens(batch.column(3), hasher)
            row = np.repeat(np.arange(rows), np.diff(first))
            natural, outside = log_probability(own, token, first)
            key = token.view(np.int64)
            frequent, count = lookup(key)
            end = np.zeros(len(token), bool)
            end[first[1:] - 1] = True
            frequent |= end
            count = np.where(end, ends, count)
            base = np.where(frequent, np.log10(count + 1.0), 0.0) - unit
            score = natural / np.log(10) - np.where(outside, own.others, 0.0)
            score += np.where(outside & frequent, np.log10(count + 1.0), 0.0)
            zero = pa.array(np.zeros(rows, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(np.diff(first)),
                    pa.array(np.bincount(row, frequent & (count > 0), rows).astype(np.int64)),
                    pa.array(np.bincount(row, base, rows)),
                    pa.array(np.bincount(row, score, rows)),
                    batch.column(0),
                    zero,
                    zero,
                ],
                names,
            )
            at, rare, n = pair_counts(row[~frequent], key[~frequent])
            place = own.places(rare.view(np.uint64)) == own.outside
            size, none = len(n), pa.array(np.zeros(len(n), np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.nulls(size, pa.int64()),
                    pa.nulls(size, pa.bool_()),
                    none,
                    none,
                    none.cast(pa.float64()),
                    none.cast(pa.float64()),
                    pa.array(rare),
                    pa.array(n),
                    pa.array(n * place),
                ],
                names,
            )

    source = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        (fold == HELD_OUT).alias("held_out"),
        F.col("text").cast("string"),
    )
    rows = source.mapInArrow(
        run,
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, key long, n long, share long",
    )
    c = F.coalesce(F.col("c"), F.lit(0))
    result = (
        rows.join(words.select("key", F.col("n").alias("c")), "key", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(c > 0, F.col("n")).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + F.col("n") * F.log10(c + 1.0)).alias("base_score"),
            F.sum(F.col("score") + F.col("share") * F.log10(c + 1.0)).alias("score"),
        )
    )
    return result.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
