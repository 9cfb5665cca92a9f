"""Conversation structure: damage, faults, and the cheapest repair.

The turns are put in order by range partitions of (conversation, turn, role, text), so a conversation of any length is spread
over tasks, and written with a running number. Stretches of up to ``STRETCH`` turns of one conversation are solved by auction
(``turn_repair``). A conversation in one stretch is done at once. One in several is solved in four steps: costs
through every stretch, prices at the seams from the last stretch back, letters of every stretch from each of its four entry states, and the walk
along the seams. Only what grows with the number of stretches, a few bytes for each, comes together for a conversation; its audit, one
letter for each turn, has to fit in a row anyway.

The digest of a repaired conversation is one SHA-256 over all its text, so it is taken in order by one task, which streams over sorted rows
and holds none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm import turn_repair
from tradewind.llm.tables import stored

#: Turns of a stretch, as a power of two.
STRETCH_BITS = 7
#: Stretches whose solution a task remembers.
REMEMBERED = 100_000
ROLES = {"u": b"user", "a": b"assistant"}
SOLID = r"[^\x20\x09-\x0D]"


def damaged(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text) of the turns after the damage by crc32(conv_id:turn) mod 20; conv is '' for a null conv_id."""
    hit = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.translate(_text("text"), ".!?", "")).otherwise(_text("text"))
    return (
        turns.select(
            _conv(),
            F.col("turn").cast("long").alias("turn"),
            F.when(hit == 4, "user").otherwise(_text("role")).alias("role"),
            text.alias("text"),
            hit.alias("hit"),
        )
        .where("hit <> 0")
        .select("conv", "turn", "role", "text", F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
        .drop("again")
    )


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _conv() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv")


def ordered(turns: DataFrame) -> DataFrame:
    """The turns with ``row``, in the order of (conv, turn, role, text), nulls first, and what their faults are told by.

    Turns of one number are ordered by role, then text.
    """
    keys = ["conv", "turn", "role", "text"]
    found = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row", F.monotonically_increasing_id())
    last = F.regexp_extract("text", f"({SOLID})[\\x20\\x09-\\x0D]*\\z", 1)
    same = F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))
    return found.select("row", *keys, F.unhex(same).alias("content"), last.alias("ending"))


def faults(turns: DataFrame) -> DataFrame:
    """(conv, row, turn, initial, fault) of the ordered turns: the first of blank, duplicate and truncated, or ''."""
    first = turns.groupBy("conv", "content").agg(F.min("row").alias("row")).select("row", F.lit(True).alias("new"))
    fault = F.when(F.col("ending") == "", "blank").when(F.col("new").isNull(), "duplicate").when(~F.col("ending").isin(*".!?"), "truncated")
    marked = turns.select("row", "conv", "turn", "ending", F.substring("role", 1, 1).alias("initial")).join(first, "row", "left")
    return marked.select("conv", "row", "turn", "initial", fault.otherwise("").alias("fault"))


def stretches(turns: DataFrame) -> DataFrame:
    """(conv, stretch, codes, initials, ...) of turns with faults, and what is counted in each; stretch is the row by ``STRETCH_BITS``."""
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), turn_repair.GONE)
        .when(F.col("fault") == "truncated", F.when(F.col("initial").isin(*"sua"), F.upper("initial")).otherwise("_"))
        .otherwise(F.when(F.col("initial").isin(*"sua"), F.col("initial")).otherwise("-"))
    )
    each = F.collect_list(F.struct("row", "turn", "initial", letter.alias("code")))
    found = turns.groupBy("conv", F.shiftright("row", STRETCH_BITS).alias("stretch")).agg(
        F.array_sort(each).alias("turns"),
        *(F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")),
    )
    pairs = F.expr(
        "filter(zip_with(slice(turns.initial, 1, size(turns) - 1), slice(turns.initial, 2, size(turns) - 1), (a, b) -> a || b), p -> p not in ('su', 'ua', 'au'))"
    )
    return found.select(
        "conv",
        "stretch",
        "blank",
        "duplicate",
        "truncated",
        F.array_join("turns.code", "").alias("codes"),
        F.col("turns.initial").alias("initials"),
        F.size(pairs).cast("long").alias("illegal"),
        F.array_min("turns.turn").alias("low"),
        F.array_max("turns.turn").alias("high"),
        F.size(F.array_distinct(F.filter("turns.turn", lambda t: t.isNotNull()))).cast("long").alias("numbers"),
        F.struct(
            "stretch",
            F.element_at("turns.initial", 1).alias("opens"),
            F.element_at("turns.initial", -1).alias("closes"),
            F.element_at("turns.turn", 1).alias("first"),
            F.element_at("turns.turn", -1).alias("last"),
        ).alias("seam"),
    )


def counted(parts: DataFrame) -> DataFrame:
    """(conv, n, gaps, blank, duplicate, truncated, illegal) of every conversation with stretches; n is how many."""
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "numbers")]
    found = parts.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), *sums, F.min("low").alias("low"), F.max("high").alias("high"), F.array_sort(F.collect_list("seam")).alias("seams")
    )
    seams = "aggregate(sequence(1, size(seams) - 1), 0L, (sum, i) -> sum + if({}, 1L, 0L))"
    seams = f"if(size(seams) > 1, {seams}, 0L)"
    illegal = F.expr(seams.format("seams[i - 1].closes || seams[i].opens not in ('su', 'ua', 'au')"))
    again = F.expr(seams.format("coalesce(seams[i - 1].last = seams[i].first, false)"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - (F.col("numbers") - again), F.lit(0))
    return found.select("conv", "n", gaps.alias("gaps"), "blank", "duplicate", "truncated", (F.col("illegal") + illegal).alias("illegal"))


SOLVED = "conv string, stretch long, initials array<string>, letters string, cost long"


def _whole(parts: DataFrame) -> DataFrame:
    """The edits of conversations in one stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solved = lru_cache(REMEMBERED)(turn_repair.solved)
        for batch in batches:
            found = [solved(codes) for codes in batch.column(3).to_pylist()]
            letters, cost = pa.array([f[1] for f in found], pa.string()), pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), letters, cost], ["conv", "stretch", "initials", "letters", "cost"])

    return parts.select("conv", "stretch", "initials", "codes").mapInArrow(run, SOLVED)


def _through(parts: DataFrame) -> DataFrame:
    """(conv, stretch, through): the costs from each state before a stretch to each behind it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [turn_repair.costs_through(codes, last) for codes, last in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(costs, pa.list_(pa.int64()))], ["conv", "stretch", "through"])

    return parts.select("conv", "stretch", "codes", "last").mapInArrow(run, "conv string, stretch long, through array<long>")


def _prices(through: DataFrame) -> DataFrame:
    """(conv, stretch, ends): the distances from each state behind a stretch to the end of the conversation, from the last stretch back."""
    lists = through.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("stretch", "through"))).alias("all"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, all_parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ahead, out = list(turn_repair.CLOSED), []
                for n, part in enumerate(reversed(all_parts)):
                    out.append((part["stretch"], ahead))
                    costs = part["through"]
                    # the end of the conversation is one state: the first column
                    ahead = [min(costs[4 * s + e] + (ahead[e] if n else 0) for e in (turn_repair.STATES if n else (0,))) for s in turn_repair.STATES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv] * len(out)), pa.array([s for s, _ in out], pa.int64()), pa.array([e for _, e in out], pa.list_(pa.int64()))],
                    ["conv", "stretch", "ends"],
                )

    return lists.mapInArrow(run, "conv string, stretch long, ends array<long>")


def _from_each_state(parts: DataFrame) -> DataFrame:
    """The cheapest edits of each stretch from every state before it, with the state behind."""
    schema = "conv string, stretch long, initials array<string>, ways array<struct<cost: long, letters: string, state: int>>"
    kind = pa.list_(pa.struct([("cost", pa.int64()), ("letters", pa.string()), ("state", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for codes, last, ends in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
                lattice = turn_repair.Lattice(codes, tuple(ends), last)
                found.append([dict(zip(("cost", "letters", "state"), lattice.trace(s))) for s in turn_repair.STATES])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(found, kind)], ["conv", "stretch", "initials", "ways"])

    return parts.select("conv", "stretch", "initials", "codes", "last", "ends").mapInArrow(run, schema)


def _in_stretches(parts: DataFrame) -> DataFrame:
    """The edits of conversations in more than one stretch."""
    ends = parts.groupBy("conv").agg(F.max("stretch").alias("final"))
    parts = stored(parts.join(ends, "conv").withColumn("last", F.col("stretch") == F.col("final")).drop("final"), "long-conversations")
    prices = _prices(stored(_through(parts), "costs-through"))
    ways = stored(_from_each_state(parts.join(prices, ["conv", "stretch"])), "stretch-edits")
    # where the walk from nothing enters each stretch
    states = F.expr("transform(ways, w -> w.state)")
    lists = ways.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("stretch", states.alias("to")))).alias("all"), F.min_by(F.col("ways")[0]["cost"], "stretch").alias("cost"))
    entries = "aggregate(all, array(0), (walk, part) -> concat(walk, array(part.to[element_at(walk, -1)])))"
    walked = lists.select("conv", "cost", F.explode(F.arrays_zip(F.col("all.stretch").alias("stretch"), F.expr(f"slice({entries}, 1, size(all))").alias("enters"))).alias("at"))
    walked = walked.select("conv", "cost", F.col("at")["stretch"].alias("stretch"), F.col("at")["enters"].alias("enters"))
    return ways.join(walked, ["conv", "stretch"]).select("conv", "stretch", "initials", F.expr("ways[enters].letters").alias("letters"), "cost")


def repaired(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv, cost, audit, repaired_sha256) from the ordered turns and the edits of their stretches.

    The rows of a conversation reach one task in order, each stretch's edits before its turns; the task adds them to a running digest.
    """
    empty_texts = [F.lit(None).cast(t).alias(c) for c, t in (("initials", "array<string>"), ("letters", "string"), ("cost", "long"))]
    lines = turns.select("conv", "row", F.lit(1).alias("kind"), F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), *empty_texts)
    heads = edits.select(
        "conv",
        F.shiftleft("stretch", STRETCH_BITS).alias("row"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("binary").alias("role"),
        F.lit(None).cast("binary").alias("text"),
        "initials",
        "letters",
        "cost",
    )
    rows = lines.union(heads).repartition("conv").sortWithinPartitions("conv", "row", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun, state = None, False, turn_repair.START
        digest, audit, cost, pending, tail = None, [], 0, [], ""
        out: list[tuple] = []

        def put(role: bytes, text: bytes) -> None:
            nonlocal begun
            digest.update(b"\n" + role + b":" if begun else role + b":")
            digest.update(text)
            begun = True

        def close() -> None:
            for initial in tail:
                put(ROLES[initial], b"")
            out.append((conv, cost, "".join(audit), digest.hexdigest()))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "cost", "audit", "repaired_sha256"])
            out.clear()
            return batch

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6, 7)]
            for name, kind, role, text, initials, letters, price in zip(*columns):
                if name != conv:
                    if conv is not None:
                        close()
                    conv, begun, state, digest, audit, cost, tail = name, False, turn_repair.START, hashlib.sha256(), [], price, ""
                if kind == 0:
                    edits_of, tail, state = turn_repair.roles(letters, initials, state)
                    pending = edits_of[::-1]
                    audit.append(letters)
                    continue
                before, own = pending.pop()
                for initial in before:
                    put(ROLES[initial], b"")
                if own:
                    put(role if own == "k" else ROLES[own], text)
            if out:
                yield flush()
        if conv is not None:
            close()
        yield flush()

    return rows.mapInArrow(run, "conv string, cost long, audit string, repaired_sha256 string")


def audited(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation of ``turns``.

    A null in any column counts as one space, as the number of a turn it comes first and makes no gap; null conv_ids are one
    conversation. Turns of one number are taken by role, then text, so repeated rows are duplicates. A role without a first character
    cannot be kept. Conversations of which no turn is left have zeros, an empty audit and the digest of nothing. No rows give
    no rows; other columns are not read.
    """
    convs = turns.select(F.col("conv_id").cast("long").alias("conv_id"), _conv()).distinct()
    rows = stored(ordered(damaged(turns)), "ordered-turns")
    parts = stored(stretches(faults(rows)), "stretches")
    counts = stored(counted(parts), "conversations")
    one = parts.join(counts.where("n = 1").select("conv"), "conv", "left_semi")
    more = parts.join(counts.where("n > 1").select("conv"), "conv", "left_semi").select("conv", "stretch", "codes", "initials")
    edits = stored(_whole(one), "edits").union(_in_stretches(more))
    found = convs.join(counts, "conv", "left").join(repaired(rows, edits), "conv", "left")
    zeros = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
