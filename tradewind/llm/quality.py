"""Quality rules by weak supervision.

Rules vote good or bad on a document, or abstain. Expectation-maximisation estimates from the votes alone how often each
rule is right, and the posterior probability of good quality decides, in place of a filter that all rules must pass.

The votes of a document are a pattern of three values for each rule. Expectation-maximisation needs only how
often each pattern occurs, so its input is one count per pattern: at most 3 ** 10 rows, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import stored
from tradewind.llm.text import Hasher, Words, gram_starts, grams, slices

#: The length of the windows whose repetition is counted.
WINDOW = 8
#: Votes of a rule by the value of its measure: bad from ``bad`` on, good up to ``good``, else it abstains. A rule without
#: ``good`` only ever votes bad: most defects are rare, and their absence says little.
#: For rules whose name ends in _low it is bad down to ``bad`` and good from ``good`` on.
RULES = {
    "symbol_share": ("n_symbols / greatest(word_chars, 1)", 0.05, None),
    "marked_share": ("n_marked / greatest(n_words, 1)", 0.15, None),
    "shout_share": ("n_shouts / greatest(n_words, 1)", 0.10, None),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", 0.50, None),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", 0.30, 0.0),
    "upper_share": ("n_upper / greatest(word_chars, 1)", 0.40, None),
    "length_low": ("n_words", 20, 50),
    "word_length_low": ("word_chars / greatest(n_words, 1)", 2.5, None),
    "end_marks_low": ("n_ends / greatest(n_words, 1)", 0.002, 0.02),
    "distinct_share_low": ("n_distinct / sqrt(greatest(n_words, 1))", 2.0, None),
}
MEASURES = "word_chars n_symbols n_dup_lines n_repeat_words n_lines n_marked n_shouts n_upper n_ends n_distinct"
ROUNDS = 60
#: The start, and the belief that is mixed in with weight ``PRIOR`` (a share of the documents): how often a rule votes bad
#: and good, and abstains, on a bad document (which has one defect, not all) and on a good one.
BELIEF = ((0.3, 0.4, 0.3), (0.01, 0.9, 0.09))
PRIOR = 0.02


def _count(weights: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(weights, dtype=np.int64)))
    return total[edges[1:]] - total[edges[:-1]]


def _repeats(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, hash): whether it occurs more than once, and whether it is an earlier one's repetition."""
    order = np.lexsort((hashes, row))
    r, h = row[order], hashes[order]
    same = np.zeros(len(order), bool)
    same[1:] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    more = same.copy()
    more[:-1] |= same[1:]
    twice, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    twice[order], later[order] = more, same
    return twice, later


def measure(texts: pa.Array, hasher: Hasher) -> list[np.ndarray]:
    """n_words and MEASURES of each text."""
    w = Words(texts)
    data, rows = w.data, len(w.count)
    flag = np.zeros(256, bool)
    space, symbol, upper, end = flag.copy(), flag.copy(), flag.copy(), flag.copy()
    space[[9, 10, 11, 12, 13, 32]] = True
    symbol[list(b"#*$%&|<>")] = True
    upper[65:91] = True
    end[list(b".?:;")] = True
    chars = _count(((data & 0xC0) != 0x80) & ~space[data], w.offset)
    hashes = hasher(data, w.start, w.end)
    row = w.row
    inside = gram_starts(w.first, WINDOW, len(w))
    at = np.flatnonzero(inside)
    twice, _ = _repeats(row[at], grams(hashes, WINDOW)[at])
    cover = np.zeros(len(w) + WINDOW + 1, np.int32)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    repeated = np.cumsum(cover)[: len(w)] > 0
    # lines that hold a word
    cut = np.zeros(len(data) + 1, bool)
    cut[w.offset] = True
    cut[1:] |= np.concatenate((data == 10, [])).astype(bool)
    begin = np.flatnonzero(cut)
    stop = np.append(begin[1:], len(data)) if len(begin) else begin
    stop = np.where((stop > begin) & (data[np.maximum(stop, 1) - 1] == 10 if len(data) else False), stop - 1, stop)
    worded = np.searchsorted(w.start, stop) > np.searchsorted(w.start, begin)
    begin, stop = begin[worded], stop[worded]
    line_row = np.searchsorted(w.offset, begin, side="right") - 1
    _, later = _repeats(line_row, hasher(data, begin, stop))
    _, again = _repeats(row, hashes)
    marks = np.concatenate(([0], np.cumsum(symbol[data])))
    last = data[w.end - 1] if len(w) else data
    return [
        w.count.astype(np.int64),
        chars,
        _count(symbol[data], w.offset),
        np.bincount(line_row, later, rows).astype(np.int64),
        _count(repeated, w.first),
        np.bincount(line_row, minlength=rows).astype(np.int64),
        _count(marks[w.end] > marks[w.start], w.first),
        _count(last == 33, w.first),
        _count(upper[data], w.offset),
        _count(end[last], w.first),
        _count(~again, w.first),
    ]


def measures(docs: DataFrame, kept: Column) -> DataFrame:
    """``kept`` of every row of ``docs`` (as ``row``) with n_words and the measures the rules look at.

    A null text has no words and zero everywhere.
    """
    names = ["n_words", *MEASURES.split()]
    source = docs.select(kept.alias("row"), F.col("text").cast("string").alias("text"))
    schema = source.select("row").schema
    for name in names:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches):
            found = [pa.array(x, pa.int64()) for x in measure(batch.column(1), hasher)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *found], ["row", *names])

    return source.mapInArrow(run, schema)


def votes(measured: DataFrame) -> DataFrame:
    """The measures with a column ``votes``: 1 good, 0 bad, -1 abstains, in the order of the rules."""
    cast = []
    for name, (value, bad, good) in RULES.items():
        x = F.expr(value)
        low = name.endswith("_low")
        vote = F.when(x <= bad if low else x >= bad, 0)
        if good is not None:
            vote = vote.when(x >= good if low else x <= good, 1)
        cast.append(vote.otherwise(-1))
    return measured.withColumn("votes", F.array(*cast))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Share of good documents, and for each rule how often it casts each vote: rates[rule, quality, vote].

    ``patterns`` has a row of votes for each pattern. A rule's votes are taken as independent given the quality. The
    start is ``BELIEF``, and it stays in the estimates with some weight: without it the rules that agree most would make
    up a quality of their own. A rule that never votes good has its share of good votes in abstentions.
    """
    total = counts.sum()
    belief = np.tile(np.array(BELIEF), (patterns.shape[1], 1, 1))
    for r, (_, _, good) in enumerate(RULES.values()):
        if good is None:
            belief[r, :, 2] += belief[r, :, 1]
            belief[r, :, 1] = 0
    share, rates = 0.8, belief.copy()
    for _ in range(rounds if total else 0):
        p = posterior(patterns, share, rates)
        share = float(np.clip(p @ counts / total, 0.02, 0.98))
        for r in range(patterns.shape[1]):
            for quality, weight in ((0, (1 - p) * counts), (1, p * counts)):
                seen = np.array([weight[patterns[:, r] == v].sum() for v in (0, 1, -1)])
                seen += belief[r, quality] * PRIOR * total
                rates[r, quality] = np.clip(seen / seen.sum(), 0.002, 0.998)
    return share, rates


def posterior(patterns: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """Probability of good quality of each pattern."""
    odds = np.full(len(patterns), np.log(share / (1 - share)))
    for r, weight in enumerate(evidence(rates)):
        odds += weight[patterns[:, r]]
    return 1 / (1 + np.exp(-odds))


def evidence(rates: np.ndarray) -> np.ndarray:
    """Log odds for good of each rule's votes bad and good and of its abstention."""
    rates = np.maximum(rates, 1e-6)
    return np.log(rates[:, 1] / rates[:, 0])


def vote_counts(voted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The patterns of votes and how often each occurs: at most 3 ** len(RULES) rows come to the driver."""
    table = voted.groupBy("votes").count().collect()
    patterns = np.array([row["votes"] for row in table], np.int64).reshape(-1, len(RULES))
    return patterns, np.array([row["count"] for row in table], float)


def judged(measured: DataFrame, share: float, rates: np.ndarray, least: float = 0.5) -> DataFrame:
    """The measures with base_failed, posterior and kept, by what ``fit`` has estimated.

    base_failed: under 20 words, or over 30 words of 100 in repeated windows. Others are kept from a posterior of
    ``least`` on.
    """
    odds = F.lit(float(np.log(share / (1 - share))))
    for r, weight in enumerate(evidence(rates)):
        bad, good, silent = (F.lit(float(x)) for x in weight)
        vote = F.col("votes")[r]
        odds += F.when(vote == 0, bad).when(vote == 1, good).otherwise(silent)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    good = 1 / (1 + F.exp(-odds))
    return votes(measured).select(
        "*", failed.alias("base_failed"), good.alias("posterior"), (~failed & (good >= least)).alias("kept")
    )


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, measures, base_failed, posterior and kept for every row of ``docs``.

    Repeated rows count as often as they occur and get a row each; a null doc_id is kept; no rows give no rows. Other
    columns are not read.
    """
    measured = stored(measures(docs, F.col("doc_id").cast("long")).withColumnRenamed("row", "doc_id"), "quality-measures")
    return judged(measured, *fit(*vote_counts(votes(measured))))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. The texts are measured twice, and never shuffled."""
    estimates = fit(*vote_counts(votes(measures(docs, F.lit(None).cast("long")))))
    whole = measures(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    return judged(whole, *estimates).where("kept").select("row.*")
