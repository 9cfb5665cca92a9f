"""Personal data: fixed patterns, and contextual extraction that is bootstrapped from what they find.

Every match of the base patterns is a seed instance. A candidate is a token with a digit and six characters or more.
Candidates and seeds occur in lexical patterns: the word before, the word after, and the letters the token begins with.
Spark scores the graph of patterns and instances in rounds: a pattern's confidence is the mean score of the distinct
instances it holds, pulled down by ``DOUBT`` unknown ones; an instance's score is the confidence of the best other
pattern it occurs in, weakened at each round by ``FADE``, and 1 for seeds. Patterns of high confidence that hold enough instances discover
the identifiers that no base pattern knows, for example keys and passwords.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")
# The base patterns.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LEAST_LENGTH = 6
ROUNDS = 4
DOUBT = 2.0
FADE = 0.95
#: A pattern discovers from this confidence on, and if it holds so many distinct instances.
CONFIDENCE = 0.6
SUPPORT = 5


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(int(part[-4:]) <= 255 and len(part.lstrip("0")) <= 3 for part in found.split("."))
    digits = re.sub("[^0-9]", "", found)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def emails(text: str, local: re.Pattern, rest: re.Pattern) -> Iterator[tuple[int, int]]:
    """The matches of the email pattern, found from each @: as the pattern finds them, without trying every start."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and local.match(text[start - 1]):
            start -= 1
        match = rest.match(text, at) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str, compiled: dict[str, re.Pattern]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every base match, by kind and start."""
    spans = []
    if "@" in text:
        spans += [("email", a, b) for a, b in emails(text, compiled["local"], compiled["rest"])]
    if compiled["digit"].search(text):
        for kind in KINDS[1:]:
            for m in compiled[kind].finditer(text):
                if _valid(kind, m.group()):
                    spans.append((kind, m.start(), m.end()))
    return spans


def compiled_patterns() -> dict[str, re.Pattern]:
    out = {kind: re.compile(pattern) for kind, pattern in BASE.items()}
    return out | {
        # a match can only begin where a run of digits does: the same matches, without a try at every digit
        "ip": re.compile("(?<![0-9])" + BASE["ip"]),
        "local": re.compile(r"[A-Za-z0-9._%+-]"),
        "rest": re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "digit": re.compile("[0-9]"),
        # a word with a digit, tried where a word begins
        "token": re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*"),
    }


def _core(text: str, start: int, end: int) -> tuple[int, int]:
    """A token without quotes and marks around it, and without a name and an equals sign before it."""
    while start < end and not text[start].isalnum():
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    cut = text.rfind("=", start, end)
    return (cut + 1 if cut >= 0 else start), end


def _neighbour(words: list[str], side: int) -> str | None:
    if not words:
        return None
    word = words[side].strip(".,;:!?\"'()[]").lower()
    if not any(c.isalnum() for c in word) and len(words) > 1:  # a sign: with the word beside it
        return " ".join(words[-2:] if side else words[:2]).lower()
    return word or words[side].lower()


def candidates(text: str, spans: list[tuple[str, int, int]], compiled: dict[str, re.Pattern]) -> list[dict]:
    """Seeds and candidates with the patterns each occurs in.

    Neighbours are taken from 80 characters on either side; of a longer word only that part counts.
    """
    taken = sorted((a, b) for _, a, b in spans)
    found = [(a, b, a, b, True) for a, b in taken]
    passed, reach = 0, 0
    for m in compiled["token"].finditer(text):
        a, b = m.span()
        while passed < len(taken) and taken[passed][0] < b:
            reach = max(reach, taken[passed][1])
            passed += 1
        if reach > a:  # a span that begins before the token's end goes beyond its begin
            continue
        core_a, core_b = _core(text, a, b)
        if core_b - core_a >= LEAST_LENGTH and compiled["digit"].search(text, core_a, core_b):
            found.append((a, b, core_a, core_b, False))
    out = []
    for a, b, core_a, core_b, seed in found:
        left = _neighbour(text[max(0, a - 80) : a].split(), -1)
        right = _neighbour(text[b : b + 80].split(), 0)
        head = re.match(r"[^\W\d_]*[=:]?[^\W\d_]*", text[a:core_b].lstrip("\"'([")).group()[:12].lower()
        patterns = [p for p in (left and f"left {left}", right and f"right {right}", len(head) >= 4 and f"head {head}") if p]
        out.append(
            {"start": core_a, "end": core_b, "seed": seed, "instance": xxhash.xxh64_intdigest(text[core_a:core_b]) - (1 << 63), "patterns": patterns}
        )
    return out


def scanned(docs: DataFrame) -> DataFrame:
    """One row for each of ``docs``: doc_id, text_key (hash of the text), counts and base spans, seeds and candidates."""
    schema = (
        "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base array<string>, "
        "found array<struct<start:int,end:int,seed:boolean,instance:long,patterns:array<string>>>"
    )
    arrow = pa.list_(
        pa.struct(
            [("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("instance", pa.int64()), ("patterns", pa.list_(pa.string()))]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = compiled_patterns()
        for batch in batches:
            counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
            base, found = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                spans = base_spans(text, compiled)
                for kind in KINDS:
                    counts[kind].append(sum(s[0] == kind for s in spans))
                base.append([f"{kind}:{a}:{b}" for kind, a, b in spans])
                found.append(candidates(text, spans, compiled) if compiled["digit"].search(text) or spans else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *(pa.array(counts[kind], pa.int64()) for kind in KINDS),
                    pa.array(base, pa.list_(pa.string())),
                    pa.array(found, arrow),
                ],
                ["doc_id", "text_key", *(f"n_{kind}" for kind in KINDS), "base", "found"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string")).mapInArrow(run, schema)


def pattern_scores(scans: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence, support) of every pattern, from the rows of ``scanned``.

    In the first round instances that are no seeds score 0. Later an instance's score within a pattern comes from its best
    other pattern with enough support; where it has none it is unknown and does not count.
    """
    occurrences = scans.select(F.explode("found").alias("f")).select("f.instance", "f.seed", F.explode("f.patterns").alias("pattern"))
    edges = stored(occurrences.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pattern-edges")

    def confidence(scored: DataFrame) -> DataFrame:
        held = (F.sum("score") / (F.count("score") + DOUBT)).alias("confidence")
        return scored.groupBy("pattern").agg(held, F.count(F.lit(1)).alias("support"))

    patterns = confidence(edges.withColumn("score", F.col("seed").cast("double")))
    for _ in range(rounds - 1):
        trusted = patterns.where(F.col("support") >= SUPPORT).select("pattern", (F.col("confidence") * FADE).alias("trust"))
        weighed = stored(edges.join(trusted, "pattern", "left"), "pattern-trust")
        best = weighed.groupBy("instance").agg(F.max(F.when(F.col("trust").isNotNull(), F.struct("trust", "pattern"))).alias("best"))
        other = weighed.join(best, "instance")
        second = other.where(F.col("pattern") != F.col("best.pattern")).groupBy("instance").agg(F.max("trust").alias("second"))
        ranked = other.join(second, "instance", "left")
        from_others = F.when(F.col("best.pattern") == F.col("pattern"), F.col("second")).otherwise(F.col("best.trust"))
        patterns = stored(confidence(ranked.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(from_others))), "pattern-scores")
    return patterns


def discovered(scans: DataFrame) -> DataFrame:
    """(doc_id, text_key, extra): the spans of each text that high-confidence patterns add, by start; only texts with some."""
    scores = pattern_scores(scans)
    good = scores.where((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT)).select("pattern")
    open_spans = (
        scans.select("doc_id", "text_key", F.explode("found").alias("f"))
        .where("not f.seed")
        .select("doc_id", "text_key", "f.start", "f.end", F.explode("f.patterns").alias("pattern"))
    )
    hits = open_spans.join(good, "pattern", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "end")).alias("hits"))
    return hits.select(
        "doc_id",
        "text_key",
        F.transform(F.array_sort("hits"), lambda s: F.concat_ws(":", F.lit("id"), s["start"], s["end"])).alias("extra"),
    )


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, counts, base_sha256 and spans for every row of ``docs``.

    spans lists kind:start:end in code points, end exclusive: the base kinds in their order, then ``id`` for what the
    patterns add; never two of them for one candidate. A null text counts as empty: no spans, the digest of nothing.
    Repeated rows each get a row; rows that repeat a doc_id with another text are told apart by the text's hash.
    """
    scans = stored(scanned(docs), "pii-scans")
    extra = discovered(scans).withColumnsRenamed({"doc_id": "of_doc", "text_key": "of_text"})
    joined = scans.join(extra, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_key") == F.col("of_text")), "left")
    base = F.concat_ws(",", "base")
    return joined.select(
        "doc_id",
        "text_key",
        *(f"n_{kind}" for kind in KINDS),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.concat("base", F.coalesce("extra", F.array().cast("array<string>")))).alias("spans"),
    )


def masked(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first is replaced whole."""
    parts, done = [], 0
    for start, end, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(","))):
        if end <= done:
            continue
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*parts, text[done:]])


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with personal data masked in ``text``, and n_chars brought up to date where it is a column."""
    found = spans(docs).where("spans <> ''").distinct()
    found = found.select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__text"), F.col("spans").alias("__spans"))

    @F.pandas_udf("string")
    def mask(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else masked(t, s) for t, s in zip(text, spans)], dtype=object)

    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__text"))
    out = docs.join(found, same, "left").withColumn("text", mask("text", "__spans"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
