"""Personal data in awkward texts: the fast searches against the plain ones, and texts that would be slow."""

import random
import re
import time

import pytest

from tradewind.llm import pii


def plain_base(text):
    spans = []
    for kind, pattern in pii.BASE.items():
        spans += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if pii._valid(kind, m.group())]
    return spans


def plain_candidates(text, spans):
    """Where the words with a digit are that no base span touches."""
    taken = [(a, b) for _, a, b in spans]
    out = []
    for m in re.finditer(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", text):
        if not any(x < m.end() and m.start() < y for x, y in taken):
            a, b = pii._core(text, *m.span())
            if b - a >= pii.LEAST_LENGTH and re.search("[0-9]", text[a:b]):
                out.append((a, b))
    return out


def test_searches_equal_the_patterns():
    rng, compiled = random.Random(2), pii.compiled_patterns()
    for _ in range(3000):
        text = "".join(rng.choice(["1", "25", "4111111111111111", ".", "..", "@", "a", "b.c", " ", "-", "+", "(", ")", "=", "é", "\n"]) for _ in range(rng.randrange(30)))
        spans = pii.base_spans(text, compiled)
        assert spans == plain_base(text)
        assert [(c["start"], c["end"]) for c in pii.candidates(text, spans, compiled) if not c["seed"]] == plain_candidates(text, spans)


@pytest.mark.parametrize(
    "text",
    ["1" * 1_000_000, "1." * 500_000, "x" * 1_000_000 + " 1", "a1@" * 300_000, "+1 " * 300_000, "1.2.3.4 abc123def " * 20_000, "+" + "1(" * 400_000],
    ids=["digits", "dots", "word", "ats", "plus", "spans", "brackets"],
)
def test_long_texts_take_linear_time(text):
    compiled, start = pii.compiled_patterns(), time.perf_counter()
    pii.candidates(text, pii.base_spans(text, compiled), compiled)
    assert time.perf_counter() - start < 20


def test_base_digests_of_a_table(spark, documents):
    """Counts and digest of every row against the plain patterns."""
    from hashlib import sha256

    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.spans(documents).collect()}
    for row in documents.collect():
        spans = plain_base(row["text"] or "")
        counts = [sum(s[0] == kind for s in spans) for kind in pii.KINDS]
        assert got[row["doc_id"]] == (*counts, sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())
