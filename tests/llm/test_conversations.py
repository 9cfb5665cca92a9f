import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest

from tradewind.llm import conversations, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = {"u": "user", "a": "assistant"}
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(codes):
    """(cost, letters) by recursion over suffixes, with at most four insertions in a row."""

    @lru_cache(None)
    def best(i, state, inserted):
        out = [(0, "")] if i == len(codes) and state in (0, 3) else []
        if inserted < 4:
            cost, rest = best(i, turn_repair.NEXT[state], inserted + 1)
            out.append((cost + 3, "I" + rest))
        if i < len(codes):
            c = codes[i]
            cost, rest = best(i + 1, state, 0)
            out.append((cost + 4, "D" + rest))
            if c != "x":
                more = 3 if c.isupper() or c == "_" else 0
                kept = turn_repair.KEPT.get((state, c.lower()))
                if kept is not None:
                    cost, rest = best(i + 1, kept, 0)
                    out.append((cost + more, "K" + rest))
                cost, rest = best(i + 1, turn_repair.NEXT[state], 0)
                out.append((cost + more + 3, "R" + rest))
        return min(out) if out else (1 << 30, "")

    return best(0, 0, 0)


def test_auction_finds_the_cheapest_and_least_letters():
    rng = random.Random(5)
    for _ in range(600):
        codes = "".join(rng.choice("suaxSUA-_uaua") for _ in range(rng.randrange(0, 13)))
        assert turn_repair.solved(codes) == cheapest(codes)


def test_stretches_agree_with_the_whole():
    rng = random.Random(6)
    for _ in range(200):
        codes = "".join(rng.choice("suaxSUA-_uaua") for _ in range(rng.randrange(3, 13)))
        cut = rng.randrange(1, len(codes))
        left, right = codes[:cut], codes[cut:]
        ahead = [turn_repair.costs_through(right, True)[4 * s] for s in range(4)]
        cost, letters, state = turn_repair.Lattice(left, tuple(ahead), False).trace(0)
        rest = turn_repair.Lattice(right, turn_repair.CLOSED, True).trace(state)
        assert (cost, letters + rest[1]) == cheapest(codes)


def plain(rows):
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept.extend([(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in turns:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            codes += turn_repair.code(role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, letters = cheapest(codes) if len(codes) < 200 else turn_repair.solved(codes)
        edits, tail, _ = turn_repair.roles(letters, [t[1][:1] for t in turns])
        lines = []
        for (before, own), (_, role, text) in zip(edits, turns):
            lines += [f"{NAMES[b]}:" for b in before]
            if own:
                lines.append(f"{role if own == 'k' else NAMES[own]}:{text}")
        lines += [f"{NAMES[b]}:" for b in tail]
        initials = "".join(line.split(":")[0][:1] for line in lines)
        assert re.fullmatch("(s?(ua)+)?", initials)
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(turns):
    return sorted((tuple(r) for r in conversations.audited(turns).collect()), key=repr)


def test_equals_brute_force(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = result(turns)
    assert got == plain([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert sum(r[6] > 0 for r in got) > 20


def test_awkward_rows(spark):
    """Nulls in any column, empty roles, ties in turn, repeated rows, a clash of names, and conversations that lose all turns."""
    rng = random.Random(7)
    texts = [None, "", " \t", "Yes.", "No", "Why?", "Said ünd. ", "same.", "same."]
    roles = ["user", "assistant", "system", None, "", "tool", "admin"]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(80)]
    rows += [(c, 0, "user", "Only one.") for c in range(100, 160)] + [(7, 1, "user", "x" * 100_000)] + [(-1, 1 << 40, "user", "Far.")]
    turns = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA + ", row long, conv string").repartition(5)
    assert result(turns) == plain(rows)


@pytest.mark.parametrize("bits", [1, 2])
def test_short_stretches(spark, monkeypatch, bits):
    """Conversations cut into many stretches."""
    monkeypatch.setattr(conversations, "STRETCH_BITS", bits)
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert result(turns) == plain([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_long_conversation(spark):
    """One conversation with most of the turns, over many tasks and stretches."""
    rng = random.Random(8)
    rows = [(1, i, rng.choice(["user", "assistant"]) if i % 9 == 0 else ("user", "assistant")[i % 2], f"Text {i % 700}{rng.choice('..?,')}") for i in range(3000)]
    rows += [(c, i, ("user", "assistant")[i % 2], f"T {i}.") for c in range(2, 40) for i in range(6)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(6)) == plain(rows)


def test_no_rows(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
