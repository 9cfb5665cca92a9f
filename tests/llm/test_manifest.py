import zlib
from hashlib import sha256

import pytest

from tradewind.llm import manifest

COLUMNS = manifest.COLUMNS


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row, change=False):
    parts = []
    for c in COLUMNS:
        v = row[c]
        if c == "text" and change and v is not None:
            v = "".join(x.lower() if "A" <= x <= "Z" else x for x in v)
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h("".join(parts))


def climb(levels, at, node):
    """(proof, folded) of the node at a place of the lowest level."""
    proof = ""
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        left, right = "".join(run[: at % 16]), "".join(run[at % 16 + 1 :])
        proof += left + right
        node = h(left + node + right)
        at //= 16
    return proof, node


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = grow([x[2] for x in groups[name]])
    top = grow([trees[n][-1][0] for n in names])
    out = []
    for place, name in enumerate(names):
        for at, (_, _, leaf, r) in enumerate(groups[name]):
            marked = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            low, node = climb(trees[name], at, leaf_of(r, True) if marked else leaf)
            high, node = climb(top, place, node)
            out.append((r["doc_id"], leaf, trees[name][-1][0], top[-1][0], h(low + high), node, node == top[-1][0]))
    return sorted(out, key=repr)


def result(docs):
    return sorted((tuple(r) for r in manifest.proven(docs).collect()), key=repr)


def test_equals_a_plain_tree(documents):
    got = result(documents)
    assert got == plain(documents.collect())
    assert any(r[6] for r in got) and not all(r[6] for r in got)


def test_awkward_rows(spark, awkward):
    """Nulls in id and group, repeated rows and ids: equal to the plain tree with rows of one id by digest."""
    assert result(awkward) == plain(awkward.collect())
    rows = [(i, f"Text {i}", "en", None, i) for i in range(300)] + [(None, f"n{i}", None, "s", 1) for i in range(40)]
    rows += [(7, "Again", "en", "s", 1)] * 50 + [(7, f"Again {i}", "en", "s", 1) for i in range(50)] + [(-5, "a", None, "s", None), (1 << 60, "b", "x", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert result(docs) == plain(docs.collect())


def test_far_apart_ids_use_more_directory_levels(spark):
    rows = [((i * 2654435761 * 97_003 ^ i << 45) % (1 << 63) - (1 << 62), "T", "en", f"s{i % 2}", 1) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert result(docs) == plain(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_sizes(spark, n):
    docs = spark.createDataFrame([(i, "T", "en", "s", 1) for i in range(n)], "doc_id long, text string, lang string, source string, n_chars long")
    assert result(docs) == plain(docs.collect())


def test_nothing(nothing):
    assert result(nothing) == []


def test_no_python_and_no_sort_of_all_leaves(documents):
    plan = manifest.proven(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
