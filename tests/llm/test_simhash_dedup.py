import re
from collections import defaultdict

import xxhash

from tradewind.llm import simhash_dedup as S
from tradewind.llm.components import components


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def check(docs, **options):
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.select("doc_id", "text").collect()]
    group = brute_groups([p for _, p in rows])
    least = defaultdict(list)
    for doc, p in rows:
        if doc is not None:
            least[group[p]].append(doc)
    want = [(doc, f"{p:016x}", min(least[group[p]], default=None)) for doc, p in rows]
    got = [tuple(r) for r in S.grouped(docs, **options).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def near_copies(spark):
    """A chain of texts that differ in a word each, and their copies."""
    words = [f"word{i}" for i in range(600)]
    rows = []
    for i in range(150):
        words[(i * 7) % 600] = f"new{i}"
        rows += [(1000 - i, " ".join(words)), (2000 + i, " ".join(words).upper())]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_groups(spark, documents, awkward, nothing):
    check(documents)
    check(awkward)
    check(nothing)


def test_dense_buckets_lose_no_link(spark):
    docs = near_copies(spark)
    check(docs)
    check(docs, dense=2)


def test_one_of_each(spark, documents, awkward, nothing):
    """Against the groups of brute force: the least doc_id of each stays, and all rows of it."""
    for docs in (documents, awkward, nothing):
        rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.select("doc_id", "text").collect() if r["doc_id"] is not None]
        group = brute_groups([p for _, p in rows])
        least = {}
        for doc, p in rows:
            least[group[p]] = min(doc, least.get(group[p], doc))
        stays = {doc for doc, p in rows if least[group[p]] == doc}
        kept = S.one_of_each(docs)
        assert kept.columns == docs.columns
        got = [r["doc_id"] for r in kept.select("doc_id").collect()]
        want = [r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] is None or r["doc_id"] in stays]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 400)] + [(1000, 2000), (2000, 1000), (7, 7), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(frame, "a", "b").collect()))
    assert got == {i: 0 for i in range(401)} | {1000: 1000, 2000: 1000}
