"""Quality rules, personal data, decontamination, languages, urls, substrings, language model, pipeline."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from tradewind.llm import decontamination, language_id, language_model, pii, quality, substring_dedup, url_filters
from tradewind.llm.fm_index import FMIndex
from tradewind.llm.text import Hasher

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# quality rules


def brute_base(text):
    words, text = WORD.findall(text or ""), text or ""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_measures(documents, awkward, nothing):
    for docs in (documents, awkward, nothing):
        got = quality.decisions(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        want = []
        for r in docs.collect():
            base = brute_base(r["text"])
            want.append((r["doc_id"], *base, base[0] < 20 or 100 * base[4] > 30 * base[0]))
        assert rows_of(got) == sorted(want, key=repr)


def test_quality_finds_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.decisions(docs).join(labels, "doc_id").where("not base_failed")
    good = judged.where("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = judged.where("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.99 and bad < 0.05


def test_accepted_keeps_columns(awkward):
    kept = quality.accepted(awkward)
    assert kept.columns == awkward.columns and set(kept.select("doc_id").toPandas().doc_id) <= {4, 5}


# personal data


def test_emails_as_the_pattern_finds_them():
    pick, compiled = random.Random(5), pii.compiled_patterns()
    parts = [*"a1.@-+ ()9é%_", "a@b.c", "1.2.3.4", "x@y", "@"]
    for _ in range(20_000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        want = [m.span() for m in re.finditer(pii.BASE["email"], text)]
        assert [s[1:] for s in pii.base_spans(text, compiled) if s[0] == "email"] == want


def test_base_spans():
    text = "a.b@c.de 1.2.3.256 1.2.3.4 4111 1111 1111 1111 4111111111111112 +1 (988) 555-2485 +1 2"
    found = [(k, text[a:b]) for k, a, b in pii.base_spans(text, pii.compiled_patterns())]
    assert ("email", "a.b@c.de") in found and ("ip", "1.2.3.4") in found and ("phone", "+1 (988) 555-2485") in found
    assert not any(k == "ip" and t.endswith("256") for k, t in found)


def test_patterns_discover_what_no_base_pattern_knows(spark):
    people = [(i, f"please write to user{i}@mail{i}.example.com today") for i in range(40)]
    keys = [(100 + i, f"please write to {zlib.crc32(str(i).encode()):08x}{i:04d} today") for i in range(5)]
    plain = [(200 + i, f"chapter 20{i:04d} ends") for i in range(40)]
    docs = spark.createDataFrame(people + keys + plain, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.spans(docs).collect()}
    assert all("id:16:28" in got[100 + i] for i in range(5))
    assert not any(got[200 + i] for i in range(40)) and all(got[i].startswith("email:") for i in range(40))


def test_personal_data_on_awkward_rows(awkward, nothing):
    assert pii.spans(awkward).count() == awkward.count() and pii.spans(nothing).count() == 0
    empty = sha256(b"").hexdigest()
    assert pii.spans(awkward).where("doc_id < 4").select("base_sha256").distinct().collect()[0][0] == empty
    masked = pii.redacted(awkward)
    assert masked.columns == awkward.columns and masked.count() == awkward.count()


def test_masking():
    assert pii.masked("a x@y.z b 1.2.3.4", "email:2:7,ip:10:17") == "a [EMAIL] b [IP]"
    assert pii.masked("abcdef", "ip:1:4,card:3:5") == "a[IP]f"


# decontamination


def test_windows_against_brute_force(spark, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    items += [(900, "only three words"), (901, ""), (902, "alone")]
    pick = random.Random(2)
    held = [t for t in list(texts.values())[:60]]
    for k in range(40):
        words, copy = held[k].split(" "), pick.choice(items[:-3])[1].split()
        if k % 3:
            copy[pick.randrange(len(copy))] = "changed"
        at = pick.randrange(len(words))
        held[k] = " ".join(words[:at] + [w.upper() if k % 2 else w for w in copy] + words[at:])
    held += [None, "", "only three words here", "not alone"]
    got = decontamination.matches(pa.array(held), decontamination.Benchmark(items), Hasher(), 0.8)

    def shingles(words):
        width = min(5, len(words))
        return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else Counter()

    own = [t.encode().lower().split() for _, t in items]
    sets = [shingles(w) for w in own]
    df = Counter(s for c in sets for s in c)

    def weight(counter):
        return sum(math.log1p(len(items) / df[s] if s in df else len(items)) * n for s, n in counter.items())

    want = {}
    for d, text in enumerate(held):
        words = (text or "").encode().lower().split()
        for i, item in enumerate(own):
            for a in range(len(words) - len(item) + 1) if item else ():
                if len(set(words[a : a + len(item)]) & set(item)) < 0.6 * len(set(item)):
                    continue
                window = shingles(words[a : a + len(item)])
                value = weight(window & sets[i]) / weight(window | sets[i])
                if value >= 0.8 and value > want.get((d, i), (0, 0))[0] + 1e-12:
                    want[d, i] = value, a
    assert set(got) == set(want) and len(want) > 20
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)


def test_multi_index_finds_all_within_the_radius():
    items = [(i, " ".join(f"t{i}w{k}" for k in range(20))) for i in range(300)]
    bench = decontamination.Benchmark(items)
    pick = np.random.default_rng(1)
    prints = bench.prints[pick.integers(0, 300, 50)] ^ (np.uint64(1) << pick.integers(0, 64, 50).astype(np.uint64))
    got = set(bench.near(20, prints))
    distance = np.bitwise_count(prints[:, None] ^ bench.prints[None, :])
    assert got == set(zip(*(x.tolist() for x in np.nonzero(distance <= bench.radius))))


def test_decontamination_on_awkward_rows(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "text of some words"), (2, None), (3, "")], "item_id long, text string")
    found = decontamination.contaminated(awkward, benchmark)
    assert [r["doc_id"] for r in found.collect()] == [None]
    kept = decontamination.clean(awkward, benchmark)
    assert kept.columns == awkward.columns and kept.count() == awkward.count() - 1
    assert decontamination.contaminated(nothing, benchmark).count() == 0
    assert decontamination.contaminated(awkward, benchmark.limit(0)).count() == 0


def test_large_benchmarks_go_in_parts(spark, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    pairs = decontamination.contaminated(documents, benchmark).select("doc_id", "item_id")
    whole = rows_of(pairs)
    monkeypatch.setattr(decontamination, "PART_BYTES", 2000)
    assert rows_of(decontamination.contaminated(documents, benchmark).select("doc_id", "item_id")) == whole and whole


# languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


def test_languages_on_awkward_rows(awkward, nothing):
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identified(awkward).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] in ("en", "fr", "de")
    assert language_id.identified(nothing).count() == 0


# urls


def test_rules(spark):
    urls = ["http://A.Com/fr/x?y=://", None, "nope", "://", "http://sub.example.org/en/12", "http://example.org/es/"]
    urls += ["https://xexample.org/es/a", "http://org", "http://org/", "a://b://c/d#e", "http://h?x://y/", "http://É.COM/de/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] + [(None, urls[0], "c")], "page_id long, url string, host string")

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(d + p, v) for v, d, p in url_filters.RULES if (host == d or host.endswith("." + d)) and path.startswith(p)]
        return (host, path, *max(fits, key=lambda f: len(f[0]), default=(None, "allow")))

    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judged(pages).collect()]
    want = [(r["page_id"], *brute(r["url"])) for r in pages.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert url_filters.judged(pages.limit(0)).count() == 0


def test_templates_learn_from_labels(spark):
    rules = (("block", "spam.net", "/ads/1"), ("allow", "spam.net", "/news/1"))
    urls = [f"http://spam.net/{kind}/{n}" for kind in ("ads", "news", "else") for n in range(100, 200)]
    urls += [f"http://spam.net/{kind}/2{n}" for kind in ("ads", "news") for n in range(10)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r["page_id"]]: (r["template"], r["verdict"]) for r in url_filters.judged(pages, rules).collect()}
    assert got["http://spam.net/ads/25"] == ("/ads/*", "block")
    assert got["http://spam.net/news/25"] == ("/news/*", "allow") and got["http://spam.net/else/150"][1] == "allow"


def test_url_filters_are_native(spark):
    plan = url_filters.judged(spark.read.parquet(f"{FOLDER}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# substrings


def brute_substrings(rows):
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, words in split:
        for i in range(len(words) - 49 if d is not None else 0):
            w = tuple(words[i : i + 50])
            first[w] = min(d, first.get(w, d))
    for d, words in split:
        gone = set()
        for i in range(len(words) - 49 if d is not None else 0):
            if first[tuple(words[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        yield d, len(words), len(gone), sha256(kept.encode()).hexdigest()


def test_substrings(spark, documents, awkward, nothing, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(70))
    contexts = [(5000 + i, f"a{i} b{i} {passage} c{i} d{i} " + "again " * (i * 30)) for i in range(30)]
    shared = spark.createDataFrame(contexts, "doc_id long, text string")
    for docs in (documents.select("doc_id", "text").union(shared), awkward, nothing):
        want = sorted(brute_substrings([(r["doc_id"], r["text"]) for r in docs.collect()]), key=repr)
        assert rows_of(substring_dedup.deduplicated(docs)) == want
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 4000)
    assert rows_of(substring_dedup.deduplicated(shared)) == sorted(brute_substrings(contexts), key=repr)


def test_fm_index_against_search():
    pick = np.random.default_rng(4)
    size = pick.integers(1, 40, 60)
    text = np.concatenate([np.append(pick.integers(1, 4, n), 0) for n in size])
    begin = np.cumsum(size + 1) - size - 1
    owner = np.repeat(np.arange(60)[::-1], size + 1)
    got = FMIndex(text, owner, 8).least_owners(text, begin, size)
    windows = [(tuple(text[b + i : b + i + 8]), owner[b]) for b, n in zip(begin, size) for i in range(n - 7)]
    least = {}
    for w, o in windows:
        least[w] = min(o, least.get(w, o))
    assert got.tolist() == [least[w] for w, _ in windows]


# language model


def test_base_score_and_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (None, "the the the")], "doc_id long, text string")
    docs = docs.union(extra)
    got = language_model.scored(docs).collect()
    tokens = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [None]) for r in docs.collect()]
    counts = Counter()
    for d, own in tokens:
        if d is not None and zlib.crc32(str(d).encode()) % 7 != 2:
            counts.update(own)
    n, v = counts.total(), len(counts)
    want = {d: (len(own), sum(counts[t] > 0 for t in own), sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)) for d, own in tokens}
    assert len(got) == len(tokens)
    for r in got:
        size, known, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (size, known, n) and abs(r["base_score"] - base) < 1e-6
        assert r["score"] <= 0
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_without_rows(nothing, awkward):
    assert language_model.scored(nothing).count() == 0
    assert language_model.scored(awkward).count() == awkward.count()


# pipeline


def test_pipeline(spark, awkward, nothing):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before
        before = after
    assert rows_of(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)) == rows_of(corpus_pipeline.run(spark, FOLDER))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).count() == 0
        stage(spark, awkward, FOLDER).count()
