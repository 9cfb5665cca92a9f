import random
from hashlib import sha256

import pyarrow as pa
import pytest
import regex

public_tokenizers = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tradewind.llm import byte_bpe, frequent, pretokens, token_counts  # noqa: E402
from tradewind.llm.queries import vocabulary  # noqa: E402

PARTS = ["'s", "'re", "'ve", "'ll", "'", " ", "  ", "\n", "\t", "a", "bc", "é", "漢字", "1", "²", "!", "...", "\u00a0"]
PARTS += ["😀", "<|endoftext|>", "the", " of", "'t", "\x1c", "\x85", "aaaa", "S", "\u0300"]


@pytest.fixture(scope="module")
def odd_texts():
    pick = random.Random(3)
    made = ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 30))) for _ in range(2000)]
    return [*made, None, "", "'", "x'", "a" * 5000, " " * 500]


def test_pretokens_follow_the_pattern(odd_texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    found = pretokens.PreTokens(pa.array(odd_texts), pretokens.class_table(pretokens.ranges()))
    raw = found.data.tobytes()
    for i, text in enumerate(odd_texts):
        own = slice(found.first[i], found.first[i + 1])
        assert [raw[a:b].decode() for a, b in zip(found.start[own], found.end[own])] == pattern.findall(text or "")


def test_words_that_reach_a_token_in_two_ways():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257, b"abcd": 258, b"bcb": 259}
    words = [b"abcbcd", b"bcbcabc", b"abcbcb", b"aabcc"]
    assert byte_bpe.replay(words, ranks) == [byte_bpe.lowest_first(w, ranks) for w in words]


def test_digests(spark, documents, texts, awkward, nothing):
    path = vocabulary("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={}
    )

    def want(doc, text):
        ids = library.encode_ordinary(text or "")
        hexes = (sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode()))
        return (doc, len(ids), *hexes)

    got = {tuple(r) for r in byte_bpe.digests(documents, path).collect()}
    assert got == {want(d, t) for d, t in texts.items()}
    rows = sorted((tuple(r) for r in byte_bpe.digests(awkward, path).collect()), key=repr)
    assert rows == sorted((want(r["doc_id"], r["text"]) for r in awkward.collect()), key=repr)
    assert byte_bpe.digests(nothing, path).count() == 0


def test_token_counts(spark, documents, awkward, nothing, odd_texts):
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    library = Tokenizer.from_str(definition)

    def check(docs):
        got = sorted((tuple(r) for r in token_counts.per_document(docs, definition).collect()), key=repr)
        want = []
        for r in docs.select("doc_id", "text").collect():
            n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
            want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 1024))
        assert got == sorted(want, key=repr)

    check(documents)
    check(awkward)
    check(nothing)
    check(spark.createDataFrame(list(enumerate(odd_texts)), "doc_id long, text string"))


def test_rare_pretokens_are_joined(spark, documents, monkeypatch):
    with open(vocabulary("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    whole = sorted(tuple(r) for r in token_counts.per_document(documents, definition).collect())
    monkeypatch.setattr(frequent.at_least, "__defaults__", (10,))
    assert sorted(tuple(r) for r in token_counts.per_document(documents, definition).collect()) == whole
