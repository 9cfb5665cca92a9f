import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewind.llm.text import Hasher, Words, gram_starts, grams, slices

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab É\n\t\v\f\r\x1c\u00a0Z", max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words(texts):
    words = Words(pa.array(texts, pa.string()), lower=True)
    want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for t in texts]
    got = [[words.bytes_of(i) for i in range(a, b)] for a, b in zip(words.first, words.first[1:])]
    assert got == want
    hashes = Hasher()(words.data, words.start, words.end)
    flat = [w for own in want for w in own]
    assert len(set(hashes.tolist())) == len(set(flat))
    inside = gram_starts(words.first, 3, len(words))
    want_grams = [tuple(own[i : i + 3]) for own in want for i in range(len(own) - 2)]
    assert len(set(grams(hashes, 3)[inside].tolist())) == len(set(want_grams)) and inside.sum() == len(want_grams)


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 100, 1, 1, 1)] + [None])], ["text"])
    parts = list(slices(iter([batch]), limit=8))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert all(p.num_rows for p in parts) and len(parts) > 2


def test_words_of_a_sliced_array():
    whole = pa.array(["one two", "three", "", None, "four five six"])
    assert Words(whole.slice(1, 4)).count.tolist() == [1, 0, 0, 3]
    assert np.array_equal(Words(whole.slice(4)).count, [3])
