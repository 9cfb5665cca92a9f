"""The language model: training over all rows, probabilities against a plain computation, and a size that grows."""

import math

import numpy as np
import pyarrow as pa

from tradewind.llm import language_model
from tradewind.llm.frequent import Lookup
from tradewind.llm.text import Hasher, mixed


def test_every_round_sees_all_training_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i % 9} of some words") for i in range(70)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(language_model, "one_round", lambda docs, model: (seen.append(docs.count()), model)[1])
    rows = language_model.scored(docs)
    assert seen == [rows.where("not held_out").count()] * language_model.ROUNDS


def trained(texts, width=4, rows=64, rounds=3):
    """A small model trained in place, with its tokens."""
    token, first, _ = language_model.tokens(pa.array(texts), Hasher())
    names, counts = np.unique(token.view(np.int64), return_counts=True)
    ranked = names[np.argsort(-counts, kind="stable")][: width * (width - 1)]
    order = np.argsort(ranked)
    bias = np.zeros((width + 1, width), np.float32)
    model = language_model.Model(ranked[order], np.arange(len(ranked))[order], bias, 0.0, np.zeros((rows, width), np.float32), np.zeros((rows, width), np.float32))
    spread = [np.zeros(rows, np.float32) for _ in range(2)]
    for _ in range(rounds):
        language_model.train_on(model, spread, token, first)
    return model, token, first


TEXTS = ["a b c a b d", "a b c", "b a d a b c a b c", "", "e f g h i j k l a b", "a a a b"]


def test_probabilities_against_a_plain_computation():
    """Scores of classes and places added up feature by feature; the probabilities of all tokens sum to one."""
    model, token, first = trained(TEXTS)
    natural, outside = language_model.log_probability(model, token, first)
    place, width = model.places(token), model.width
    found = language_model.features(token, first)
    for i in range(len(token)):
        own = [int(f[i]) for f in found]
        scores = [float(model.bias[0][c]) + sum(float(model.class_rows[(f >> 40) & 63][c]) for f in own) for c in range(width)]
        total = math.log(sum(map(math.exp, scores)))
        everything = math.exp(scores[-1] - total)
        for c in range(width - 1):
            turn = np.array([(f + c * 0xC2B2AE3D27D4EB4F) % (1 << 64) for f in own], np.uint64)
            rows = [(int(f) >> 40) & 63 for f in mixed(turn)]
            inner = [float(model.bias[1 + c][p]) + sum(float(model.token_rows[r][p]) for r in rows) for p in range(width)]
            within = math.log(sum(map(math.exp, inner)))
            for p in range(width):
                value = scores[c] - total + inner[p] - within
                everything += math.exp(value)
                if place[i] == c * width + p:
                    assert abs(natural[i] - value) < 1e-4 and not outside[i]
        assert abs(everything - 1) < 1e-5
        if outside[i]:
            assert abs(natural[i] - (scores[-1] - total)) < 1e-4


def test_training_lowers_the_loss():
    before, token, first = trained(TEXTS, rounds=0)
    after, _, _ = trained(TEXTS, rounds=30)
    assert language_model.log_probability(after, token, first)[0].sum() > language_model.log_probability(before, token, first)[0].sum() + 5


def test_equal_rows_are_added_up_in_large_tables():
    """Row numbers beyond 16 bits: the step equals one with gradients added up by hand."""
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 1 << 18, 50).repeat(3)
    rng.shuffle(rows)
    gradient = rng.standard_normal((len(rows), 4)).astype(np.float32)
    weights, spread = np.zeros((1 << 18, 4), np.float32), np.zeros(1 << 18, np.float32)
    language_model._descend(weights, spread, rows, gradient)
    for r in set(rows.tolist()):
        total = gradient[rows == r].sum(0)
        grown = (total**2).sum() / 4
        assert np.allclose(weights[r], -total * language_model.STEP / math.sqrt(grown + 1e-3), atol=1e-5)


def test_the_model_grows_with_the_corpus(spark):
    small, large = language_model.sizes(10**7), language_model.sizes(10**9)
    assert large[0] > 2 * small[0] and large[1] >= 8 * small[1]
    words = spark.createDataFrame([(i, 10_000 - i) for i in range(5000)], "key long, n long")
    model = language_model.start_model(words, 10, 10**8)
    assert model.width == round(10**2 / 3) and len(model.keys) == model.width * (model.width - 1)


def test_gradients_of_equal_rows_are_added_up():
    """Rows that occur once, a few times and many times in a step: sums as by hand."""
    rng = np.random.default_rng(5)
    for most in (1 << 10, 1 << 18):
        numbers = rng.integers(0, most, 60)
        rows = rng.permutation(numbers.repeat(rng.integers(1, 5 * language_model.LIGHT, 60)))
        values = rng.standard_normal((len(rows), 3))
        found, total = language_model._added(values, rows, most)
        assert sorted(found.tolist()) == np.unique(rows).tolist()
        for r, sums in zip(found, total):
            assert np.allclose(sums, values[rows == r].sum(0))


def test_scores_far_from_zero():
    """Exponentials that would leave the range of the numbers: shares and logs as by a plain computation."""
    x = np.array([[0, 1, -np.inf], [200, 199, 0], [-300, -301, -302], [-np.inf, -90, -91]], np.float32)
    p, total, log = language_model.exponentials(x)
    for row, parts, size, value in zip(x.astype(float), p, total, log):
        want = np.log(np.exp(row - row.max()).sum()) + row.max()
        assert abs(value - want) < 1e-4 and np.allclose(parts / size, np.exp(row - want), atol=1e-6)


def test_lookups_step_to_the_key(monkeypatch):
    """Hashed keys are found from their first bits, without a search over all keys."""
    rng = np.random.default_rng(7)
    searched = np.searchsorted
    for kind in ("hashes", "few", "none", "crowded"):
        size = {"hashes": 100_000, "few": 3, "none": 0}.get(kind, 500)
        keys = np.arange(size) if kind == "crowded" else np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, size))
        asked = np.concatenate([keys, keys + 1, np.array([-(1 << 63), (1 << 63) - 1, 0])])
        lookup = Lookup(keys, keys % 97 + 1)
        if kind != "crowded":
            monkeypatch.setattr(np, "searchsorted", None)
        found, value = lookup(asked)
        monkeypatch.setattr(np, "searchsorted", searched)
        assert (found == np.isin(asked, keys)).all() and (value == np.where(found, asked % 97 + 1, 0)).all()
