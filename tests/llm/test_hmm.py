from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import hmm_lm


def model(symbols: int = 9) -> hmm_lm.Hmm:
    draw = np.random.default_rng(3)
    m = hmm_lm.Hmm.first(draw.uniform(0.1, 1, symbols), 3)
    m.start = np.array([0.7, 0.2, 0.1])
    return m


def test_score_is_the_plain_forward_recursion():
    m, draw = model(), np.random.default_rng(4)
    length = np.array([1, 7, 200, 3])
    symbols = draw.integers(0, 9, length.sum())
    want, at = [], 0
    for n in length:
        a = [m.start[i] * m.emit[symbols[at], i] for i in range(3)]
        for s in symbols[at + 1:at + n]:
            a = [sum(a[i] * m.move[i, j] for i in range(3)) * m.emit[s, j] for j in range(3)]
        want.append(np.log10(sum(a)))
        at += n
    assert m.log10(symbols, length) == pytest.approx(want)


def test_only_text_starts_count_as_starts():
    batch = pa.RecordBatch.from_arrays([pa.array([hmm_lm.squeeze(np.arange(n)) for n in (200, 5, 64)], pa.binary()), pa.array([200, 5, 64])],
                                       names=["symbols", "n_tokens"])
    pieces, length, first = next(hmm_lm._pieces(batch))
    assert length.tolist() == [64, 64, 64, 8, 5, 64] and first.tolist() == [True, False, False, False, True, True]
    counts = model(200).expect(pieces, length, first)
    assert counts[:3].sum() == pytest.approx(3)
    assert counts[3:12].sum() == pytest.approx((length - 1).sum()) and counts[12:].sum() == pytest.approx(length.sum())


def test_frequent_words_of_a_uniform_vocabulary(spark):
    counts = spark.range(5000).select(F.xxhash64("id").alias("h"), F.when(F.col("id") < 10, 90).otherwise(7).cast("long").alias("c"))
    for known in (5, 100, 4000, 6000):
        got = hmm_lm.frequent(counts, known)
        assert 0.9 * min(known, 5000) - 2 <= len(got) <= known and got
        assert sum(r["c"] == 90 for r in got) == min(10, len(got))


def small_corpus() -> list[tuple[int, str, bool]]:
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(draw.choice(words, n, p=np.arange(30, 0, -1) / 465))
    return [(i, text(int(draw.integers(0, 150))), i % 5 == 0) for i in range(40)] + [(40, "w1 never seen Never w29", True), (41, None, False)]


def test_counts_and_scores_are_those_of_a_full_table(spark, monkeypatch):
    """Expected counts of the last turn, word by word, and the scores, against plain recursions over all words."""
    monkeypatch.setattr(hmm_lm, "KNOWN", 8)
    monkeypatch.setattr(hmm_lm, "FREE", 4)
    docs = small_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean")
    caught, plain_train, plain_updated = {}, hmm_lm.train, hmm_lm.Hmm.updated

    def updated(self, counts):
        caught["before"] = self  # at last: the model that the last turn's expected counts come from
        return plain_updated(self, counts)

    def train(encoded, unigram):
        caught["after"], caught["total"], caught["untied"] = out = plain_train(encoded, unigram)
        caught["encoded"] = encoded
        return out
    monkeypatch.setattr(hmm_lm.Hmm, "updated", updated)
    monkeypatch.setattr(hmm_lm, "train", train)
    got = {r["doc_id"]: r for r in hmm_lm.score(df).collect()}
    tokens = {d: [*(t or "").lower().split(), None] for d, t, _ in docs}
    c = Counter(w for d, _, held in docs if not held for w in tokens[d])
    symbols = {r["doc_id"]: hmm_lm.expand(pa.scalar(bytes(r["symbols"]), pa.binary()), r["n_tokens"]) for r in caught["encoded"].collect()}
    before, after, k = caught["before"], caught["after"], hmm_lm.STATES
    other = len(before.emit) - 1
    number = {w: min(s, other) for d in tokens for w, s in zip(tokens[d], symbols[d])}
    tied = [w for w in c if number[w] == other]
    assert len(tied) >= 20 and number[None] == other - 1

    expected = {w: np.zeros(k) for w in c}
    for d, _, held in docs:
        if held:
            continue
        later = before.start @ np.linalg.matrix_power(before.move, hmm_lm.PIECE)
        for a in range(0, len(tokens[d]), hmm_lm.PIECE):
            piece = tokens[d][a:a + hmm_lm.PIECE]
            e = [before.emit[number[w]] for w in piece]
            alpha = [(before.start if a == 0 else later / later.sum()) * e[0]]
            for x in e[1:]:
                alpha.append((alpha[-1] @ before.move) * x)
            beta = [np.ones(k)]
            for x in reversed(e[1:]):
                beta.insert(0, before.move @ (x * beta[0]))
            for w, x, y in zip(piece, alpha, beta):
                expected[w] += x * y / (x @ y)
    full = np.zeros_like(before.emit)
    for w in c:
        full[number[w]] += expected[w]
    h = dict(zip(tied, hmm_lm.Words(pa.array(tied), lower=True).hashes().view(np.int64).tolist()))
    rows = {r["h"]: r for r in caught["untied"].collect()}
    assert set(rows) == set(h.values()) and all(rows[h[w]]["c"] == c[w] for w in tied)
    for w in tied:  # shares cut to a 4095th
        held = hmm_lm.by_state(np.array([c[w]]), np.array([rows[h[w]]["q"]]), k)[0]
        assert held == pytest.approx(expected[w], abs=c[w] * k / hmm_lm.PARTS) and held.sum() == pytest.approx(c[w])
        expected[w] = held
    total = sum(expected[w] for w in tied)
    assert caught["total"] == pytest.approx(total)
    whole = plain_updated(before, np.concatenate([np.ones(k), np.ones(k * k), full.ravel()]))
    assert np.delete(after.emit, other, 0) == pytest.approx(np.delete(whole.emit, other, 0), rel=1e-4)

    mass = sum(c[w] + hmm_lm.ADD for w in tied) + hmm_lm.ADD
    emit = lambda w: after.emit[number[w]] if w in c and number[w] != other else after.emit[other] * (
        expected.get(w, np.zeros(k)) + hmm_lm.PRIOR * (c[w] + hmm_lm.ADD)) / (total + hmm_lm.PRIOR * mass)
    every = sum(emit(w) for w in c) + emit("never seen word")
    assert every == pytest.approx(np.ones(k))  # each state's probabilities add up to one
    for d, _, _ in docs:
        a, log = after.start, 0.0
        for t, w in enumerate(tokens[d]):
            a = (a if t == 0 else a @ after.move) * emit(w)
            log += np.log10(a.sum())
            a = a / a.sum()
        assert got[d]["score"] == pytest.approx(log, rel=1e-5), d
        assert got[d]["n_known"] == sum(c[w] > 0 for w in tokens[d])


def test_sums_are_given_out_when_many():
    draw, sums, parts = np.random.default_rng(2), hmm_lm.Sums(20), []
    h, g = draw.integers(0, 60, 500), draw.random((500, 3))
    for a in range(0, 500, 25):
        parts.append(sums.add(h[a:a + 25], g[a:a + 25]))
    parts = [p for p in [*parts, sums.rest()] if p is not None]
    assert len(parts) > 1
    got = hmm_lm.tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), 60)
    assert got == pytest.approx(hmm_lm.tally(h, g, 60))
