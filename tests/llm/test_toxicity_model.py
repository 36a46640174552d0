"""Toxicity against plain Python: noisy-or scores, the fit's first step against numeric slopes, offsets of offending sentences."""

import functools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import toxicity
from starloom.llm._tokens import Words

WORD = re.compile(r"[0-9a-z\u0080-\U0010FFFF]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sentences(text):
    """(start, end, words) in characters of the sentences that hold a word: cut after . ! ? and line feeds."""
    out, begin = [], 0
    for end in [m.end() for m in re.finditer(r"[.!?\n]", text or "")] + [len(text or "")]:
        found = list(WORD.finditer((text or "").translate(LOW), begin, end))
        if found:
            out.append((found[0].start(), found[-1].end(), [m[0] for m in found]))
        begin = end
    return out


def feature(raw: bytes, size: int = 0) -> int:
    h = Words(pa.array([raw], pa.binary()).view(pa.string())).hashes()[0] ^ np.uint64(size)
    return int(h & np.uint64(toxicity.FEATURES - 1))


@functools.cache
def features(word):
    raw = word.encode()
    return [feature(raw)] + [feature(raw[:n], n) for n in toxicity.PREFIXES if len(raw) > n]


def logit(words, weights, bias):
    return bias + sum(weights[f] for w in words for f in features(w))


def plain_score(text, weights, bias):
    clean = 1 / (1 + math.exp(bias))  # the empty sentence
    for _, _, words in sentences(text):
        clean *= 1 / (1 + math.exp(logit(words, weights, bias)))
    return 1 - clean


def corpus():
    rnd = random.Random(4)
    words = [f"word{i}" for i in range(12)] + ["the", "and", "of"]
    docs, toxic = [], []
    for i in range(80):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 5))) + rnd.choice([".", "!", "\n", "? "]) for _ in range(rnd.randint(1, 5))]
        if i % 2:
            parts.insert(rnd.randrange(len(parts) + 1), f"You {rnd.choice(['vilespeech', 'vilespeaking', 'vile'])} thing!")
        docs.append(" ".join(parts))
        toxic.append(i % 2)
    return docs, toxic


def test_scores_are_noisy_or_over_sentences(spark):
    rnd, docs = random.Random(8), [*corpus()[0][:30], None, "", " .!? ", "A", "?!a.b", "x" * 40]
    model = toxicity.Model(np.array([rnd.uniform(-1, 1) for _ in range(toxicity.FEATURES)]), -1.5)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, model).collect()}
    for i, t in enumerate(docs):
        assert got[i] == pytest.approx(plain_score(t, model.weights, model.bias), abs=1e-9), t


def test_first_step_goes_along_the_slope_of_the_likelihood():
    docs, toxic = corpus()
    l2 = 0.4  # large, so that its share in the slope shows
    before, after = (toxicity.fit(docs, toxic, epochs=n, l2=l2) for n in (0, 1))
    used = np.flatnonzero(before.weights)
    assert 4 <= len(used) < 60

    def gain(weights, bias):
        p = [plain_score(t, weights, bias) for t in docs]
        return sum(math.log(x if y else 1 - x) for x, y in zip(p, toxic)) / len(docs) - l2 / 20 * sum(weights[f] ** 2 for f in used)

    def slope(f):
        up, down, step = before.weights.copy(), before.weights.copy(), 1e-5
        if f is not None:
            up[f] += step
            down[f] -= step
        b = step if f is None else 0
        return (gain(up, before.bias + b) - gain(down, before.bias - b)) / (2 * step)

    for f in [None, *used]:  # the first step of this ascent has the same length everywhere and the slope's sign
        g = slope(f)
        moved = after.bias - before.bias if f is None else after.weights[f] - before.weights[f]
        assert abs(g) < 1e-6 or moved == pytest.approx(0.15 * math.copysign(1, g), rel=1e-2), (f, g, moved)
    assert not np.any(np.delete(after.weights, used))


def test_offending_sentences_are_where_they_stand(spark):
    model = toxicity.fit(*corpus())
    docs = ["Größe — ünd so. You vilespeech thing! The end.", "vile\nword1 word2. «You vilespeaking thing»? é", "word1. word2 the and of.", "", None,
            "word1 the. " * 3000 + "You vilespeech thing! word3." + " the end." * 500]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r["doc_id"]: r["offending"] for r in toxicity.score(df, model).collect()}
    for i, t in enumerate(docs):
        want = []
        for a, b, words in sentences(t):
            p = 1 / (1 + math.exp(-logit(words, model.weights, model.bias)))
            if p >= 0.5:
                want.append((a, b, round(p, 6)))
        assert [(o["start"], o["end"], round(o["score"], 6)) for o in got[i]] == want
        assert all("vile" in t[a:b] for a, b, _ in want)
    assert len(got[0]) == len(got[5]) == 1 and not got[2] and not got[3] and not got[4]  # the same sentence in both
