"""Large sets of near copies: same components as brute force, without a row per pair of class and group."""

import random

import pytest

from starloom.llm import jaccard_join as J


def near_copies(n, n_words, edits, seed=5):
    """Copies of one text with up to ``edits`` words replaced each."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(n_words)]
    out = []
    for k in range(n):
        words = list(base)
        for e in range(rnd.randint(1, edits)):
            words[rnd.randrange(n_words)] = f"x{k}_{e}"
        out.append(" ".join(words))
    return out


def brute(texts, k, num, den):
    sets = [{tuple(w[i:i + k]) for i in range(len(w) - k + 1)} for w in map(str.split, texts)]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if den * common >= num * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(sets))}


def others(n, seed=9):
    """Groups of texts around the limit of a link, some with a passage of their neighbours."""
    rnd = random.Random(seed)
    out = []
    while len(out) < n:
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(3, 90))]
        for _ in range(rnd.randint(1, 6)):
            words = list(base)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = f"w{rnd.randrange(400)}"
            out.append(" ".join(words))
    return out[:n]


@pytest.fixture
def made(monkeypatch):
    """Rows of the stored tables by name."""
    rows, store = {}, J.store

    def counted(df, name):
        out = store(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(J, "store", counted)
    return rows


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in J.link_components(df, 3, 90, 100).collect()}


def test_rows_grow_with_the_copies_not_with_their_pairs(spark, made):
    texts = near_copies(400, 120, 3)
    assert found(spark, texts) == brute(texts, 3, 90, 100)
    assert made["jac-common"] <= 400, made


@pytest.mark.parametrize("near", [2, 256])
def test_components_in_small_blocks(spark, monkeypatch, near):
    monkeypatch.setattr(J, "NEAR", near)
    monkeypatch.setattr(J, "MEMBERS", 5)
    monkeypatch.setattr(J, "VISITORS", 3)
    texts = near_copies(60, 80, 3) + others(240)
    random.Random(2).shuffle(texts)
    assert found(spark, texts) == brute(texts, 3, 90, 100)
