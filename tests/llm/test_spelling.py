import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from starloom.llm import spelling
from starloom.llm.registry import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def counts(docs):
    c = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def brute(c):
    """Near words by making every string at one edit from each word."""
    out = []
    form = {}
    near = defaultdict(set)
    letters = sorted(set("".join(c)))
    for w in c:
        for i in range(len(w) + 1):
            made = [w[:i] + x + w[i:] for x in letters]
            if i < len(w):
                made += [w[:i] + w[i + 1:]] + [w[:i] + x + w[i + 1:] for x in letters]
            near[w].update(v for v in made if v in c and v != w)
    for w, n in c.items():
        best = min(near[w], key=lambda v: (-c[v], v), default=None)
        if best is not None and c[best] >= 10 * n:
            form[w] = best
    for w, n in c.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), c[form[w]] if w in form else None))
    return out


def make(rnd, n_words, docs):
    """Words that vary few stems by one or two edits, with counts over three orders of magnitude."""
    stems = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(7, 12))) for _ in range(max(1, n_words // 15))]
    words = []
    for _ in range(n_words):
        w = rnd.choice(stems)
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice([w[:i] + rnd.choice("abcéÿ") + w[i:], w[:i] + w[i + 1:], w[:i] + rnd.choice("abcé") + w[i + 1:]])
        words += [w] * rnd.choice([2, 2, 3, 20, 30, 300])
    rnd.shuffle(words)
    return [(k if k % 7 else None, rnd.choice([" ", ", ", "\n3", "_"]).join(w.upper() if rnd.random() < .1 else w for w in words[k::docs]))
            for k in range(docs)]


def write(path, docs):
    ids, texts = zip(*docs) if docs else ((), ())
    n = len(ids)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "word": pa.array([1] * n, pa.int64()),
                             "n": pa.array([1] * n, pa.int64())}), path / "documents.parquet")
    return str(path)


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 8), (3, 2)])
def test_forms(spark, tmp_path, monkeypatch, seed, block):
    """Small blocks split the keys: words ask several parts."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    docs = make(random.Random(seed), 300, 20) + [(500, None), (501, ""), (502, "short wor\nds"), (503, "x" * 9000 + " " + "x" * 9001), (503, "x" * 9000 + " " + "x" * 9001)]
    got = [tuple(r) for r in QUERIES["op12_spelling"](spark, write(tmp_path, docs)).collect()]
    want = brute(counts(docs[:-2]))
    long = [("x" * 9000, None, "x" * 9000, 2, 1, None), ("x" * 9001, None, "x" * 9001, 2, 1, None)]
    assert {w for w, *_ in long} <= {r[0] for r in got}
    assert sorted(got, key=repr) == sorted(want + long, key=repr)
    assert len({r[2] for r in got}) < len(got)


def test_slice_against_brute():
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice("abÿ") for _ in range(8)) for _ in range(700)})
    piece = spelling.Slice([w.encode("latin-1") for w in words], 8)
    import numpy as np
    for m in (8, 7):
        asked = ["".join(rnd.choice("abÿz") for _ in range(m)) for _ in range(200)]
        codes = np.frombuffer("".join(asked).encode("latin-1"), np.uint8).reshape(-1, m)
        q, w = spelling.pairs(piece.replaced(codes) if m == 8 else piece.additional(codes))
        got = set(zip(q.tolist(), w.tolist()))
        want = {(i, k) for i, x in enumerate(asked) for k, y in enumerate(words)
                if (sum(a != b for a, b in zip(x, y)) == 1 if m == 8 else any(y[:p] + y[p + 1:] == x for p in range(8)))}
        assert got == want and got


def test_edge_and_empty(spark, edge_dir, empty_dir):
    assert QUERIES["op12_spelling"](spark, empty_dir).count() == 0
    docs = [tuple(r.values()) for r in pq.read_table(f"{edge_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = [tuple(r) for r in QUERIES["op12_spelling"](spark, edge_dir).collect()]
    assert sorted(got, key=repr) == sorted(brute(counts(docs)), key=repr)
