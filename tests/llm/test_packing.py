import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from starloom.llm import packing
from starloom.llm.registry import QUERIES, _tokenizer


def padding(size, width):
    return 0 if size & (size - 1) == 0 else width - size


def check_plan(histogram, width):
    """Every id of every piece is placed once, sequences have no holes, and what the plan holds stays small."""
    plan = packing.Plan(histogram, width)
    filled = defaultdict(list)
    for length, n in histogram.items():
        places = packing.Places(np.array([r for r in plan.rows if r[0] == length], np.int64))
        for rank in range(n):
            at = 0
            for s, z, seq, offset in places.find(rank):
                assert s == at and z > 0
                at += z
                filled[seq].append((offset, z))
            assert at == length
    assert sorted(filled) == list(range(plan.sequences))
    waste = 0
    for spans in filled.values():
        at = 0
        for offset, z in sorted(spans):
            assert offset == at
            at += z
        assert at <= width
        waste += padding(at, width)
    total = sum(k * n for k, n in histogram.items())
    assert waste == 0 and plan.sequences <= total // width + width.bit_length()
    return plan


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    rnd = random.Random(seed)
    width = rnd.choice([1, 2, 8, 16, 64, 128])
    lengths = rnd.sample(range(1, width + 1), rnd.randint(1, min(width, 20)))
    check_plan({k: rnd.choice([1, 2, 3, 7, 50, 400]) for k in lengths}, width)


def test_plan_shapes():
    check_plan({}, 64)
    check_plan({64: 5}, 64)
    check_plan({33: 1000}, 64)  # no two fit together
    check_plan({63: 1000}, 64)
    check_plan({1: 5000}, 64)
    check_plan({40: 700, 20: 3, 4: 5000}, 64)
    rnd = random.Random(1)
    shape = {k: rnd.randint(1, 1000) for k in range(1, 2049)}
    small, large = packing.Plan(shape), packing.Plan({k: n * 10_007 for k, n in shape.items()})
    assert len(small.rows) < 50_000 and len(large.rows) < 2_000_000  # bounded, not by counts


def test_longest_first_shortest_pack():
    """7 and 6 open packs, 3 goes to the emptier one, 2 to the pack of room left."""
    plan = packing.Plan({7: 1, 6: 1, 3: 1, 2: 1, 1: 2}, 10)
    where = {r[0]: r[5] for r in plan.rows if r[0] in (7, 6, 3, 2)}
    assert where[3] == where[6] and where[2] == where[7]


AWKWARD = ["", " ", "  ", "a", " a", "a ", "don't  stop", "it's\n\nfine", "x\t\ty \n z", "naïve,été.\nÜber", "你好 世界。", "emoji 😀😀 ok", "a b c", "a\x1cb \x1f",
           "½ ² Ⅷ 3.14", "<|endoftext|> a<|endoftext|>b", "word." * 300, "\n" * 50 + "x", "end \n", "ā̊ł ŵord's", "'s 's's", "tab᠎here", "Ω!!! ??", "a_b-c d__e", "​zero"]


def test_ids_are_the_tokenizers(monkeypatch):
    from tokenizers import Tokenizer
    t, ids = Tokenizer.from_file(_tokenizer()), packing.Ids(_tokenizer())
    rnd = random.Random(3)
    alphabet = list("ab Z.,'s\n\t  19_-éßā你😀½ \x1c\x85 \"!)(")
    texts = AWKWARD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(3000)]
    monkeypatch.setattr(packing, "CACHED", 500)
    monkeypatch.setattr(packing, "SEGMENT", 7)
    for k in range(0, len(texts), 50):
        for x, got in zip(texts[k:k + 50], ids.texts(texts[k:k + 50])):
            assert np.frombuffer(got, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)
            assert ids.long_text(x) == got


def check_rows(docs, got, width=2048):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(_tokenizer())
    want = Counter()
    ids = {}
    for d, x in docs:
        one = (*t.encode(x or "", add_special_tokens=False).ids, 1)
        want[d, len(one)] += 1
        ids.setdefault(d, set()).add(one)
    sequences, starts = defaultdict(list), Counter()
    for r in got:
        assert any(zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
                   and len(x) == r["doc_tokens"] for x in ids[r["doc_id"]])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        starts[r["doc_id"], r["doc_tokens"], r["start"], r["length"]] += 1
    spans = defaultdict(list)
    for (d, n, s, z), k in starts.items():
        spans[d, n].append((s, z, k))
    for (d, n), k in want.items():  # k rows of this document: every id is in k pieces
        covered = np.zeros(n, int)
        for s, z, m in spans[d, n]:
            covered[s:s + z] += m
        assert (covered == k).all()
    assert sum(r["length"] for r in got) == sum(n * k for (_, n), k in want.items())
    for s in sequences.values():
        at = 0
        for offset, z in sorted(s):
            assert offset == at
            at += z
        assert padding(at, width) == 0 and at <= width
    assert sorted(sequences) == list(range(len(sequences)))


def test_pack(spark, edge_dir, tmp_path):
    docs = [tuple(r.values()) for r in pq.read_table(f"{edge_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    check_rows(docs, QUERIES["op11_packing"](spark, edge_dir).collect())
    docs = [(i, x) for i, x in enumerate(AWKWARD)] + [(900, "same text here")] * 400 + [(i, None) for i in range(1000, 1300)]
    ids, texts = zip(*docs)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "ids": pa.array([1] * len(ids)),
                             "task": pa.array(["x"] * len(ids))}), tmp_path / "documents.parquet")
    check_rows(docs, QUERIES["op11_packing"](spark, str(tmp_path)).collect())


def test_empty(spark, empty_dir):
    assert QUERIES["op11_packing"](spark, empty_dir).count() == 0
