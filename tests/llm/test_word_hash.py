"""Words that hashes linear in their bytes take for equal: Thue-Morse sequences and their complements."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from starloom.llm._tokens import Words, grams
from starloom.llm.registry import QUERIES


def twins(bits, a="a", b="b"):
    one = "".join((a, b)[bin(i).count("1") % 2] for i in range(1 << bits))
    return one, one.translate(str.maketrans({a: b, b: a}))


def write(path, **tables):
    for name, cols in tables.items():
        pq.write_table(pa.table(cols), path / f"{name}.parquet")
    return str(path)


def docs(texts):
    return {"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())}


def test_hashes_differ():
    rnd = random.Random(1)
    words = {w for bits in range(1, 13) for w in twins(bits)} | {w for w in twins(10, "é", "ü")}
    words |= {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 40))) for _ in range(20_000)}
    words |= {"x" * n for n in range(1, 3000)} | {"\x00" * n for n in range(1, 30)} | {"x" * 8 * n + "y" for n in range(100)}
    words = sorted(words)
    w = Words(pa.array([" ".join(words)]))
    assert len(w.start) == len(words)
    for which in (0, 1):
        assert len(np.unique(w.hashes(which))) == len(words)
    assert not (w.hashes(0) == w.hashes(1)).any()
    for k in (2, 13, 40, 1024):  # windows of two words in the same patterns
        one, other = (" ".join(x) for x in twins(k.bit_length(), "p", "q"))
        g = [grams(Words(pa.array([x])).hashes(), k)[0] for x in (one, other)]
        assert g[0] != g[1]


def test_hash_is_the_same_anywhere():
    a = Words(pa.array(["longer than eight bytes été", None, "é" * 50 + " x"]))
    b = Words(pa.array(["x", "été longer eight than bytes " + "é" * 50]))
    got = {a.data[s:e].tobytes(): h for s, e, h in zip(a.start, a.end, a.hashes())}
    for s, e, h in zip(b.start, b.end, b.hashes()):
        assert got[b.data[s:e].tobytes()] == h


@pytest.mark.parametrize("bits", [9, 10, 12])
def test_substring_dedup(spark, tmp_path, bits):
    one, other = twins(bits)
    rest = " ".join(f"w{i}" for i in range(12))
    got = {r["doc_id"]: r for r in QUERIES["op1_substring_dedup"](spark, write(tmp_path, documents=docs([f"{one} {rest}", f"{other} {rest}", f"{one} {rest}"]))).collect()}
    assert [got[i]["n_removed"] for i in range(3)] == [0, 0, 13]
    assert got[1]["kept_sha256"] == hashlib.sha256(f"{other} {rest}".encode()).hexdigest()


@pytest.mark.parametrize("bits", [9, 10, 12])
def test_jaccard(spark, tmp_path, bits):
    one, other = twins(bits)
    got = {r["doc_id"]: r for r in QUERIES["op2_jaccard_join"](spark, write(tmp_path, documents=docs([one, other, one]))).collect()}
    assert [got[i]["component_id"] for i in range(3)] == [0, 1, 0]


def test_language_model(spark, tmp_path):
    one, other = twins(10)
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 != 0][:30]
    held = next(i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0)
    texts = [f"plain words {one}"] * 30 + [f"plain {other} words"]
    table = {"doc_id": pa.array([*ids, held], pa.int64()), "text": pa.array(texts)}
    got = {r["doc_id"]: r for r in QUERIES["op4_hmm_lm"](spark, write(tmp_path, documents=table)).collect()}
    assert (got[held]["n_tokens"], got[held]["n_known"]) == (4, 3)


def test_decontaminate(spark, tmp_path):
    one, other = twins(11)
    bench = {"item_id": pa.array([1, 2], pa.int64()), "text": pa.array([f"a b c d {one}", f"b c d e {one}"])}
    sf = write(tmp_path, documents=docs([f"x a b c d {other} y", f"x b c d e {one}"]), benchmark=bench)
    assert [(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontaminate"](spark, sf).collect()] == [(1, 2)]
