"""What a task of the substring dedup holds at once, whatever its batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from starloom.llm import substring_dedup as S


def batch(n_docs, n_words):
    rnd = np.random.default_rng(3)
    vocabulary = np.array([f"w{i}" for i in range(5_000)])
    texts = [" ".join(vocabulary[rnd.integers(0, 5_000, n_words)]) for _ in range(n_docs)]
    return pa.RecordBatch.from_arrays([pa.array(texts), pa.array(np.arange(n_docs) % 4, pa.int32())], names=["text", "g"])


def entries(rows):
    """(bucket, group, hash) -> a block starts there."""
    out = {}
    for b in rows:
        for bucket, gs, ns, low, aligned, _ in zip(*(c.to_pylist() for c in b.columns)):
            low, g = np.frombuffer(low, np.uint32), np.repeat(np.frombuffer(gs, np.int32), np.frombuffer(ns, np.int32))
            for k, a in zip(zip(g.tolist(), low.tolist()), np.unpackbits(np.frombuffer(aligned, np.uint8), count=len(low)).tolist()):
                out[bucket, *k] = out.get((bucket, *k), 0) | a
    return out


def test_windows_in_memory_are_bounded():
    whole = batch(2_000, 2_000)  # 4 million windows, 23 MB of text
    tracemalloc.start()
    n = sum(b.num_rows for b in S._send_blocks(7, 64)(iter([whole])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n and peak < 150e6, peak


def test_chunks_do_not_change_what_is_sent(monkeypatch):
    part = batch(40, 300)
    want = entries(S._send_blocks(7, 8)(iter([part])))
    monkeypatch.setattr(S, "CHUNK_WINDOWS", 500)
    got = list(S._send_blocks(7, 8)(iter([part.slice(0, 15), part.slice(15)])))
    assert len(got) > 1 and entries(got) == want
