"""Substring dedup: repeated word sequences of at least ``width`` words, found with fixed-block anchors.

Every text is an index of non-overlapping blocks of (width + 1) / 2 words and is probed with every rolling window
of that length.  A sequence of ``width`` words holds a whole block wherever it starts, so a sequence
that two documents share shows as a block of one that a rolling window of the other hits.  Hits are
extended word by word on both sides: each window of ``width`` words around a hit is compared with those of all
other hits, and neighbouring repeated windows join to maximal exact repeats.

A word goes when a window that covers it also starts in a document with a smaller doc_id (judged on the
input), so the first document keeps its words.

How it runs: blocks and rolling windows travel as 4-byte hashes packed by hash bucket, once per bucket and group of
documents; buckets answer with the hashes that are anchors.  Documents meet the anchors of their group, and those
with candidates send 8-byte window hashes with their smallest document to buckets, which answer with a bit per
window.  A passage that a third of all documents share costs one entry per group of documents, and no pair of
documents is ever formed.  False hits of short hashes only add candidates; windows are told apart by 64 bits
and their bucket, which comes from an independent hash.

Null texts have no words.  Rows without a doc_id keep everything and are no reference.  Rows with equal doc_id
are not smaller than each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._tables import doc_bytes, n_groups, scratch_table
from ._tokens import SLICE_BYTES, U, Words, grams, pack, slices, starts_window

GROUP_BYTES = 8 << 20
#: Windows that a task holds, about (a slice of text more); at the most some 60 bytes each are in memory at once.
CHUNK_WINDOWS = 1_000_000

#: finish(part, words, removed): output rows of a part of the input, given which words go.
Finish = Callable[[pa.Table, Words, np.ndarray], pa.RecordBatch]


def _first_of_runs(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _block_key(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper, short hash in the lower half."""
    return ((h >> U(32)) % U(buckets)) << U(32) | h & U(0xFFFFFFFF)


def _send_blocks(block: int, groups: int):
    """Pack a task's rolling windows: a row per bucket with groups, hashes and two flags."""
    def rows(g: np.ndarray, key: np.ndarray, doc: np.ndarray, aligned: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((key.astype(np.uint32), g, (key >> U(32)).astype(np.uint32)))
        g, key, doc, aligned = g[order], key[order], doc[order], aligned[order]
        del order
        new = np.flatnonzero(_first_of_runs(key, g))
        other = np.zeros(len(key), bool)
        other[1:] = (doc[1:] != doc[:-1]) & (key[1:] == key[:-1]) & (g[1:] == g[:-1])
        aligned = np.logical_or.reduceat(aligned, new) if len(new) else aligned
        several = np.logical_or.reduceat(other, new) if len(new) else other
        del doc, other
        g, key = g[new], key[new]
        bucket = (key >> U(32)).astype(np.int64)
        edge = np.append(np.flatnonzero(_first_of_runs(bucket)), len(bucket))
        cols: list[list] = [[] for _ in range(6)]
        for a, b in zip(edge[:-1], edge[1:]):
            run = np.append(np.flatnonzero(_first_of_runs(g[a:b])), b - a)
            for c, x in zip(cols, (int(bucket[a]), pack(g[a:b][run[:-1]].astype(np.int32)), pack(np.diff(run).astype(np.int32)),
                                   pack((key[a:b] & U(0xFFFFFFFF)).astype(np.uint32)), pack(np.packbits(aligned[a:b])),
                                   pack(np.packbits(several[a:b])))):
                c.append(x)
        kinds = [pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=["bucket", "gs", "ns", "low", "aligned", "several"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], []]
        n = docs = 0

        def chunk() -> pa.RecordBatch:
            whole = []
            for c in held:
                whole.append(np.concatenate(c))
                c.clear()  # its parts are not kept beside the whole
            return rows(*whole)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                w = Words(part.column("text"))
                ok = starts_window(w, block)
                doc = w.doc_of_word()[ok]
                g = part.column("g").to_numpy(zero_copy_only=False)
                for c, x in zip(held, (g[doc], _block_key(grams(w.hashes(), block)[ok], groups), (doc + docs).astype(np.int32),
                                       w.place()[ok] % block == 0)):
                    c.append(x)
                docs += part.num_rows
                n += len(doc)
                if n >= CHUNK_WINDOWS:
                    yield chunk()
                    n = docs = 0
        if n:
            yield chunk()

    return run


SENT = "bucket int, gs binary, ns binary, low binary, aligned binary, several binary"


def _anchors(t: pa.Table) -> pa.Table:
    """Of one bucket: per group, the hashes that are a block of one document and occur in another."""
    low, g, aligned, several = [], [], [], []
    for r in zip(*(t.column(c) for c in ("gs", "ns", "low", "aligned", "several"))):
        gs, ns = np.frombuffer(r[0].as_buffer(), np.int32), np.frombuffer(r[1].as_buffer(), np.int32)
        low.append(np.frombuffer(r[2].as_buffer(), np.uint32))
        g.append(np.repeat(gs, ns))
        for flag, x in ((aligned, r[3]), (several, r[4])):
            flag.append(np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=len(low[-1])).astype(bool))
    low, g, aligned, several = (np.concatenate(x) for x in (low, g, aligned, several))
    order = np.argsort(low, kind="stable")
    low, g = low[order], g[order]
    new = np.flatnonzero(_first_of_runs(low))
    size = np.diff(np.append(new, len(low)))
    anchor = np.logical_or.reduceat(aligned[order], new) & ((size > 1) | np.logical_or.reduceat(several[order], new))
    hit = np.repeat(anchor, size)
    low, g = low[hit], g[hit]
    order = np.lexsort((low, g))
    low, g = low[order], g[order]
    one = _first_of_runs(low, g)
    low, g = low[one], g[one]
    edge = np.append(np.flatnonzero(_first_of_runs(g)), len(g))
    bucket = t.column("bucket")[0].as_py()
    return pa.table({"g": pa.array(g[edge[:-1]], pa.int32()), "bucket": pa.array([bucket] * (len(edge) - 1), pa.int32()),
                     "low": pa.array([pack(low[a:b]) for a, b in zip(edge[:-1], edge[1:])], pa.binary())})


def _windows(w: Words, starts: np.ndarray, doc_id: np.ndarray, width: int, buckets: int):
    """The distinct windows that start at ``starts``: bucket, hash, smallest doc_id, and which window each start has."""
    bucket = (grams(w.hashes(1), width, 1)[starts] % U(buckets)).astype(np.int64)
    h = grams(w.hashes(), width)[starts]
    doc = doc_id[w.doc_of_word()[starts]]
    order = np.lexsort((doc, h, bucket))
    new = _first_of_runs(bucket[order], h[order])
    which = np.empty(len(starts), np.int64)
    which[order] = np.cumsum(new) - 1
    pick = order[new]
    return bucket[pick], h[pick], doc[pick], which


def _starts(t: pa.Table, w: Words) -> np.ndarray:
    """Places (words of the whole table) of the stored candidate windows."""
    bits = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=n) for x, n in zip(t.column("starts"), w.count)]
    return np.flatnonzero(np.concatenate(bits))


def dedup(docs: DataFrame, finish: Finish, schema: str, carry: Sequence[str] = (), width: int = 13) -> DataFrame:
    """Apply ``finish`` to every document (columns doc_id, text and ``carry``) with its repeated words marked."""
    block = (width + 1) // 2
    out = StructType.fromDDL(schema)
    names = out.fieldNames()
    groups = n_groups(docs, doc_bytes(), GROUP_BYTES)
    # internal names: carried columns may be called anything
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"),
            *[F.col(c).alias(f"c_{i}") for i, c in enumerate(carry)]]
    base = docs.select(*cols, F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("g"))
    whole = base.filter("doc_id is not null")
    sent = whole.select("text", "g").mapInArrow(_send_blocks(block, groups), SENT)
    anchors = scratch_table(sent.groupBy("bucket").applyInArrow(_anchors, "g int, bucket int, low binary"), "sub-anchors")

    def rename(part: pa.Table) -> pa.Table:
        back = {"doc_id": "doc_id", "text": "text", **{f"c_{i}": c for i, c in enumerate(carry)}}
        return part.select(list(back)).rename_columns(list(back.values()))

    fields = [f"c_{i} {base.schema[f'c_{i}'].dataType.simpleString()}" for i in range(len(carry))]
    found = ", ".join(["candidate boolean", "g int", "doc_id long", "text string", *fields, "starts binary",
                       "done struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in out) + ">"])

    def candidates(t: pa.Table, hits: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_buffer(), np.uint32).astype(U) | U(b.as_py() << 32)
                for x, b in zip(hits.column("low"), hits.column("bucket"))]
        keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, U)
        w = Words(t.column("text"))
        is_start = starts_window(w, width)
        hit = starts_window(w, block)
        if len(keys):
            key = _block_key(grams(w.hashes(), block), groups)
            hit &= keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
        else:
            hit[:] = False
        near = np.zeros_like(hit)
        for back in range(min(width - block + 1, len(near))):  # windows that hold the hit
            near[:len(near) - back] |= hit[back:]
        near &= is_start
        edge = w.first
        has = np.add.reduceat(np.append(near, 0), np.minimum(edge[:-1], len(near))) > 0 if t.num_rows else np.zeros(0, bool)
        has &= w.count > 0
        starts = [pack(np.packbits(near[a:b])) if c else None for a, b, c in zip(edge[:-1], edge[1:], has)]
        rest = t.filter(pa.array(~has))
        done = finish(rename(rest), Words(rest.column("text")), np.zeros(int(w.count[~has].sum()), bool))
        done = pa.StructArray.from_arrays([done.column(n) for n in names], names)
        done = pa.concat_arrays([done, pa.nulls(int(has.sum()), done.type)])
        order = pa.array(np.argsort(np.argsort(has, kind="stable")))
        cand = pa.array(has)
        keep = lambda c: pc.if_else(cand, t.column(c), pa.scalar(None, t.schema.field(c).type))
        return pa.table({"candidate": cand, "g": t.column("g"), "doc_id": t.column("doc_id"), "text": keep("text"),
                         **{f"c_{i}": t.column(f"c_{i}") for i in range(len(carry))},
                         "starts": pa.array(starts, pa.binary()), "done": done.take(order)})

    stage = scratch_table(whole.groupBy("g").cogroup(anchors.groupBy("g")).applyInArrow(candidates, found), "sub-candidates",
                          partition="candidate")
    cand = stage.filter("candidate").drop("candidate", "done")

    def send(t: pa.Table) -> pa.Table:
        w = Words(t.column("text"))
        ids = t.column("doc_id").to_numpy()
        bucket, h, doc, _ = _windows(w, _starts(t, w), ids, width, groups)
        edge = np.append(np.flatnonzero(_first_of_runs(bucket)), len(bucket))
        rows: dict[str, list] = {"bucket": [], "g": [], "h": [], "ids": [], "which": []}
        g = t.column("g")[0].as_py()
        for a, b in zip(edge[:-1], edge[1:]):
            ids_here, which = np.unique(doc[a:b], return_inverse=True)
            for k, x in zip(rows, (int(bucket[a]), g, pack(h[a:b]), pack(ids_here),
                                   pack(which.astype(np.uint16 if len(ids_here) < 65536 else np.uint32)))):
                rows[k].append(x)
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(rows.values(), kinds)], names=list(rows))

    def answer(t: pa.Table) -> pa.Table:
        h, doc, size = [], [], []
        for x, ids, which in zip(t.column("h"), t.column("ids"), t.column("which")):
            h.append(np.frombuffer(x.as_buffer(), U))
            ids = np.frombuffer(ids.as_buffer(), np.int64)
            doc.append(ids[np.frombuffer(which.as_buffer(), np.uint16 if len(ids) < 65536 else np.uint32)])
            size.append(len(h[-1]))
        h, doc = np.concatenate(h), np.concatenate(doc)
        order = np.lexsort((doc, h))
        new = np.flatnonzero(_first_of_runs(h[order]))
        least = np.repeat(doc[order][new], np.diff(np.append(new, len(h))))
        smaller = np.empty(len(h), bool)
        smaller[order] = least < doc[order]
        edge = np.cumsum([0, *size])
        return pa.table({"g": t.column("g"), "bucket": t.column("bucket"),
                         "bits": pa.array([pack(np.packbits(smaller[a:b])) for a, b in zip(edge[:-1], edge[1:])], pa.binary())})

    sent = cand.select("g", "doc_id", "text", "starts").groupBy("g").applyInArrow(
        send, "bucket int, g int, h binary, ids binary, which binary")
    bits = scratch_table(sent.groupBy("bucket").applyInArrow(answer, "g int, bucket int, bits binary"), "sub-answers")

    def cut(t: pa.Table, answers: pa.Table) -> pa.Table:
        w = Words(t.column("text"))
        starts, ids = _starts(t, w), t.column("doc_id").to_numpy()
        bucket, _, doc, which = _windows(w, starts, ids, width, groups)
        smaller = np.zeros(len(bucket), bool)
        for b, x in zip(answers.column("bucket").to_pylist(), answers.column("bits")):
            a, z = np.searchsorted(bucket, [b, b + 1])
            smaller[a:z] = np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=z - a).astype(bool)
        covered = smaller[which] | (doc[which] < ids[w.doc_of_word()[starts]])
        edges = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(edges, starts[covered], 1)
        np.add.at(edges, starts[covered] + width, -1)
        return pa.Table.from_batches([finish(rename(t), w, np.cumsum(edges[:-1]) > 0)])

    late = cand.groupBy("g").cogroup(bits.groupBy("g")).applyInArrow(cut, out)
    done = stage.filter("not candidate").select("done.*")

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"))
                yield finish(rename(pa.Table.from_batches([part])), w, np.zeros(len(w.start), bool))

    return done.unionByName(late).unionByName(base.filter("doc_id is null").drop("g").mapInArrow(untouched, out))


def kept_texts(w: Words, removed: np.ndarray) -> list[bytes]:
    """Each text's kept words, joined by one space."""
    out = []
    for a, b in zip(w.first[:-1], w.first[1:]):
        keep = np.flatnonzero(~removed[a:b]) + a
        out.append(b" ".join([w.data[s:e].tobytes() for s, e in zip(w.start[keep].tolist(), w.end[keep].tolist())]))
    return out


def kept_raw(w: Words, removed: np.ndarray, texts: pa.ChunkedArray) -> list[str | None]:
    """Each text with its removed words cut out and all else, white space included, as it was; texts without a
    removed word come back unchanged."""
    out: list[str | None] = []
    for d, (a, b) in enumerate(zip(w.first[:-1], w.first[1:])):
        text = texts[d].as_py()
        gone = removed[a:b]
        if not gone.any():
            out.append(text)
            continue
        raw, base = text.encode(), int(w.offset[d])
        keep, at = [], 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
        for s, e in zip(edge[::2], edge[1::2]):
            keep.append(raw[at:w.start[a + s] - base])
            at = (w.start[a + e] if a + e < b else w.end[a + e - 1]) - base
        out.append(b"".join([*keep, raw[at:]]).decode())
    return out

