"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A test item is contained in a document when at least 80 % of its distinct 5-word shingles occur there
(words: digits, letters and non-ASCII code points, A-Z lower-cased).  An item of fewer words is one
shingle of that many words; an item without words is contained in nothing.

Documents are partitioned by the size of their shingle set.  In the partition of sets of up to 2^c
shingles, one-permutation MinHash with 4 * 2^c bins describes a set: a shingle is in the sketch when its hash is
the least of its bin.  A contained shingle is the least in a document's bin with probability above
0.88, so an item of q shingles, at least 0.8 q of them contained, shares no bin value with
probability below 0.25 ** (0.8 q): 2e-8 at q = 16.  Items of fewer shingles have a bin per
shingle (all are probed), so for them the search is exact.  Candidates are verified by counting.

The documents are read once and never shuffled.  The items' hashes are broadcast in blocks of at most
``BLOCK`` shingles (16 MB); a larger benchmark takes more passes.

Null texts count as empty; rows with equal ids are searched by themselves and give a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tokens import NON_ALNUM_BYTES, U, Words, grams, slices, starts_window

K = 5
BINS_PER_SHINGLE_LOG2 = 2
SHORT_ITEM = 16
BLOCK = 2_000_000


def _shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct k-word shingles, sorted."""
    ok = starts_window(w, k)
    doc, h = w.doc_of_word()[ok], grams(w.hashes(), k)[ok]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[first], h[first]


class Items:
    """Sketches of a block of items: shingle hashes by item, and per size class the bins' least."""

    def __init__(self, texts: list[str]):
        w = Words(pa.array(texts, pa.string()), NON_ALNUM_BYTES, lower=True)
        self.width = np.minimum(w.count, K)  # words of a shingle of each item
        item, h = [], []
        for k in range(1, K + 1):
            i, x = _shingles(w, k)
            mine = self.width[i] == k
            item.append(i[mine])
            h.append(x[mine])
        self.item, self.h = np.concatenate(item), np.concatenate(h)
        order = np.lexsort((self.item, self.h))
        self.item, self.h = self.item[order], self.h[order]
        self.size = np.bincount(self.item, minlength=len(texts))
        self.by_class: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sketch(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, item) of the items' sketches for documents of up to 2^c shingles."""
        if c not in self.by_class:
            least = np.lexsort((self.h, _bin(self.h, c), self.item))
            i, b = self.item[least], _bin(self.h[least], c)
            first = np.ones(len(i), bool)
            first[1:] = (i[1:] != i[:-1]) | (b[1:] != b[:-1])
            pick = np.sort(least[first | (self.size[i] < SHORT_ITEM)])
            self.by_class[c] = self.h[pick], self.item[pick]
        return self.by_class[c]


def _bin(h: np.ndarray, c: int) -> np.ndarray:
    return h >> U(64 - min(63, c + BINS_PER_SHINGLE_LOG2))


def _probe(h: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in h, place in the sorted table) of equal hashes."""
    a, b = np.searchsorted(table, h, "left"), np.searchsorted(table, h, "right")
    n = b - a
    left = np.repeat(np.arange(len(h)), n)
    return left, np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def find(items: Items, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, contained shingles) of the verified containments."""
    w = Words(texts, NON_ALNUM_BYTES, lower=True)
    out = []
    for k in range(1, K + 1):
        if not (items.width == k).any():
            continue
        doc, h = _shingles(w, k)
        size = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), int)
        c = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
        pairs = []
        # shingles of short items are probed whole, others where they are the least of their bin
        for cls in np.unique(c[doc]) if len(doc) else ():
            mine = np.flatnonzero(c[doc] == cls)
            table, item = items.sketch(int(cls))
            b = _bin(h[mine], int(cls))
            first = np.ones(len(mine), bool)
            first[1:] = (b[1:] != b[:-1]) | (doc[mine][1:] != doc[mine][:-1])
            at, hit = _probe(h[mine], table)
            ok = (items.width[item[hit]] == k) & (first[at] | (items.size[item[hit]] < SHORT_ITEM))
            pairs.append(np.stack([doc[mine][at[ok]], item[hit[ok]]], 1))
        if not pairs:
            continue
        pairs = np.unique(np.concatenate(pairs), axis=0)
        edges = np.searchsorted(doc, np.arange(len(texts) + 1))
        by_item = np.argsort(items.item, kind="stable")
        starts = np.searchsorted(items.item[by_item], np.arange(len(items.size) + 1))
        for d, i in pairs:
            q, mine = items.h[by_item[starts[i]:starts[i + 1]]], h[edges[d]:edges[d + 1]]
            at = np.searchsorted(mine, q)
            n = int((mine[np.minimum(at, len(mine) - 1)] == q).sum())
            if 5 * n >= 4 * len(q):
                out.append((d, i, n))
    got = np.array(out, dtype=np.int64).reshape(-1, 3)
    return got[:, 0], got[:, 1], got[:, 2]


def _blocks(benchmark: DataFrame, item_id: str, item_text: str):
    """The items as broadcast values of bounded size: (ids, texts) a block."""
    n_words = F.octet_length(F.coalesce(F.col(item_text), F.lit("")))  # no text has more words than bytes
    blocks = max(1, -(-(benchmark.agg(F.sum(n_words)).first()[0] or 0) // BLOCK))
    bench = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).filter("t is not null")
    for b in range(blocks):
        rows = bench.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        rows = sorted(((r["i"], r["t"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        yield benchmark.sparkSession.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))


def contained(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, n_item_shingles, n_contained): the items that documents contain."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for share in _blocks(benchmark, item_id, item_text):
        def search(batches: Iterator[pa.RecordBatch], share=share) -> Iterator[pa.RecordBatch]:
            ids, texts = share.value
            items = Items(texts)
            ids = pa.array(ids, pa.int64())
            for batch in batches:
                for part in slices(batch, "text"):
                    d, i, n = find(items, part.column("text"))
                    if len(d):
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array(d)), ids.take(pa.array(i)), pa.array(items.size[i]),
                             pa.array(n)], names=["doc_id", "item_id", "n_item_shingles", "n_contained"])

        found = slim.mapInArrow(search, "doc_id long, item_id long, n_item_shingles long, n_contained long")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The documents, all columns as they are, that contain no item."""
    for share in _blocks(benchmark, item_id, item_text):
        def keep(batches: Iterator[pa.RecordBatch], share=share) -> Iterator[pa.RecordBatch]:
            items = Items(share.value[1])
            for batch in batches:
                for part in slices(batch, text):
                    ok = np.ones(part.num_rows, bool)
                    ok[find(items, part.column(text))[0]] = False
                    yield part.filter(pa.array(ok))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
