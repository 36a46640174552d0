"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability is a logistic function of its words and their beginnings (hashed to ``FEATURES`` weights); a document is toxic
when at least one sentence is (noisy-or: 1 - product of 1 - p).  The weights are fitted to document labels by
gradient ascent on the documents' likelihood, so sentences need no labels; afterwards the sentence
probabilities locate the offending sentences.

Fitting uses a bounded sample of labelled documents with a text: ``PER_CLASS`` documents of each class (all, if there
are fewer), chosen by a hash of doc_id, of together at most ``CLASS_BYTES`` bytes.  Where whole texts would be more, the
longest ones, and only they, are represented by some of their whole sentences, so that no document is left out.  Scoring covers every document, whole texts, without a shuffle.

Null and empty texts have no sentence and get the probability of an empty sentence.  Labels that repeat count as
their largest value; null labels and null doc_ids are not learned from.  Of documents with equal doc_id the
sample holds one.  Without labels of both classes every score is 0.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tokens import NON_ALNUM_BYTES, U, Words, slices, text_bytes

FEATURES = 1 << 18
PER_CLASS = 2000
CLASS_BYTES = 16 << 20
EPOCHS = 250
PREFIXES = (5, 6, 7)  # bytes
LEAST_Z = 4.0
SENTENCE_ENDS = np.zeros(256, bool)
SENTENCE_ENDS[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, s: Sentences) -> np.ndarray:
        return np.bincount(s.of_word, self.weights[s.feature], minlength=s.n) + self.bias


class Sentences:
    """The sentences (that hold a word) of some texts."""

    def __init__(self, texts: pa.Array):
        w = Words(texts, NON_ALNUM_BYTES, lower=True)
        doc = w.doc_of_word()
        number = np.cumsum(SENTENCE_ENDS[w.data])[w.start] if len(w.start) else np.zeros(0, np.int64)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
        self.of_word = np.cumsum(new) - 1
        self.n = int(new.sum())
        self.doc = doc[new]
        # a word's features: the word and its beginnings of some lengths, each hashed
        features, owner = [w.hashes()], [np.arange(len(doc))]
        whole = w.end
        for n in PREFIXES:
            longer = np.flatnonzero(whole - w.start > n)
            w.end = np.minimum(whole, w.start + n)
            features.append(w.hashes()[longer] ^ U(n))
            owner.append(longer)
        w.end = whole
        self.of_word = self.of_word[np.concatenate(owner)].astype(np.int32)
        self.feature = (np.concatenate(features) & U(FEATURES - 1)).astype(np.int32)
        first = np.flatnonzero(new)
        self.start, self.end = w.start[first], w.end[np.append(first[1:], len(doc)) - 1] if len(doc) else w.end
        self.n_docs = len(texts)
        self.words = w


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def _logistic(z):
    return np.exp(-np.logaddexp(0.0, -z))


def doc_scores(m: Model, s: Sentences) -> np.ndarray:
    """Noisy-or over a document's sentences and one empty sentence."""
    a = np.bincount(s.doc, _softplus(m.logits(s)), minlength=s.n_docs) + _softplus(np.array(m.bias))
    return -np.expm1(-a)


def fit(texts: list[str], toxic: list[int], epochs: int = EPOCHS, rate: float = 0.15, l2: float = 2e-4) -> Model:
    y = np.array(toxic, float)
    m = Model(np.zeros(FEATURES), -6.0)
    if not len(y) or y.min() == y.max():
        return Model(m.weights, -40.0)
    s = Sentences(pa.array(texts, pa.string()))
    feature = s.feature
    # start at smoothed log odds of documents that hold the word
    pair = np.unique(s.doc[s.of_word].astype(np.int64) * FEATURES + feature)
    label, word = y[pair // FEATURES], pair % FEATURES
    del pair
    pos, neg = (np.bincount(word, x, minlength=FEATURES) for x in (label, 1 - label))
    del label, word
    w = np.log((pos + 1) / (y.sum() + 2)) - np.log((neg + 1) / (len(y) - y.sum() + 2))
    # only words that tell the classes apart (a test of two shares) are learned; the rest would be noise
    share = (pos + neg) / len(y)
    z = (pos / y.sum() - neg / (len(y) - y.sum())) / np.sqrt(share * (1 - share) * (1 / y.sum() + 1 / (len(y) - y.sum())) + 1e-12)
    use = (pos + neg >= 4) & (np.abs(z) >= LEAST_Z)
    kept = np.flatnonzero(use)
    mine = use[feature]
    of_word, feature, w = s.of_word[mine], np.searchsorted(kept, feature[mine]), w[kept]
    n_sentences, doc = s.n, s.doc
    del s, mine
    b, first, second = m.bias, np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, epochs + 1):
        z = np.bincount(of_word, w[feature], minlength=n_sentences) + b
        a = np.bincount(doc, _softplus(z), minlength=len(y)) + _softplus(np.array(b))
        g_doc = np.where(y > 0, 1 / np.expm1(np.clip(a, 1e-6, 500)), -1.0)
        g = g_doc[doc] * _logistic(z)
        grad = np.append(np.bincount(feature, g[of_word], minlength=len(w)), g.sum() + g_doc.sum() * _logistic(b))
        grad = grad / len(y) - l2 * np.append(w, 0) / 10
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        w, b = w + move[:-1], b + move[-1]
    m.weights[kept], m.bias = w, float(b)
    return m


def longest_whole(sizes: list[int], room: int) -> int:
    """The greatest L for which texts of these sizes, each cut to L bytes, fit into ``room``."""
    for k, n in enumerate(sorted(sizes)):
        if n * (len(sizes) - k) > room:
            return room // (len(sizes) - k)
        room -= n
    return max(sizes, default=0)


def some_sentences(text: str, room: int) -> str:
    """Whole sentences of at most ``room`` bytes, chosen by hash; the beginning of the first if none fits."""
    if len(text.encode()) <= room:
        return text
    parts = re.findall(r"[^.!?\n]*[.!?\n]|[^.!?\n]+", text)
    kept = set()
    for k in sorted(range(len(parts)), key=lambda k: (zlib.crc32(f"{k} {parts[k]}".encode()), k)):
        n = len(parts[k].encode())
        if n <= room:
            kept.add(k)
            room -= n
    return "".join(parts[k] for k in sorted(kept)) or parts[0].encode()[:room].decode(errors="ignore")


def sample(docs: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS,
           class_bytes: int = CLASS_BYTES) -> tuple[list[str], list[int]]:
    """``per_class`` documents of each class, the longest ones shortened to ``class_bytes`` of a class."""
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(usable)
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("o", F.xxhash64("doc_id")))
    with_text = docs.select("doc_id", "text").filter("text is not null")
    # only ids and sizes are shuffled
    sizes = with_text.select("doc_id", F.octet_length("text").alias("n")).join(ids, "doc_id").groupBy("doc_id", "toxic", "o").agg(F.max("n").alias("n"))
    chosen: list[tuple[int, int, int, int]] = []
    for y in (0, 1):
        got = sizes.filter(F.col("toxic") == y).orderBy("o", "doc_id").limit(per_class).collect()
        least = longest_whole([r["n"] for r in got], class_bytes)
        chosen += [(r["doc_id"], y, k, least) for k, r in enumerate(got)]
    if not chosen:
        return [], []
    take = docs.sparkSession.createDataFrame(chosen, "doc_id long, y int, k int, room long")
    # at most 2 * per_class ids: a broadcast of bounded size; texts are cut before they are sent anywhere
    cut = F.udf(some_sentences, "string")
    short = F.when(F.octet_length("text") <= F.col("room"), F.col("text")).otherwise(cut("text", "room"))
    got = (with_text.join(F.broadcast(take), "doc_id").select("y", "k", short.alias("text"))
           .groupBy("y", "k").agg(F.max("text").alias("text")).orderBy("y", "k").collect())
    return [r["text"] for r in got], [r["y"] for r in got]


def score(docs: DataFrame, model: Model, locate_from: float = 0.5) -> DataFrame:
    """(doc_id, score, offending: array of (start, end, score) in characters) for every document."""
    share = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                s = Sentences(part.column("text"))
                p = doc_scores(share.value, s)
                ps = _logistic(share.value.logits(s))
                off: list[list] = [[] for _ in range(s.n_docs)]
                bad = np.flatnonzero(ps >= locate_from)
                if len(bad):
                    chars = np.concatenate(([0], np.cumsum((s.words.data & 0xC0) != 0x80)))
                    begin = text_bytes(part.column("text"))[1]
                    for k in bad:
                        d = s.doc[k]
                        base = chars[begin[d]]
                        off[d].append({"start": int(chars[s.start[k]] - base), "end": int(chars[s.end[k]] - base), "score": float(ps[k])})
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array(off, kind)],
                                                 names=["doc_id", "score", "offending"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        run, "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")

