"""Spelling variant grouping with a bit-sliced position index.

The vocabulary (words and their numbers of occurrences) is cut into blocks.  A block holds, per (position, letter), a bit set
over its words.  A query word runs over all words of a block at once: ``Z`` is the set of words equal to it so far, ``E`` the
set of words that differ by one error so far; with X the bit set of the query's next letter at its position,

    replaced letter      E' = (E & X) | (Z & ~X)              Z' = Z & X
    additional letter    E' = (E & X one position on) | Z'     Z' = Z & X

so a few word-parallel operations a letter decide 64 words each, exactly.  A missing letter is the additional one seen from
the other word, so each pair of different lengths is found once and counts for both.

Which words meet in a block: a word of t letters is cut into three segments, and two words that differ by one error agree
left and right of the segment of the error.  So a word is indexed three times, by its letters without one segment, and looks
for words of its own and of the next length by its own letters there; a found pair counts for the first segment that holds
its error, so once.  Keys are only a way to a block (their hash may collide: the bit sets decide).  A key of more than
``BLOCK`` words is split over several blocks, and its words ask all of them, in a stream: a task holds the index of one block.
What a block finds is summed per word (count, best word) before it leaves the task; no pair is ever stored.

Null and empty texts have no words; a null doc_id is written as the empty string where the damage is drawn; repeated rows
count again; other columns are left out, whatever their names.  Ties between forms go to the least word in code-point
order.  Words may be as long as a text.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import store

BLOCK = 4096
LEAST = 7  # code points of a word
TIMES = 10  # how often more than the word its form occurs
#: Entries of a task's counts, bits of an index and words of a bit set in work, at most.
ENTRIES, BITS, WORK = 400_000, 1 << 24, 1 << 18
LONG = 4 << 20

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST},}}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def damaged(run: str, start: int) -> str:
    """The run without one code point where 31 divides its crc32 (``start``: that of what stands before it)."""
    h = zlib.crc32(run.encode(), start)
    if h % 31:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def vocabulary(docs: DataFrame, least: int = 2) -> DataFrame:
    """(word, n) of the words that occur ``least`` times or more, counted in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def give() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                low = text.as_py().encode().translate(_LOWER).decode()
                runs = _RUN.findall(low) if len(low) < LONG else (m[0] for m in _RUN.finditer(low))
                start = zlib.crc32(f"{doc.as_py() if doc.is_valid else ''}:".encode())
                for run, n in Counter(runs).items():
                    word = damaged(run, start)
                    if len(word) >= LEAST:
                        total[word] += n
                if len(total) > ENTRIES:
                    yield give()
        if total:
            yield give()

    return (docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


def _cuts(t: Column) -> list[Column]:
    return [F.lit(0), F.floor(t / 3).cast("int"), F.floor(2 * t / 3).cast("int"), t]


def _key(word: Column, t: Column, j: int) -> Column:
    """A hash of the letters outside segment j of three, for words of t letters."""
    cut, length = _cuts(t), F.char_length(word)
    right = t - cut[j + 1]
    return F.xxhash64(t, F.lit(j), F.substring(word, F.lit(1), cut[j]), F.substring(word, length - right + 1, right))


def _entries(words: DataFrame) -> DataFrame:
    """(key, mode, j, t, word, n): mode 0 are index rows, which also ask for their own length; 2 ask for the next one."""
    t = F.char_length("word")
    rows = [F.struct(_key(F.col("word"), t + int(mode > 0), j).alias("key"), F.lit(mode).alias("mode"), F.lit(j).alias("j"),
                     (t + int(mode > 0)).alias("t")) for mode in (0, 2) for j in range(3)]
    return words.select("word", "n", F.explode(F.array(*rows)).alias("e")).select("e.*", "word", "n")


def near(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best_n, best): near words' number, and the one of largest n (least word of equal ones)."""
    entries = _entries(words)
    counts = entries.filter("mode = 0").groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    heavy = store(counts.filter(F.col("c") > BLOCK).select("key", F.ceil(F.col("c") / BLOCK).cast("int").alias("parts")), "heavy")
    blocks = max(1, -(-words.count() * 3 // BLOCK))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    if heavy.limit(1).count():
        parts = entries.join(heavy, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        # mode 1: a word of a split key asks for its own length in the other parts
        target = F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
            p.alias("part"), F.when((F.col("mode") == 0) & (p != own), 1).otherwise(F.col("mode")).alias("as"))))
        placed = parts.withColumn("to", target).select(
            "key", F.col("to.as").alias("mode"), "j", "t", "word", "n", F.col("to.part").alias("part"))
    else:
        placed = entries.withColumn("part", F.lit(0))
    block = F.pmod(F.xxhash64("key", "part"), F.lit(blocks)).cast("int")
    ordered = (placed.select(block.alias("block"), "mode", "j", "t", "word", "n").repartition("block")
               .sortWithinPartitions("block", "mode", "t", "j"))
    found = ordered.mapInArrow(_search, "word string, n long, n_near long, best_n long, best string")
    every = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"),
                         F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))))
    return (found.unionByName(every).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


class Slice:
    """The bit sets of some words of one length, per (position, letter)."""

    def __init__(self, words: list[bytes], t: int):
        self.t, self.k = t, len(words)
        self.codes = np.frombuffer(b"".join(words), np.uint8).reshape(self.k, t)
        at = (np.arange(t, dtype=np.int64) * 256)[None, :] + self.codes
        self.rows, inverse = np.unique(at, return_inverse=True)
        bits = np.zeros((len(self.rows) + 1, -(-self.k // 64) * 64), bool)  # the last row: letters that no word has there
        bits[inverse.reshape(at.shape), np.arange(self.k)[:, None]] = True
        self.sets = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
        self.all = np.packbits(np.arange(bits.shape[1]) < self.k, bitorder="little").view(np.uint64)

    def _rows(self, asked: np.ndarray, shift: int) -> np.ndarray:
        at = (np.arange(shift, shift + asked.shape[1], dtype=np.int64) * 256)[None, :] + asked
        row = np.minimum(np.searchsorted(self.rows, at), len(self.rows) - 1)
        return np.where(self.rows[row] == at, row, len(self.rows))

    def replaced(self, asked: np.ndarray) -> np.ndarray:
        """Per asked word (codes of t letters) the bit set of the words with one letter replaced."""
        here = self._rows(asked, 0)
        z = np.broadcast_to(self.all, (len(asked), len(self.all))).copy()
        e = np.zeros_like(z)
        for p in range(self.t):
            x = self.sets[here[:, p]]
            e &= x
            e |= z & ~x
            z &= x
        return e

    def additional(self, asked: np.ndarray) -> np.ndarray:
        """Per asked word (t - 1 letters) the bit set of the words with one letter more."""
        here, on = self._rows(asked, 0), self._rows(asked, 1)
        z = np.broadcast_to(self.all, (len(asked), len(self.all))).copy()
        e = z.copy()
        for p in range(self.t - 1):
            e &= self.sets[on[:, p]]
            z &= self.sets[here[:, p]]
            e |= z
        return e


def pairs(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of the set bits."""
    r, c = np.nonzero(bits)
    part = np.unpackbits(bits[r, c][:, None].view(np.uint8), axis=1, bitorder="little")
    i, b = np.nonzero(part)
    return r[i], c[i] * 64 + b


def _first_segment(asked: np.ndarray, words: np.ndarray, t: int) -> np.ndarray:
    """The first segment that holds the only error of each pair of rows (``words`` have t letters)."""
    m = asked.shape[1]
    cuts = [0, t // 3, 2 * t // 3, t]
    same = np.concatenate([asked == words[:, :m], np.zeros((len(asked), 1), bool)], axis=1)
    left = same.argmin(axis=1)
    if m == t:
        return np.searchsorted(cuts, left, "right") - 1
    same = np.concatenate([(asked == words[:, t - m:])[:, ::-1], np.zeros((len(asked), 1), bool)], axis=1)
    right = same.argmin(axis=1)
    held = np.stack([(left >= cuts[j]) & (right >= t - cuts[j + 1]) for j in range(3)], axis=1)
    return held.argmax(axis=1)


class _Best:
    """Near words' number and best one per word of a list."""

    def __init__(self, k: int):
        self.near, self.n, self.word = np.zeros(k, np.int64), np.zeros(k, np.int64), [b""] * k

    def add(self, of: np.ndarray, other: np.ndarray, words: list[bytes], n: np.ndarray) -> None:
        if not len(of):
            return
        used, other = np.unique(other, return_inverse=True)
        text = np.array([words[i] for i in used], object)
        rank = np.empty(len(used), np.int64)
        rank[np.argsort(text, kind="stable")] = np.arange(len(used))
        order = np.lexsort((rank[other], -n[used][other], of))
        of, other = of[order], other[order]
        first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        self.near[of[first]] += np.diff(np.append(first, len(of)))
        for i, o in zip(of[first], other[first]):
            new = (-int(n[used[o]]), text[o])
            if not self.n[i] or new < (-int(self.n[i]), self.word[i]):
                self.n[i], self.word[i] = -new[0], new[1]

    def rows(self, words: list[bytes], n: np.ndarray) -> pa.RecordBatch:
        hit = np.flatnonzero(self.near)
        text = lambda x: pa.array([w.decode("latin-1") for w in x], pa.string())
        return pa.RecordBatch.from_arrays(
            [text(words[i] for i in hit), pa.array(n[hit], pa.int64()), pa.array(self.near[hit], pa.int64()),
             pa.array(self.n[hit], pa.int64()), text(self.word[i] for i in hit)], names=["word", "n", "n_near", "best_n", "best"])


class _Block:
    """The index rows of one block, by (letters, segment), cut so that an index holds ``BITS`` at most."""

    def __init__(self):
        self.raw: dict[tuple[int, int], tuple[list[bytes], list[int]]] = {}
        self.ready: dict[tuple[int, int], list[tuple[Slice, list[bytes], np.ndarray, _Best]]] = {}

    def index(self, t: int, j: int, words: list[bytes], n: list[int]) -> None:
        w, c = self.raw.setdefault((t, j), ([], []))
        w += words
        c += n

    def slices(self, t: int, j: int):
        if (t, j) not in self.ready:
            words, n = self.raw.get((t, j), ([], []))
            step, out = max(1, min(int((BITS / t) ** 0.5), BITS // (90 * t)) if t < 90 else int((BITS / t) ** 0.5)), []
            for a in range(0, len(words), step):
                part = words[a:a + step]
                out.append((Slice(part, t), part, np.array(n[a:a + step], np.int64), _Best(len(part))))
            self.ready[t, j] = out
        return self.ready[t, j]

    def ask(self, t: int, j: int, words: list[bytes], n: np.ndarray, best: _Best) -> None:
        """Look for words of t letters near ``words`` (all of t or of t - 1 letters)."""
        m = len(words[0])
        codes = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), m)
        for piece, held, held_n, held_best in self.slices(t, j):
            step = max(1, WORK // max(len(piece.all), m))
            for a in range(0, len(words), step):
                asked = codes[a:a + step]
                q, w = pairs(piece.replaced(asked) if m == t else piece.additional(asked))
                mine = _first_segment(asked[q], piece.codes[w], t) == j
                q, w = q[mine] + a, w[mine]
                best.add(q, w, held, held_n)
                if m < t:
                    held_best.add(w, q, words, n)

    def own(self) -> None:
        for t, j in self.raw:
            for _, words, n, best in self.slices(t, j):
                self.ask(t, j, words, n, best)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for parts in self.ready.values():
            for _, words, n, best in parts:
                if best.near.any():
                    yield best.rows(words, n)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, block, asking = None, None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, mode, j, t = (batch.column(c).to_numpy() for c in range(4))
        n = batch.column(5).to_numpy()
        edge = np.flatnonzero((np.diff(ids) != 0) | (np.diff(mode) != 0) | (np.diff(t) != 0) | (np.diff(j) != 0)) + 1
        for a, b in zip(np.concatenate(([0], edge)), np.concatenate((edge, [batch.num_rows]))):
            if ids[a] != at:
                if block is not None:
                    if not asking:
                        block.own()
                    yield from block.rows()
                at, block, asking = ids[a], _Block(), False
            words = [w.encode("latin-1") for w in batch.column(4).slice(a, b - a).to_pylist()]
            if mode[a] == 0:
                block.index(int(t[a]), int(j[a]), words, n[a:b].tolist())
                continue
            if not asking:
                block.own()
                asking = True
            best = _Best(len(words))
            block.ask(int(t[a]), int(j[a]), words, n[a:b], best)
            if best.near.any():
                yield best.rows(words, n[a:b])
    if block is not None:
        if not asking:
            block.own()
        yield from block.rows()


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root): a word's form is its most frequent near word, if that occurs ``TIMES`` as often.

    Forms grow by that factor a step, so chains are short; roots are found by doubling the steps, over words with a form only.
    """
    ok = F.col("best_n") >= TIMES * F.col("n")
    linked = store(near(words).select("word", "n", "n_near", F.when(ok, F.col("best")).alias("form"),
                                      F.when(ok, F.col("best_n")).alias("form_n")), "forms")
    root = store(linked.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = root.select(F.col("word").alias("w2"), F.col("root").alias("r2"))
        new = store(root.join(on, F.col("root") == F.col("w2"), "left")
                    .select("word", F.coalesce("r2", "root").alias("root"), F.col("w2").isNotNull().alias("moved")), "roots")
        moved = new.filter("moved").limit(1).count()
        root = new.select("word", "root")
        if not moved:
            break
    return linked.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))
