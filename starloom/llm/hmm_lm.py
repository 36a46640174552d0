"""Language-model scoring: word counts of the whole corpus and a hidden Markov model over them.

Tokens are words (A-Z lower-cased, parted by ASCII white space) and one end per text.

Base model: log10((c + 0.1) / (N + 0.1 (V + 1))) added over the tokens, with counts of the training texts.

Hidden Markov model: ``STATES`` latent states emit words and the end of a text; every word of the training texts has emission
counts of its own.  Those of the ``KNOWN`` most frequent words are broadcast and gathered as one matrix of bounded size.  Those of
all other words are a distributed table (word, state), as large as the corpus' vocabulary: Spark sums the tasks' expected
counts per word and joins them to the texts that hold the word.

Baum-Welch: tasks add up expected counts over their texts, Spark adds the tasks'.  While the states take shape, all but the ``FREE``
most frequent words are tied: in state k, word w has the state's mass of tied words times its share of their count (0.1 added; one
slot for unseen words).  The last turn unties them: what it expects of each word in each state takes the place of the tie, for
the other words smoothed towards it with ``PRIOR`` of its mass, so each state's probabilities still add up to one, unseen words
included.  The table of other words holds a word's count and its shares by state, each cut to a 4095th, in one number.  For
training, texts are cut into pieces of ``PIECE`` tokens; only a text's first piece counts as a start, the others begin with the states'
distribution after ``PIECE`` moves.  The scaled forward recursion that scores a text runs over the whole of it.

Words are told apart by a 64-bit hash.  A word outside the broadcast ones has at most a 131,072nd of all tokens, so no key of the
joins by word is hot; a text sends each such word once.

Null texts count as empty (one end).  Rows with equal doc_id are scored by themselves; rows without a doc_id are
training texts.  Very long texts are trained on in pieces and scored in one recursion by one task.  An empty table gives an empty one.
Only doc_id, text and held_out are read, other columns may have any names.  Without training tokens the score is the base score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import scratch_table, store
from ._tokens import U, Words, pack, slices

STATES = 6
KNOWN = 131_072  # words in the broadcast matrix; all others are in the distributed table
FREE = 16_384
PRIOR = 1.0  # of the tie, added to the expected counts of the other words
SYMBOL = np.uint32
PARTS, BITS = 4095, 12  # of a word's shares by state; STATES - 1 of them fit in 63 bits
PIECE = 64
TURNS = 4
END = U(0x454E44)  # stands for the end token among word hashes
ADD = 0.1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, c) of a task's words, added up in memory and given out when many."""
    def out(h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    def merge(hs: list, cs: list) -> tuple[np.ndarray, np.ndarray]:
        h, place = np.unique(np.concatenate(hs), return_inverse=True)
        return h, np.bincount(place, np.concatenate(cs)).astype(np.int64)

    hs, cs, n = [], [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            w = Words(part.column("text"), lower=True)
            h, c = np.unique(np.append(w.hashes(), END), return_counts=True)
            c[h == END] += part.num_rows - 1
            hs.append(h)
            cs.append(c)
            n += len(h)
            if n > 1 << 20:
                h, c = merge(hs, cs)
                hs, cs, n = [h], [c], len(h)
                if n > 1 << 19:
                    yield out(h, c)
                    hs, cs, n = [], [], 0
    if hs:
        yield out(*merge(hs, cs))


def count_words(texts: DataFrame) -> DataFrame:
    """Stored table (h, c) of all tokens of column ``text``."""
    parts = texts.select("text").mapInArrow(_count, "h long, c long")
    return store(parts.groupBy("h").agg(F.sum("c").alias("c")), "lm-counts")


class Vocabulary:
    """The most frequent words: counts and symbol numbers (by rank; then: end, other word)."""

    def __init__(self, h: np.ndarray, c: np.ndarray, n: int, v: int, end_c: int):
        self.end_c = end_c
        h, c = h[h != END], c[h != END]
        order = np.argsort(h)
        self.h, self.symbol = h[order], order.astype(SYMBOL)
        self.end, self.other = len(h), len(h) + 1
        self.n, self.v = n, v
        others = max(v - len(h) - (self.end_c > 0), 0) + 1  # other words, and one slot for unseen ones
        self.mass = max(n - int(c.sum()) - self.end_c, 0) + ADD * others
        self.log_total = np.log10(n + ADD * (v + 1))
        self.log_c = np.append(np.log10(np.append(c, self.end_c) + ADD), 0.0)  # of the other words: not known here
        self.start = np.append(c, [self.end_c, max(n - int(c.sum()) - self.end_c, 1)]) + ADD
        self.start = self.start / self.start.sum()

    def symbols(self, h: np.ndarray) -> np.ndarray:
        if not len(self.h):
            return np.full(len(h), self.other, SYMBOL)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.symbol[at], SYMBOL(self.other))


def frequent(counts: DataFrame, known: int) -> list:
    """At most ``known`` rows (h, c) of the most frequent words, by count, to a 16th of an octave; of the last level by hash.

    The bounds come from histograms of bounded size: no task sends more rows to the driver than are kept there.
    """
    def whole(bins: DataFrame, room: int) -> tuple[int | None, int | None, int]:
        """Last bin up to which all fit, the bin after it, and the room left."""
        last = None
        for r in bins.collect():
            if r["n"] > room:
                return last, r["b"], room
            last, room = r["b"], room - r["n"]
        return last, None, room

    level, part = F.floor(F.log2("c") * 16), F.pmod("h", F.lit(16_384))
    levels = counts.groupBy(level.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("b").desc())
    least, cut, room = whole(levels, known)
    take = level >= least if least is not None else F.lit(False)
    if cut is not None:
        parts = counts.filter(level == cut).groupBy(part.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy("b")
        upto, _, _ = whole(parts, room)
        if upto is not None:
            take = take | ((level == cut) & (part <= upto))
    return counts.filter(take).orderBy(F.col("c").desc(), "h").collect()


def squeeze(symbols: np.ndarray) -> bytes:
    """Symbols of a text, compressed (byte by byte of their place, as the high bytes are mostly zero)."""
    return pa.compress(pack(symbols.astype(SYMBOL).view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def expand(x: pa.BinaryScalar, n: int) -> np.ndarray:
    raw = pa.decompress(x.as_buffer(), decompressed_size=4 * n, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view(SYMBOL).ravel()


def encode(docs: DataFrame, vocab) -> DataFrame:
    """Stored table: a row per document with its symbols, the sums of its known words, and the sorted hashes of its other words, each
    once.  Symbol ``other`` + i is the i-th of these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc: Vocabulary = vocab.value
        for batch in batches:
            for part in slices(batch, "text"):
                w = Words(part.column("text"), lower=True)
                d, at = len(w.count), w.first + np.arange(len(w.first))
                place, h = np.arange(len(w.start)) + w.doc_of_word(), w.hashes()
                symbol = np.full(len(w.start) + d, voc.end, SYMBOL)
                symbol[place] = voc.symbols(h)
                doc = np.repeat(np.arange(d), w.count + 1)
                found = (symbol < voc.end) | ((symbol == voc.end) & (voc.end_c > 0))
                total = lambda x: np.bincount(doc, x, minlength=d)
                log_c = total(voc.log_c[symbol])
                rare = np.flatnonzero(symbol == voc.other)
                key, of = h[rare - doc[rare]].view(np.int64), doc[rare]
                order = np.lexsort((key, of))
                key, of, rare = key[order], of[order], rare[order]
                new = np.append(True, (key[1:] != key[:-1]) | (of[1:] != of[:-1]))[:len(key)]
                edge = np.searchsorted(of[new], np.arange(d + 1))
                symbol[rare] = (voc.other + np.cumsum(new) - 1 - edge[of]).astype(SYMBOL)
                key = key[new]
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(w.count + 1),
                    pa.array(total(found).astype(np.int64)), pa.array(log_c),
                    pa.array([squeeze(symbol[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    pa.array([pack(key[a:b]) for a, b in zip(edge[:-1], edge[1:])], pa.binary())],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_found", "log_found", "symbols", "rare"])

    rows = docs.withColumn("row", F.monotonically_increasing_id())
    return scratch_table(rows.select("row", "doc_id", "held_out", "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_found long, log_found double, symbols binary, rare binary"),
        "lm-encoded")


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, h): each other word of a document once."""
    for batch in batches:
        for part in slices(batch, "rare"):
            raw = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column("rare")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column("row").to_numpy(zero_copy_only=False), [len(x) for x in raw])),
                 pa.array(np.concatenate(raw))], names=["row", "h"])


def other_words(encoded: DataFrame, untied: DataFrame) -> DataFrame:
    """(row, words): for each document its other words with count and shares by state (null: not in the training texts)."""
    words = encoded.select("row", "rare").filter(F.octet_length("rare") > 0).mapInArrow(_rare, "row long, h long")
    return words.join(untied, "h", "left").groupBy("row").agg(F.collect_list(F.struct("h", "c", "q")).alias("words"))


def by_state(c: np.ndarray, q: np.ndarray, states: int) -> np.ndarray:
    """(words, states): expected counts from count and packed shares."""
    parts = np.stack([(q >> (BITS * i)) & PARTS for i in range(states - 1)], 1)
    return np.column_stack([parts, PARTS - parts.sum(1)]) * (c / PARTS)[:, None]


class Hmm:
    """start (K), move (K, K), emit (symbols, K): probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, unigram: np.ndarray, states: int = STATES) -> Hmm:
        draw = np.random.default_rng(7)
        emit = unigram[:, None] * draw.uniform(0.5, 1.5, (len(unigram), states))
        move = np.full((states, states), 0.1) + np.eye(states) + draw.uniform(0, 0.05, (states, states))
        return cls(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def posteriors(self, pieces: np.ndarray, length: np.ndarray, first: np.ndarray) -> tuple:
        """(starts, moves, inside, gamma) over pieces (rows, padded to equal length): expected counts of starts and moves, and per
        place (t, n) that is ``inside`` a piece the states' probabilities.  ``first`` tells the pieces that begin a text."""
        n, t_max, k = len(pieces), pieces.shape[1], len(self.start)
        inside = np.arange(t_max) < length[:, None]
        b = np.where(inside.T[:, :, None], self.emit[pieces.T], 1.0)  # (t, n, k); padding emits with certainty
        later = self.start @ np.linalg.matrix_power(self.move, PIECE)
        begin = np.where(first[:, None], self.start, later / later.sum())
        alpha, scale = np.empty((t_max, n, k)), np.empty((t_max, n))
        for t in range(t_max):
            a = (begin if t == 0 else alpha[t - 1] @ self.move) * b[t]
            scale[t] = a.sum(1)
            alpha[t] = a / scale[t][:, None]
        beta = np.ones((n, k))
        moves, gamma = np.zeros((k, k)), np.empty((t_max, n, k))
        for t in range(t_max - 1, -1, -1):
            gamma[t] = alpha[t] * beta
            if t:
                right = b[t] * beta / scale[t][:, None]
                moves += (alpha[t - 1] * inside[:, t][:, None]).T @ right
                beta = right @ self.move.T
        gamma /= gamma.sum(2, keepdims=True)
        return gamma[0][first].sum(0), moves * self.move, inside.T, gamma

    def expect(self, pieces: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Expected counts, flattened: starts, moves, emissions."""
        starts, moves, ok, gamma = self.posteriors(pieces, length, first)
        return np.concatenate([starts, moves.ravel(), tally(pieces.T[ok], gamma[ok], len(self.emit)).ravel()])

    def updated(self, counts: np.ndarray) -> Hmm:
        k = len(self.start)
        start, move = counts[:k] + ADD, counts[k:k + k * k].reshape(k, k) + ADD
        emit = counts[k + k * k:].reshape(-1, k)
        emit = emit + ADD * emit.sum(0) / max(emit.sum(), 1) + 1e-4
        return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))

    def log10(self, symbols: np.ndarray, length: np.ndarray, more: np.ndarray | None = None) -> np.ndarray:
        """log10 probability of whole sequences (laid end to end), by the scaled forward recursion.
        Symbols from len(emit) on are rows of ``more``."""
        start = np.cumsum(length) - length
        order = np.argsort(-length, kind="stable")
        at, left = start[order], length[order]
        out = np.zeros(len(length))
        a = np.tile(self.start, (len(length), 1)) if len(length) else np.zeros((0, len(self.start)))
        active = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), "left")
        n = len(self.emit)
        for t, m in enumerate(active):  # sequences longer than t come first
            now = symbols[at[:m] + t]
            e = self.emit[np.minimum(now, n - 1)]
            if more is not None and len(more):
                beyond = now >= n
                e[beyond] = more[now[beyond] - n]
            a = (a[:m] if t == 0 else a[:m] @ self.move) * e
            s = a.sum(1)
            a /= s[:, None]
            out[:m] += np.log10(s)
        back = np.empty(len(length))
        back[order] = out
        return back


def tally(key: np.ndarray, gamma: np.ndarray, n: int) -> np.ndarray:
    """(n, K): the sums of ``gamma``'s rows by key."""
    return np.stack([np.bincount(key, gamma[:, i], minlength=n) for i in range(gamma.shape[1])], 1)


def _pieces(batch: pa.RecordBatch, other: int | None = None) -> Iterator[tuple]:
    """The batch's symbols in pieces (symbols, length, begins a text), ``2048`` at a time.  With ``other``, symbols from there on
    become ``other``, and the hashes of the other words at their places follow."""
    rows, size = [], 0
    for j, (x, n_tokens) in enumerate(zip(batch.column("symbols"), batch.column("n_tokens").to_pylist())):
        s = expand(x, n_tokens)
        n = -(-len(s) // PIECE)
        padded = np.zeros(n * PIECE, SYMBOL)
        padded[:len(s)] = s if other is None else np.minimum(s, other)
        length = np.full(n, PIECE)
        length[-1] = len(s) - (n - 1) * PIECE
        row = [padded.reshape(n, PIECE), length, np.arange(n) == 0]
        if other is not None:
            h, rare = np.zeros(n * PIECE, np.int64), s >= other
            h[:len(s)][rare] = np.frombuffer(batch.column("rare")[j].as_buffer(), np.int64)[s[rare] - other]
            row.append(h.reshape(n, PIECE))
        rows.append(row)
        size += n
        if size >= 2048:
            yield tuple(map(np.concatenate, zip(*rows)))
            rows, size = [], 0
    if rows:
        yield tuple(map(np.concatenate, zip(*rows)))


class Sums:
    """Sums of vectors by hash, given out when many."""

    def __init__(self, most: int = 1 << 19):
        self.parts, self.n, self.most = [], 0, most

    def add(self, h: np.ndarray, g: np.ndarray) -> tuple | None:
        key, place = np.unique(h, return_inverse=True)
        self.parts.append((key, tally(place, g, len(key))))
        self.n += len(key)
        if self.n > 2 * self.most:
            h, g = self.rest()
            if len(h) > self.most:
                return h, g
            self.parts, self.n = [(h, g)], len(h)
        return None

    def rest(self) -> tuple | None:
        if not self.parts:
            return None
        key, place = np.unique(np.concatenate([h for h, _ in self.parts]), return_inverse=True)
        g = tally(place, np.concatenate([g for _, g in self.parts]), len(key))
        self.parts, self.n = [], 0
        return key, g


def train(encoded: DataFrame, unigram: np.ndarray, turns: int = TURNS) -> tuple[Hmm, np.ndarray, DataFrame]:
    """Baum-Welch over the training texts of the encoded table; the last two symbols are the end and the other word.  Gives the model, the
    expected count of other words by state, and the stored table (h, c, q) of the other words: count and shares by state."""
    spark, model = encoded.sparkSession, Hmm.first(unigram)
    k, end, other = len(model.start), len(unigram) - 2, len(unigram) - 1
    texts = encoded.filter(~F.col("held_out")).select("n_tokens", "symbols", "rare")
    g = [f"g{i}" for i in range(k - 1)]  # of the last state: what is left of c
    schema = "i int, h long, c double, " + ", ".join(f"{x} float" for x in g)
    tied = np.arange(len(unigram)) >= min(FREE, end)
    tied[end] = False
    for turn in range(turns):
        share, last = spark.sparkContext.broadcast(model), turn == turns - 1

        def expect(batches: Iterator[pa.RecordBatch], share=share, last=last) -> Iterator[pa.RecordBatch]:
            def out(i, h, x) -> pa.RecordBatch:  # one of i and h is null
                n = len(x)
                return pa.RecordBatch.from_arrays(
                    [pa.nulls(n, pa.int32()) if i is None else pa.array(i, pa.int32()), pa.nulls(n, pa.int64()) if h is None else pa.array(h),
                     pa.array(x.sum(1)), *[pa.array(x[:, j].astype(np.float32)) for j in range(k - 1)]], names=["i", "h", "c", *g])

            model, sums = share.value, Sums()
            key = np.arange(len(model.emit)) if last else np.where(tied, other, np.arange(len(model.emit)))
            starts, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros_like(model.emit)
            for batch in batches:
                for part in slices(batch, "symbols"):
                    for pieces, length, first, rare in _pieces(part, other):
                        for a in range(0, len(pieces), 2048):
                            s, m, ok, gamma = model.posteriors(pieces[a:a + 2048], length[a:a + 2048], first[a:a + 2048])
                            symbol, gamma = pieces[a:a + 2048].T[ok], gamma[ok]
                            starts += s
                            moves += m
                            emits += tally(key[symbol], gamma, len(emits))
                            if last:
                                full = sums.add(rare[a:a + 2048].T[ok][symbol == other], gamma[symbol == other])
                                if full is not None:
                                    yield out(None, *full)
            seen = np.flatnonzero(emits.any(1))
            yield out(np.concatenate([[-1], -2 - np.arange(k), seen]), None, np.concatenate([starts[None], moves, emits[seen]]))
            left = sums.rest()
            if left is not None and len(left[0]):
                yield out(None, *left)

        rows = texts.mapInArrow(expect, schema).groupBy("i", "h").agg(F.sum("c").alias("c"), *[F.sum(x).alias(x) for x in g])
        if last:
            q = F.lit(0).cast("long")
            for j, x in enumerate(g):
                part = F.least(F.floor(F.greatest(F.col(x), F.lit(0.0)) / F.col("c") * PARTS), F.lit(PARTS))
                q = q.bitwiseOR(F.shiftleft(part.cast("long"), BITS * j))
            known = F.col("i").isNotNull()
            rows = scratch_table(rows.select("i", "h", "c", *[F.when(known, F.col(x)).alias(x) for x in g],
                                             F.when(~known, q).alias("q")), "lm-last-turn")
        got = rows.filter("i is not null").select("i", "c", *g).toArrow()
        i, x = got.column("i").to_numpy(), np.stack([got.column(c).to_numpy() for c in ("c", *g)], 1)
        x = np.column_stack([x[:, 1:], np.maximum(x[:, 0] - x[:, 1:].sum(1), 0)])
        dense = np.zeros((1 + k + len(unigram), k))
        dense[np.where(i < 0, -1 - i, i + 1 + k)] = x
        if not last:
            dense[1 + k:][tied] = dense[-1] * (unigram[tied] / unigram[tied].sum())[:, None]
        model = model.updated(dense.ravel())
    untied = rows.filter("i is null").select("h", F.round("c").cast("long").alias("c"), "q")
    share = [F.shiftright("q", BITS * j).bitwiseAND(F.lit(PARTS).cast("long")) for j in range(k - 1)]
    sums = untied.agg(F.sum("c"), *[F.sum(F.col("c") * x / PARTS) for x in share]).first()
    total = np.array([x or 0.0 for x in sums], float)
    return model, np.append(total[1:], total[0] - total[1:].sum()), untied


def score(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for ``docs`` with columns doc_id,
    text and held_out (false: learned from)."""
    sc = docs.sparkSession.sparkContext
    counts = count_words(docs.filter(~F.col("held_out")))
    ends = F.sum(F.when(F.col("h") == int(END), F.col("c")))  # few texts of many words: not always a frequent one
    n, v, end_c = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.coalesce(ends, F.lit(0))).first()
    top = frequent(counts, KNOWN)
    voc = Vocabulary(np.array([r["h"] for r in top], np.int64).view(U), np.array([r["c"] for r in top], np.int64),
                     int(n), int(v), int(end_c))
    encoded = encode(docs, sc.broadcast(voc))
    trained, total, untied = train(encoded, voc.start)
    model = sc.broadcast(trained)
    k, other, mass = len(total), voc.other, voc.mass

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = model.value
        n_symbols = len(hmm.emit)
        for batch in batches:
            for part in slices(batch, "symbols"):
                d, length = part.num_rows, part.column("n_tokens").to_numpy(zero_copy_only=False)
                symbols = np.concatenate([expand(x, m) for x, m in zip(part.column("symbols"), length)]).astype(np.int64)
                size = pc.fill_null(pc.list_value_length(part.column("words")), 0).to_numpy(zero_copy_only=False)
                words = part.column("words").flatten()
                h, c, q = (np.nan_to_num(words.field(x).fill_null(0).to_numpy(zero_copy_only=False)) for x in ("h", "c", "q"))
                order = np.lexsort((h, np.repeat(np.arange(d), size)))  # as encode numbered them
                c, q = c[order], q[order]
                weight = by_state(c, q, k) + PRIOR * (c + ADD)[:, None]
                doc, rare = np.repeat(np.arange(d), length), np.flatnonzero(symbols >= other)
                doc = doc[rare]
                place = symbols[rare] - other + (np.cumsum(size) - size)[doc]
                symbols[rare] = n_symbols + place
                seen = np.bincount(doc, c[place] > 0, minlength=d)
                base = part.column("log_found").to_numpy(zero_copy_only=False) - length * voc_total
                base = base + np.bincount(doc, np.log10(c[place] + ADD), minlength=d)
                own = hmm.log10(symbols, length, weight / (total + PRIOR * mass) * hmm.emit[other]) if n else base
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), part.column("n_tokens"),
                     pa.array(part.column("n_found").to_numpy(zero_copy_only=False) + seen.astype(np.int64)),
                     pa.array(np.full(d, n, np.int64)), pa.array(base), pa.array(own)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    n, voc_total = int(n), float(voc.log_total)
    return encoded.drop("rare").join(other_words(encoded, untied), "row", "left").mapInArrow(
        forward, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
