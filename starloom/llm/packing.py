"""Sequence packing: shortest pack first over the histogram of piece lengths, placed again by rank.

1. ``tokenized``: each text becomes ids and an end id, cut every ``width`` ids; the pieces (ids, start, length) are stored with
   the number of their task and, per length, their number within it.
2. The histogram of lengths (at most ``width`` rows, whatever the corpus) comes to the driver.  ``plan`` places lengths
   longest first, each into the shortest open pack that it fits, updating how many packs follow each pattern instead of
   packs one by one; a pattern is (how many packs, which ranks of which lengths).  So the work and the plan depend
   on ``width``, not on the corpus.
3. Packs with room left are topped up: packs of the emptiest pattern are taken apart, cut where needed, to fill those of the
   fullest one.  One last open pack remains at most; it is cut into powers of two.  So no sequence needs padding.
4. Pieces get their rank among all pieces of their length (their number within the task, and the counts of the tasks
   before), and the plan says for each length and range of ranks where a piece, or each part of it, lies.

A plan has at most 2 * width patterns of fewer than ``width`` pieces each, and stops growing:
24,000 rows for 10^9 ids of 2048 lengths, 1.6 million (115 MB) from 10^12 on.  It is sent to the tasks as numbers.

Ids are those of ``tokenizers`` on the whole text.  A chunk (white space apart, a word with the space before it) never shares a
pre-token of the byte-level pattern with its neighbours, so chunks are encoded once and remembered; a chunk of any length is encoded
whole.  Texts of ASCII and Latin letters alone, and such chunks of others, go through ``tiktoken``, which merges the same ranks faster, if
``same_ranks`` has shown of the vocabulary that this gives the same ids; all else goes through ``tokenizers``.  Null and empty texts are the end id alone; documents may repeat, and rows without a doc_id are packed as well.  Other
columns are left out, whatever their names.  An empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import scratch_table, store

WIDTH = 2048
END = 1
CACHED = 1_500_000  # chunks remembered by a worker process, about 330 MB
SEGMENT = 1 << 20  # characters (or chunks of a longer text) encoded at a time
FLUSH = 8 << 20

_W = "\t-\r \x85\xa0  -     　"  # White_Space of Unicode
_L = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Boundaries of the byte-level pattern, coarser: letters up to a plain mark, else what no white space parts.
_CHUNK = re.compile(f" ?[{_L}]++(?=[,.;:!?)\"{_W}]|\\Z)| ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")


#: Chunks whose characters every version of Unicode classes alike, and that hold no added token's first characters.
_PLAIN = re.compile("(?!.*<\\|) ?[!-~À-ÖØ-öø-ÿ]+")
#: Texts of such characters alone.
_SIMPLE = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ]*+")
#: Fixed value: the pre-token pattern of the byte-level kind.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: visible Latin-1 characters are themselves, the others follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def same_ranks(path: str, encoder) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level BPE vocabulary for which merging by the id of the result is merging by the list of pairs;
    None if that is not certain.

    Pairs must be listed in the order of their ids, and every token must be what its own bytes become.  Then no two other
    neighbours can ever form a token: up to the first such pair both ways merge alike, inside the token's bytes as in these
    bytes alone, and there the only last pair is the listed one.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and spec["normalizer"] is None and spec["post_processor"] is None
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
             and all(t["content"].startswith("<|") and not t["lstrip"] for t in spec["added_tokens"]))
    if not plain:
        return None
    vocab, byte_of = model["vocab"], _byte_of()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocab["".join(p)] for p in pairs]
    if (any(a >= b for a, b in zip(ids, ids[1:])) or set(vocab) != {"".join(p) for p in pairs} | set(byte_of)
            or max(vocab[c] for c in byte_of) >= min(ids, default=len(vocab))
            or any([t.id for t in encoder.model.tokenize(w)] != [i] for w, i in vocab.items())):
        return None
    return {bytes(map(byte_of.__getitem__, w)): i for w, i in vocab.items()}


class Ids(dict):
    """Chunk -> its ids as little-endian 32-bit numbers; chunks met for the first time are encoded together."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core only
        from tokenizers import Tokenizer
        super().__init__()
        self.encoder = Tokenizer.from_file(path)
        (self.line,) = self.encoder.encode("\n", add_special_tokens=False).ids
        added = [re.escape(t.content) for t in self.encoder.get_added_tokens_decoder().values()]
        self.added = re.compile(f"({'|'.join(sorted(added, key=len, reverse=True))})") if added else None
        self.fast = None
        if ranks := same_ranks(path, self.encoder):
            import tiktoken
            self.fast = tiktoken.Encoding("bytes", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def lines(self, chunks: list[str], encode) -> list[str]:
        """Remember chunks from one text of a line each; those that this could not tell apart come back."""
        ids = np.array(encode("\n".join(chunks)), "<u4")
        edge = np.flatnonzero(ids == self.line)
        if not chunks or len(edge) != len(chunks) - 1:
            return chunks
        raw, at = ids.tobytes(), 0
        for c, e in zip(chunks, [*edge.tolist(), len(ids)]):
            self[c] = raw[4 * at:4 * e]
            at = e + 1
        return []

    def learn(self, chunks: Iterable[str]) -> None:
        """Encode the new chunks in one text, a line each: a line feed between visible characters is a token by itself."""
        new = set(chunks).difference(self)
        if len(self) + len(new) > CACHED:
            self.clear()
            new = set(chunks)
        if self.fast is not None:
            simple = [c for c in new if _PLAIN.fullmatch(c)]
            new.difference_update(simple)
            new.update(self.lines(simple, self.fast.encode_ordinary))
        plain = [c for c in new if c[-1].isprintable() and c[-1] != " " and c[c[0] == " "].isprintable()]
        new.difference_update(plain)
        new.update(self.lines(plain, lambda text: self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids))
        rest = list(new)  # white space, unusual first or last characters
        for c, e in zip(rest, self.encoder.encode_batch_fast(rest, add_special_tokens=False)):
            self[c] = np.array(e.ids, "<u4").tobytes()

    def whole(self, text: str) -> bytes | None:
        """The ids of a simple text, encoded as it is: nothing of it is remembered; None for other texts."""
        if self.fast is None or "<|" in text or not _SIMPLE.fullmatch(text):
            return None
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def chunks(self, text: str) -> Iterator[str]:
        """An added token ends what stands before it: white space there belongs together."""
        parts = [text] if self.added is None else self.added.split(text)
        for k, part in enumerate(parts):
            if k % 2:
                yield part
            else:
                yield from (m[0] for m in _CHUNK.finditer(part))

    def texts(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of some texts, learning their chunks at once."""
        chunks = [list(self.chunks(x)) for x in texts]
        self.learn(set().union(*chunks))
        return [b"".join(map(self.__getitem__, x)) for x in chunks]

    def long_text(self, text: str) -> bytes:
        """The same for a text whose chunks are not held all at once."""
        out, found = [], self.chunks(text)
        while chunks := list(islice(found, SEGMENT)):
            self.learn(chunks)
            out.append(b"".join(map(self.__getitem__, chunks)))
        return b"".join(out)


_KEPT: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The chunks that this worker process remembers, from earlier tasks as well."""
    if path not in _KEPT:
        _KEPT[path] = Ids(path)
    return _KEPT[path]


def _encoded(encode: Ids, batch: pa.RecordBatch) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids) of the rows of a batch, some characters at a time."""
    docs, texts, size = [], [], 0
    for doc, text in zip(batch.column(0), batch.column(1)):
        text = text.as_py() or ""
        ids = encode.whole(text)
        if ids is not None:
            yield doc.as_py(), ids
            continue
        if len(text) > SEGMENT:
            yield doc.as_py(), encode.long_text(text)
            continue
        docs.append(doc.as_py())
        texts.append(text)
        size += len(text)
        if size > SEGMENT:
            yield from zip(docs, encode.texts(texts))
            docs, texts, size = [], [], 0
    yield from zip(docs, encode.texts(texts))


def tokenized(docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, task, number): ids cut every ``width``, numbered per length in a task."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, met = ids_of(tokenizer), defaultdict(int)
        task = TaskContext.get().partitionId()
        cols: list[list] = [[] for _ in range(6)]
        held = 0

        def give() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
            out = [pa.array(c, t) for c, t in zip(cols, types)]
            for c in cols:
                c.clear()
            return pa.RecordBatch.from_arrays([*out, pa.array([task] * len(out[0]), pa.int32())],
                                              names=["doc_id", "start", "length", "ids", "doc_tokens", "number", "task"])

        for batch in batches:
            for doc, ids in _encoded(encode, batch):
                ids += tail
                n = len(ids) // 4
                for a in range(0, n, width):
                    length = min(width, n - a)
                    for c, v in zip(cols, (doc, a, length, ids[4 * a:4 * (a + length)], n, met[length])):
                        c.append(v)
                    met[length] += 1
                    held += 4 * length
                    if held > FLUSH:
                        yield give()
                        held = 0
        if cols[0]:
            yield give()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, start long, length int, ids binary, doc_tokens long, number long, task int")


@dataclass
class Pattern:
    """``count`` packs alike: pack i holds, of each part (length, rank, start, size), ``size`` ids from ``start`` of piece rank + i."""

    count: int
    parts: list[tuple[int, int, int, int]]

    def split(self, n: int) -> tuple["Pattern", "Pattern"]:
        """The first n packs, and the others."""
        return (Pattern(n, self.parts), Pattern(self.count - n, [(ln, r + n, s, z) for ln, r, s, z in self.parts]))

    def cut(self, a: int, b: int) -> list[tuple[int, int, int, int]]:
        """The parts of each pack's ids from a to b."""
        out, at = [], 0
        for ln, r, s, z in self.parts:
            lo, hi = max(a, at), min(b, at + z)
            if lo < hi:
                out.append((ln, r, s + lo - at, hi - lo))
            at += z
        return out


class Plan:
    """Where pieces lie: rows (length, rank, count, start, size, sequence, step, offset, times).

    Piece rank + i (i < count) of that length gives, for each u < times, its ids from start + u * size on (size of them) to
    sequence + i * step + u, at offset.
    """

    def __init__(self, histogram: dict[int, int], width: int = WIDTH):
        self.width, self.sequences = width, 0
        self.rows: list[tuple[int, ...]] = []
        self.top_up(self.shortest_first(histogram))

    def place(self, count: int, parts: list, offset: int, first: int) -> None:
        for ln, r, s, z in parts:
            self.rows.append((ln, r, count, s, z, first, 1, offset, 1))
            offset += z

    def fill(self, full: Pattern, used: Pattern, each: int, room: int) -> None:
        """Finish the packs of ``full``: every pack of ``used`` fills the room of ``each`` of them in turn."""
        first, offset = self.sequences, self.width - room
        self.finish(full)
        at = 0
        for ln, r, s, z in used.parts:
            end = min(at + z, each * room)
            while at < end:
                t, inside = divmod(at, room)
                size = min(room - inside, end - at)
                times = (end - at) // room if size == room else 1
                self.rows.append((ln, r, used.count, s, size, first + t, each, offset + inside, times))
                s, at = s + size * times, at + size * times

    def finish(self, p: Pattern) -> None:
        self.place(p.count, p.parts, 0, self.sequences)
        self.sequences += p.count

    def shortest_first(self, histogram: dict[int, int]) -> dict[int, list[Pattern]]:
        """Open patterns by the room left."""
        room: dict[int, list[Pattern]] = defaultdict(list)
        for length in sorted(histogram, reverse=True):
            rank, left = 0, histogram[length]
            most = self.width  # room never grows while one length is placed
            while left:
                while most >= length and not room.get(most):
                    most -= 1
                if most >= length:
                    p = room[most].pop()
                    free = most - length
                    if p.count > left:
                        p, rest = p.split(left)
                        room[most].append(rest)
                else:
                    p, free = Pattern(left, []), self.width - length
                p = Pattern(p.count, [*p.parts, (length, rank, 0, length)])
                rank, left = rank + p.count, left - p.count
                if free:
                    room[free].append(p)
                else:
                    self.finish(p)
        return room

    def top_up(self, room: dict[int, list[Pattern]]) -> None:
        """Fill the open packs with ids of others: first within each pattern, then the few packs left between patterns."""
        width = self.width
        open_: dict[int, list[Pattern]] = {}
        work = [(k, p) for k, v in room.items() for p in v]
        while work:
            k, p = work.pop()
            size = width - k
            m = max(1, size // k)  # packs that one fills
            groups = p.count // (m + 1)
            if not groups:
                open_.setdefault(k, []).append(p)
                continue
            full, rest = p.split(m * groups)
            used, rest = rest.split(groups)
            if rest.count:
                open_.setdefault(k, []).append(rest)
            if size <= k:
                made, left = Pattern(groups, [*full.parts, *used.parts]), k - size
            else:
                self.fill(full, used, m, k)
                made, left = Pattern(groups, used.cut(m * k, size)), k + m * k
            if left == 0:
                self.finish(made)
            elif left < width:
                work.append((left, made))

        def take(k: int) -> Pattern:
            p = open_[k].pop()
            if not open_[k]:
                del open_[k]
            return p

        def put(p: Pattern, k: int) -> None:
            if p.count and k == 0:
                self.finish(p)
            elif p.count and k < width:
                open_.setdefault(k, []).append(p)

        while open_:
            k = min(open_)
            full = take(k)
            if open_:
                donor_room = max(open_)
                donor = take(donor_room)
            elif full.count > 1:
                donor_room, (donor, full) = k, full.split(1)
            else:
                self.powers(full, width - k)
                return
            size = width - donor_room
            if size <= k:  # whole packs fit
                n = min(full.count, donor.count)
                full, rest = full.split(n)
                put(rest, k)
                used, rest = donor.split(n)
                put(rest, donor_room)
                put(Pattern(n, [*full.parts, *used.parts]), k - size)
                continue
            fills = size // k
            n, each = (1, full.count) if full.count < fills else (min(donor.count, full.count // fills), fills)
            full, rest = full.split(n * each)
            put(rest, k)
            used, rest = donor.split(n)
            put(rest, donor_room)
            self.fill(full, used, each, k)
            put(Pattern(n, used.cut(each * k, size)), donor_room + each * k)

    def powers(self, p: Pattern, size: int) -> None:
        at = 0
        while at < size:
            z = 1 << ((size - at).bit_length() - 1)
            self.finish(Pattern(1, p.cut(at, at + z)))
            at += z


class Places:
    """The plan of one length, by rank."""

    def __init__(self, rows: np.ndarray):
        rank, count = rows[:, 1], rows[:, 2]
        self.edges = np.unique(np.concatenate((rank, rank + count)))
        lo, hi = np.searchsorted(self.edges, rank), np.searchsorted(self.edges, rank + count)
        self.parts: list[list[tuple[int, ...]]] = [[] for _ in self.edges]
        for row, a, b in sorted(zip(rows.tolist(), lo, hi), key=lambda x: x[0][3]):
            for i in range(a, b):
                self.parts[i].append(tuple(row))

    def find(self, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, size, sequence, offset) of each part of the piece with that rank."""
        for _, first, _, s, z, sequence, step, offset, times in self.parts[int(np.searchsorted(self.edges, rank, "right")) - 1]:
            sequence += (rank - first) * step
            for u in range(times):
                yield s + u * z, z, sequence + u, offset


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH, end: int = END) -> DataFrame:
    """Pieces (doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset) of all texts."""
    spark = docs.sparkSession
    pieces = scratch_table(tokenized(docs, tokenizer, width, end), "pieces")
    counts = store(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # width rows
    table = np.array(Plan(histogram, width).rows, np.int64).reshape(-1, 9)
    sent = spark.sparkContext.broadcast(table[np.argsort(table[:, 0], kind="stable")])
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("length").alias("l2"), F.col("task").alias("t2"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, (F.col("length") == F.col("l2")) & (F.col("task") == F.col("t2")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, places = sent.value, {}
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            length, rank = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            ids = batch.column(3)
            for i, (ln, r, doc, start, n) in enumerate(zip(length.tolist(), rank.tolist(), batch.column(0).to_pylist(),
                                                           batch.column(1).to_pylist(), batch.column(4).to_pylist())):
                if ln not in places:
                    a, b = np.searchsorted(rows[:, 0], [ln, ln + 1])
                    places[ln] = Places(rows[a:b])
                raw = ids[i].as_py()
                for s, z, sequence, offset in places[ln].find(r):
                    for c, v in zip(out, (doc, start + s, z, raw[4 * s:4 * (s + z)], n, sequence, offset)):
                        c.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return ranked.select("doc_id", "start", "length", "ids", "doc_tokens", (F.col("base") + F.col("number")).alias("rank")).mapInArrow(
        run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
