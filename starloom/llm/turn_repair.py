"""Conversation structure repair by a Viterbi search whose survivors coalesce.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``.  ``repair`` finds the cheapest edits that
make it so: Keep (0), Rerole to user or assistant (3), Delete (4, the only choice for a blank or repeated turn), Insert an
empty turn of user or assistant (3); a truncated turn that stays costs 3 more.  Of equally cheap edits the ASCII-least
string of initials wins.

The search has four states (nothing yet, after s, after u, after a), so at most four survivors.  A step consumes one turn:
some Inserts, then Keep, Rerole or Delete.  As every step ends with a letter other than I, no survivor's edits begin
another's, and the order of two survivors is settled where their complete edits first differ; ``Survivors`` keeps that order
as ranks, which one comparison of (rank of the parent, letters of the step) carries on.  Edits that are not yet decided
form a tree of back-pointers whose nodes count their living branches: a node without any is dropped with its parents' count,
a node with one is joined to it, and what all survivors share is given out at once.  So a task holds undecided turns only.
A digest needs no more than ``PENDING`` bytes of them: beyond that each survivor carries a digest of its own.

Rows of a conversation are taken by turn (nulls first), ties by role and text.  Equal rows are counted before the shuffle,
so a group of repeated rows is one row.  The rows of one conversation go through one task in order, because its digest is
one SHA-256 of all its text; they are sorted by Spark (which spills) and streamed, never collected.  Null roles and texts
count as one space, and so do null ids and turns where the damage is drawn; an empty role has no initial to keep.  Rows without a conv_id are one conversation.
Other columns are left out, whatever their names.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
PENDING = 4 << 20
STARTS, AFTER_S, AFTER_U, AFTER_A = range(4)
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
_NEXT = {("s", STARTS): AFTER_S, ("u", STARTS): AFTER_U, ("u", AFTER_S): AFTER_U, ("u", AFTER_A): AFTER_U, ("a", AFTER_U): AFTER_A}
_TURN = {STARTS: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}  # the only user or assistant turn that fits
#: What a survivor in the first state needs at most to go on as one in the second; one that costs more than that is dropped.
_BRIDGE = {(STARTS, AFTER_S): 0, (AFTER_A, AFTER_S): 0, (AFTER_U, AFTER_S): 3, (AFTER_A, STARTS): 4, (AFTER_U, STARTS): 7,
           (AFTER_S, STARTS): 6, (AFTER_A, AFTER_U): 3, (AFTER_S, AFTER_U): 3, (STARTS, AFTER_U): 3, (AFTER_U, AFTER_A): 3,
           (AFTER_S, AFTER_A): 6, (STARTS, AFTER_A): 0}
_WHITE = "\x20\t\n\v\f\r"


def _choices(state: int, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, letters) of every way to consume a turn: inserts, then one edit."""
    extra, at = TRUNCATED if truncated else 0, state
    for k in range(3):
        ins, cost = "I" * k, k * INSERT
        yield at, cost + DELETE, ins + "D"
        if not must_go:
            if (initial, at) in _NEXT:
                yield _NEXT[initial, at], cost + KEEP + extra, ins + "K"
            yield _TURN[at], cost + REROLE + extra, ins + "R"
        at = _TURN[at]


_STEPS: dict = {}  # (costs above the least, ranks, kind of turn) -> what a step makes of them: few, as costs stay close


def _step(costs: tuple, ranks: tuple, kind: tuple) -> tuple[int, tuple, tuple, tuple]:
    """(least cost, costs above it, ranks, back) with back[state] = (former state, letters); None for a dead state."""
    key = (costs, ranks, kind)
    if key not in _STEPS:
        best: dict[int, tuple] = {}
        for s, c in enumerate(costs):
            if c is not None:
                for to, cost, letters in _choices(s, *kind):
                    new = (c + cost, (ranks[s], letters), s)
                    if to not in best or new < best[to]:
                        best[to] = new
        least = min(b[0] for b in best.values())
        best = {s: b for s, b in best.items()  # what another survivor can always do for less is dead
                if not any(best[t][0] + more < b[0] for (t, to), more in _BRIDGE.items() if to == s and t in best)}
        order = sorted(best, key=lambda s: best[s][1])
        _STEPS[key] = (least, tuple(best[s][0] - least if s in best else None for s in range(4)),
                       tuple(order.index(s) if s in best else None for s in range(4)),
                       tuple((best[s][2], best[s][1][1]) if s in best else None for s in range(4)))
    return _STEPS[key]


@dataclass(eq=False)
class _Node:
    """A back-pointer: the edits since the parent, and the branches still alive (their number is the reference count)."""

    parent: "_Node | None"
    letters: bytearray = field(default_factory=bytearray)
    branches: list["_Node"] = field(default_factory=list)


class Survivors:
    """The search over one conversation; ``push`` returns the edits that are decided by then, ``close`` the others."""

    def __init__(self):
        self.cost, self.costs, self.ranks = 0, (0, None, None, None), (0, None, None, None)
        self.root = _Node(None)
        self.leaf: list[_Node | None] = [_Node(self.root), None, None, None]
        self.root.branches.append(self.leaf[0])

    def push(self, kind: tuple) -> bytes:
        least, self.costs, self.ranks, back = _step(self.costs, self.ranks, kind)
        self.cost += least
        children: dict[int, list[int]] = {}
        for s, b in enumerate(back):
            if b is not None:
                children.setdefault(b[0], []).append(s)
        leaf: list[_Node | None] = [None] * 4
        for p, old in enumerate(self.leaf):
            if old is None:
                continue
            to = children.get(p)
            if to is None:
                self._drop(old)
            elif len(to) == 1:
                old.letters += back[to[0]][1].encode()
                leaf[to[0]] = old
            else:
                for s in to:
                    leaf[s] = _Node(old, bytearray(back[s][1].encode()))
                    old.branches.append(leaf[s])
        self.leaf = leaf
        return self._decided()

    def _drop(self, node: _Node) -> None:
        parent = node.parent
        parent.branches.remove(node)
        if not parent.branches:
            self._drop(parent)
        elif len(parent.branches) == 1 and parent.parent is not None:  # join the only branch to its parent's edits
            only = parent.branches[0]
            above = parent.parent
            parent.letters += only.letters
            only.letters, only.parent = parent.letters, above
            above.branches[above.branches.index(parent)] = only

    def _decided(self) -> bytes:
        out = b""
        while len(self.root.branches) == 1:
            only = self.root.branches[0]
            if only.letters:
                out += bytes(only.letters)
                only.letters = bytearray()
            if not only.branches:
                break
            only.parent, self.root = None, only
        return out

    def close(self) -> tuple[int, bytes, bytes]:
        """(state of the best survivor, its undecided edits, the inserts that end it)"""
        ends = []
        for s, inserts in ((STARTS, 0), (AFTER_A, 0), (AFTER_U, 1), (AFTER_S, 2)):
            if self.leaf[s] is not None:
                ends.append((self.costs[s] + INSERT * inserts, (self.ranks[s], "I" * inserts), s))
        cost, (_, inserts), s = min(ends)
        self.cost += cost
        return s, self.path(s), inserts.encode()

    def path(self, s: int) -> bytes:
        """The undecided edits of a survivor."""
        out, node = [], self.leaf[s]
        while node is not self.root:
            out.append(bytes(node.letters))
            node = node.parent
        return b"".join(reversed(out))


class _Digest:
    """SHA-256 of the repaired turns ``role:text``, joined by line feeds, from edits as they are decided."""

    def __init__(self):
        self.sha, self.state, self.first = hashlib.sha256(), STARTS, True

    def copy(self) -> "_Digest":
        new = _Digest()
        new.sha, new.state, new.first = self.sha.copy(), self.state, self.first
        return new

    def apply(self, edits: bytes, turns: Iterator[tuple[str, str, str]]) -> None:
        """``turns`` gives (role, text, initial) of the turns that the edits consume."""
        for e in edits:
            if e == 73:  # I
                self.state = _TURN[self.state]
                self._add(ROLE[self.state], "")
                continue
            role, text, initial = next(turns)
            if e == 75:  # K
                self.state = _NEXT[initial, self.state]
                self._add(role, text)
            elif e == 82:  # R
                self.state = _TURN[self.state]
                self._add(ROLE[self.state], text)

    def _add(self, role: str, text: str) -> None:
        self.sha.update((f"{role}:{text}" if self.first else f"\n{role}:{text}").encode())
        self.first = False


class _Recorder(_Digest):
    """The edits themselves instead of a digest."""

    def __init__(self):
        super().__init__()
        self.done: list[tuple[str, str, str]] = []

    def apply(self, edits: bytes, turns: Iterator[tuple[str, str, str]]) -> None:
        for e in edits:
            letter = chr(e)
            role, text, initial = ("", "", "") if letter == "I" else next(turns)
            if letter == "K":
                self.state = _NEXT[initial, self.state]
            elif letter != "D":
                self.state = _TURN[self.state]
                role = ROLE[self.state]
            self.done.append((letter, role, text))


class _Conversation:
    """Counts, audit and digest of one conversation, fed turn by turn."""

    def __init__(self, digest: _Digest | None = None):
        self.search, self.audit, self.digest = Survivors(), bytearray(), digest or _Digest()
        self.low = self.high = None
        self.numbers = 0
        self.waiting: list[tuple[str, str, str]] = []  # turns whose edit is open
        self.bytes, self.forks = 0, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def number(self, turn: int | None) -> None:
        """Take note of a turn number (they come in order)."""
        if turn is not None and turn != self.high:
            self.low, self.high, self.numbers = turn if self.low is None else self.low, turn, self.numbers + 1

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.numbers

    def turn(self, role: str, text: str, seen: bool) -> None:
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        last = text.rstrip(_WHITE)[-1:]
        blank = not last
        cut = not blank and not seen and last not in ".!?"
        if blank:
            self.blank += 1
        elif seen:
            self.duplicate += 1
        elif cut:
            self.truncated += 1
        row = (role, text, initial)
        kind = (initial if initial in ("s", "u", "a") else "", blank or seen, cut)
        if self.forks is not None:
            back = _step(self.search.costs, self.search.ranks, kind)[3]
            forks = []
            for b in back:
                d = None
                if b is not None:
                    d = self.forks[b[0]].copy()
                    d.apply(b[1].encode(), iter((row,)))
                forks.append(d)
            self.forks = forks
            self.audit += self.search.push(kind)
            return
        self.waiting.append(row)
        self.bytes += len(text) + 64
        self._apply(self.search.push(kind))
        if self.bytes > PENDING and not isinstance(self.digest, _Recorder):
            self.forks = []
            for s, leaf in enumerate(self.search.leaf):
                d = None
                if leaf is not None:
                    d = self.digest.copy()
                    d.apply(self.search.path(s), iter(self.waiting))
                self.forks.append(d)
            self.waiting = []

    def _apply(self, edits: bytes) -> None:
        if edits:
            self.audit += edits
            used = len(edits) - edits.count(b"I")
            self.digest.apply(edits, iter(self.waiting))
            for _, text, _ in self.waiting[:used]:
                self.bytes -= len(text) + 64
            del self.waiting[:used]

    def close(self) -> tuple[int, str, str]:
        """(cost, audit, digest)"""
        state, rest, inserts = self.search.close()
        if self.forks is None:
            self._apply(rest + inserts)
        else:
            self.digest = self.forks[state]
            self.digest.apply(inserts, iter(()))
            self.audit += rest + inserts
        return self.search.cost, self.audit.decode(), self.digest.sha.hexdigest()


def damage(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, n) after the damage that the contract draws by crc32(conv_id:turn) mod 20.

    0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes its role user.  Equal rows are
    one row with their number n (0 for a dropped row, so that its conversation stays known).
    """
    rows = clean(rows)
    key = F.concat(_text(F.col("conv_id")), F.lit(":"), _text(F.col("turn")))
    draw = F.crc32(key) % 20
    text = F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "turn", F.when(draw == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(draw == 0, F.lit(0)).when(draw == 3, F.col("n") * 2).otherwise(F.col("n")).alias("n"))


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def clean(rows: DataFrame) -> DataFrame:
    """The four columns that count, null roles and texts as one space."""
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       _text(F.col("role")).alias("role"), _text(F.col("text")).alias("text"))


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows (a row stands for n equal ones) of each conversation in order, with the number of repeats among the n.

    One shuffle by conv_id serves the marking of repeated (role, text), the order and the search.
    """
    first = (F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("n") == 0, F.col("turn").asc_nulls_first())) == 1)
    # a row that is its text's first still holds n - 1 repeats, which follow it
    new = F.col("n") - F.when(first, F.lit(1)).otherwise(F.lit(0))
    marked = rows.repartition("conv_id").withColumn("__seen", new)
    ordered = marked.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text",
                                          F.col("n") == F.col("__seen"))
    return ordered.select("conv_id", "turn", "role", "text", "n", "__seen")


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, n): faults, cheapest edits, digest of the result.

    A conversation whose rows all have n = 0 is empty: zeros, no edits and the digest of the empty string.  ``gaps`` counts
    the turn numbers missing between the least and the largest.
    """
    return _ordered(rows).mapInArrow(_faults, RESULT)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns of ``rows``: conv_id, place (from 0, deleted turns included), edit, role, text.

    A deleted turn keeps its own role and text, with edit D.  Turns whose edit is open are held until the survivors share it.
    """
    return _ordered(rows).mapInArrow(_turns, "conv_id long, place long, edit string, role string, text string")


def _conversations(batches: Iterator[pa.RecordBatch], new) -> Iterator[tuple[int | None, _Conversation, bool]]:
    """(conv_id, conversation, whether it has ended) after every 512 rows and at each end."""
    at, talk = None, None
    for batch in batches:
        for part in (batch.slice(a, 512) for a in range(0, batch.num_rows, 512)):
            for conv, turn, role, text, n, repeats in zip(*(c.to_pylist() for c in part.columns)):
                if at is None or at[0] != conv:
                    if at is not None:
                        yield at[0], talk, True
                    at, talk = (conv,), new()
                if n:
                    talk.number(turn)
                    if n > repeats:
                        talk.turn(role, text, False)
                    for _ in range(repeats):
                        talk.turn(role, text, True)
            if at is not None:
                yield at[0], talk, False
    if at is not None:
        yield at[0], talk, True


def _faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RESULT.split(", ")]
    schema = pa.schema([(x, pa.string() if x in ("audit", "repaired_sha256") else pa.int64()) for x in names])
    out: list[tuple] = []

    def give() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return made

    for conv, talk, ended in _conversations(batches, _Conversation):
        if ended:
            cost, audit, sha = talk.close()
            out.append((conv, talk.gaps(), talk.blank, talk.duplicate, talk.truncated, talk.illegal, cost, audit, sha))
            if len(out) >= 1000 or len(audit) > 1 << 20:
                yield give()
    if out:
        yield give()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "place", "edit", "role", "text"]
    place = 0
    for conv, talk, ended in _conversations(batches, lambda: _Conversation(_Recorder())):
        if ended:
            talk.close()
        done, talk.digest.done = talk.digest.done, []
        if done:
            edit, role, text = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(done), pa.int64()), pa.array(range(place, place + len(done)), pa.int64()),
                 pa.array(edit, pa.string()), pa.array(role, pa.string()), pa.array(text, pa.string())], names=names)
        place = 0 if ended else place + len(done)
