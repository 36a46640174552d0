"""Chat formatting by incremental black-box rendering.

A template is any function from turns [(role, text), ...] to one string.  ``locate`` renders the prefixes
of a conversation one after another and compares consecutive outputs: what a prefix adds is the new
turn's span.  A prefix whose output does not begin with the previous output shows that the template
rewrites history; spans of such a conversation are not to be trusted and it is flagged.  Every whole prefix is rendered, however
long the conversation, unless the template declares by ``reach`` how many turns back a turn's rendering looks: then prefixes
begin a block of turns before instead (``locate``).  Rendering a turn twice more, with two probe texts that differ in their only character, tells its own text from the markers
around it: what both share at their start and their end are the markers, whatever text or markers begin with.

``MarkerTemplate`` is the template of the registered query.  Every turn is "### role: text</turn>" and a line
feed; a backslash goes before each backslash, before the first character of a control string inside a
text and before the characters that end a role, so ``parse`` reads every turn back unchanged.

Rows of a conversation are ordered by turn, ties by role and text; null texts, roles and turns count as
empty (null turns first).  Rows without a conv_id form one conversation.  Repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[Sequence[Turn]], str]


class MarkerTemplate:
    reach = 0  # a turn's rendering depends on no turn before it, and changes none
    head, colon, tail = "### ", ": ", "</turn>\n"
    _control = re.compile(r"\\|(?=###)|(?=</turn>)")
    _role = re.compile(r"([\\:#\n<])")
    _turn = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)

    def __init__(self):
        self._done: dict[Turn, str] = {}  # turns rendered lately: prefixes render the same ones again and again

    def escape(self, text: str) -> str:
        return self._control.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.S)

    def turn(self, t: Turn) -> str:
        out = self._done.get(t)
        if out is None:
            if len(self._done) > 10_000:
                self._done.clear()
            role = self._role.sub(r"\\\1", t[0])
            out = self._done[t] = f"{self.head}{role}{self.colon}{self.escape(t[1])}{self.tail}"
        return out

    def __call__(self, turns: Sequence[Turn]) -> str:
        return "".join(map(self.turn, turns))

    def parse(self, out: str) -> list[Turn]:
        """The turns of a formatted conversation."""
        turns, at = [], 0
        while at < len(out):
            m = self._turn.match(out, at)
            if m is None:
                raise ValueError(f"no turn at {at}")
            turns.append((self.unescape(m[1]), self.unescape(m[2])))
            at = m.end()
        return turns


@dataclass(frozen=True)
class Rendered:
    text: str
    spans: list[tuple[int, int]]  # of each turn
    contents: list[tuple[int, int]]  # of each turn's text, markers left out
    rewrites: bool  # an earlier part changed when a turn was added


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


PROBES = ("x", "q")  # no template escapes them


#: Turns of a block, or a template's ``reach`` if that is more; prefixes are rendered from the start of the block before on.
BLOCK = 32


def _step(render: Template, turns: Sequence[Turn], before: str) -> tuple[str, int, tuple[int, int], bool]:
    """Rendering with the last of ``turns`` added to ``before``, the rendering without it: output, where the turn starts, its
    text's place, whether ``before`` changed."""
    out = render(turns)
    rewrites = not out.startswith(before)
    start = _common(before, out) if rewrites else len(before)
    one, two = (render([*turns[:-1], (turns[-1][0], p)]) for p in PROBES)
    shared = start if one.startswith(before[:start]) and two.startswith(before[:start]) else 0
    # markers around the text: what the probes share at their start and their end
    marker = shared + _common(one[shared:], two[shared:])
    right = _common(one[marker:][::-1], two[marker:][::-1])
    left = min(max(start, marker), len(out))
    return out, start, (left, max(left, len(out) - right)), rewrites


def _locate_whole(render: Template, turns: Sequence[Turn]) -> Rendered:
    before, spans, contents, rewrites = render([]), [], [], False
    for k in range(1, len(turns) + 1):
        before, start, content, changed = _step(render, turns[:k], before)
        spans.append((start, len(before)))
        contents.append(content)
        rewrites = rewrites or changed
    return Rendered(before, spans, contents, rewrites)


def _locate_blocks(render: Template, turns: Sequence[Turn], block: int) -> Rendered | None:
    """Prefixes that begin a block before their own block instead of at the first turn; None if a part of one changed, or if
    what they add is not what whole prefixes hold."""
    head = render([])
    parts, spans, contents, total, check = [head], [], [], len(head), 2 * block
    for first in range(0, len(turns), block):
        since = max(0, first - block)
        before = render(turns[since:first])
        for k in range(first + 1, min(first + block, len(turns)) + 1):
            shift = total - len(before)
            out, start, (left, right), changed = _step(render, turns[since:k], before)
            if changed:
                return None
            spans.append((start + shift, len(out) + shift))
            contents.append((left + shift, right + shift))
            parts.append(out[len(before):])
            total += len(parts[-1])
            before = out
            if k == check or k == len(turns):  # whole prefixes of twice the length each: as many turns again, all in all
                check *= 2
                parts = ["".join(parts)]
                if render(turns[:k]) != parts[0]:
                    return None
    return Rendered(parts[0], spans, contents, False)


def locate(render: Template, turns: Sequence[Turn], block: int | None = BLOCK) -> Rendered:
    """Output of the whole conversation, and each turn's span and text in it.

    ``block`` is for templates whose rendering of a turn looks back at most so many turns and changes none of the earlier ones: prefixes
    begin a block before the turn's own, so that work grows with the number of turns.  Whole prefixes at two blocks, at
    four, eight, ... and at the end are rendered to test that: their output must be what the blocks gave.  Where that fails, or where a prefix
    changes what stood before, every whole prefix is rendered and compared (work grows with the square of the turns).
    ``block=None`` assumes nothing of the template and renders every whole prefix.  The length of a conversation plays no part in the choice.
    """
    found = None if block is None else _locate_blocks(render, turns, block)
    return found or _locate_whole(render, turns)


def _block(render: Template) -> int | None:
    """``block`` of a template: it may be rendered in blocks only if it declares its ``reach``."""
    reach = getattr(render, "reach", None)
    return None if reach is None else max(BLOCK, reach)


def format_conversations(rows: DataFrame, template: Callable[[], Template] = MarkerTemplate,
                         loss_roles: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns (role, start, end, text_start, text_end, loss), rewrites.

    A template without a ``reach`` has every whole prefix of a conversation rendered: exact at every length, and work that grows
    with the square of the turns.
    """
    turn = F.struct(F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text"), F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())]))
    roles = set(loss_roles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = template()
        block = _block(render)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                text, where, rewrites = [], [], []
                for turns in part.column("turns").to_pylist():
                    pairs = [(t["role"], t["text"]) for t in turns]
                    r = locate(render, pairs, block)
                    text.append(r.text)
                    rewrites.append(r.rewrites)
                    where.append([dict(role=p[0], start=s[0], end=s[1], text_start=c[0], text_end=c[1],
                                       loss=p[0] in roles) for p, s, c in zip(pairs, r.spans, r.contents)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(text, pa.string()), pa.array(where, spans), pa.array(rewrites, pa.bool_())],
                    names=["conv_id", "formatted", "turns", "rewrites"])

    return whole.mapInArrow(run, "conv_id long, formatted string, turns array<struct<role:string,start:long,end:long,"
                                 "text_start:long,text_end:long,loss:boolean>>, rewrites boolean")


def read_back(formatted: DataFrame, template: Callable[[], MarkerTemplate] = MarkerTemplate) -> DataFrame:
    """Digest columns of formatted conversations, from the formatted text and the loss mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = template()
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for out, spans in zip(batch.column("formatted").to_pylist(), batch.column("turns").to_pylist()):
                turns = t.parse(out)
                loss = "".join(t.unescape(out[s["text_start"]:s["text_end"]]) for s in spans if s["loss"])
                cols["n_turns"].append(len(turns))
                cols["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest())
                cols["loss_chars"].append(len(loss))
                cols["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
                cols["formatted_chars"].append(len(out))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *map(pa.array, cols.values()), batch.column("rewrites")],
                                             names=["conv_id", *cols, "rewrites"])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long, rewrites boolean")
