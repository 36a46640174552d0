"""Long conversations in blocks, and templates that rewrite history."""

import random

import pytest

from starloom.llm import chat_format as C

TEXTS = ["a", "", "<b>", "</t", "### x", "\\", "q", "x", "long " * 50, "é😀\n"]


def turns(n, seed=1):
    rnd = random.Random(seed)
    return [(rnd.choice(["user", "assistant", "system"]), rnd.choice(TEXTS)) for _ in range(n)]


class Counting:
    def __init__(self, render):
        self.render, self.turns = render, 0

    def __call__(self, t):
        self.turns += len(t)
        return self.render(t)


def with_start(t):  # a head, and a first turn that is marked otherwise
    return "<s>" + "".join(f"{'[first]' if k == 0 else '[' + r + ']'}{x}[/]" for k, (r, x) in enumerate(t))


def with_previous(t):  # a turn says whom it answers
    return "".join(f"[{r} after {t[k - 1][0] if k else 'none'}]{x}[/]" for k, (r, x) in enumerate(t))


def numbered(t):
    return "".join(f"[{k} {r}]{x}[/]" for k, (r, x) in enumerate(t))


def only_last_thought(t):  # rewrites: earlier assistant texts are shortened
    return "".join(f"[{r}]{x if r != 'assistant' or k == len(t) - 1 else x[:1]}[/]" for k, (r, x) in enumerate(t))


def count_ahead(t):  # rewrites: the head holds the number of turns
    return f"{len(t)} turns: " + "".join(f"[{r}]{x}[/]" for r, x in t)


def far_back(t):  # rewrites the first turn once there are 100
    return "".join(f"[{r}]{'gone' if k == 0 and len(t) >= 100 else x}[/]" for k, (r, x) in enumerate(t))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 96, 97, 300])
@pytest.mark.parametrize("render", [C.MarkerTemplate(), with_start, with_previous, numbered])
def test_blocks_equal_whole_prefixes(render, n):
    got, want = C.locate(render, turns(n)), C.locate(render, turns(n), block=None)
    assert got == want and not got.rewrites and got.text == render(turns(n))


@pytest.mark.parametrize("n", [5, 64, 300])
@pytest.mark.parametrize("render", [only_last_thought, count_ahead])
def test_rewritten_history_is_flagged(render, n):
    talk = [("assistant", "two words"), *turns(n)]
    assert C.locate(render, talk).rewrites
    assert C.locate(render, talk) == C.locate(render, talk, block=None)


def test_a_change_far_back_is_found():
    assert not C.locate(far_back, turns(99)).rewrites
    assert C.locate(far_back, turns(300)).rewrites and C.locate(far_back, turns(100)).rewrites


def test_work_is_linear_in_turns():
    work = []
    for n in (2_000, 4_000, 8_000):
        render = Counting(C.MarkerTemplate())
        C.locate(render, turns(n))
        work.append(render.turns / n)
    assert max(work) < 200 and max(work) < 1.05 * min(work)


def test_a_very_long_turn_and_conversation(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", TEXTS[k % len(TEXTS)]) for k in range(5_000)] + [(2, 0, "assistant", "</turn>" * 400_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in C.read_back(C.format_conversations(df)).collect()}
    assert got[1]["n_turns"] == 5_000 and got[1]["loss_chars"] == sum(len(t) for _, _, r, t in rows[:-1] if r == "assistant")
    assert got[2]["loss_chars"] == 7 * 400_000 and not got[1]["rewrites"]


def test_rewriting_template_through_spark(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "bcd"), (1, 2, "user", "e"), (2, 0, "user", "a")],
                               "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["rewrites"] for r in C.format_conversations(df, lambda: only_last_thought).collect()}
    assert got == {1: True, 2: False}


def for_a_while(t):  # rewrites the first turn while there are 150 to 160, and takes it back
    return "".join(f"[{r}]{'gone' if k == 0 and 150 <= len(t) <= 160 else x}[/]" for k, (r, x) in enumerate(t))


def test_templates_are_exact_at_every_length(spark):
    sizes = [10, 149, 155, 161, 200, 256, 300]
    rows = [(n, k, "user" if k % 2 == 0 else "assistant", f"text {k}") for n in sizes for k in range(n)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in C.format_conversations(df, lambda: for_a_while).collect()}
    for n in sizes:
        want = C.locate(for_a_while, [(r, x) for c, _, r, x in rows if c == n], block=None)
        assert got[n]["rewrites"] == want.rewrites == (n >= 150)
        assert (got[n]["formatted"], [(s["start"], s["end"]) for s in got[n]["turns"]]) == (want.text, want.spans)


def test_only_a_declared_reach_is_rendered_in_blocks():
    class Far(C.MarkerTemplate):
        reach = 100

    assert (C._block(for_a_while), C._block(C.MarkerTemplate()), C._block(Far())) == (None, C.BLOCK, 100)
