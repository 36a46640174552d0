import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.llm import turn_repair
from starloom.llm.registry import QUERIES

GOOD = re.compile(r"(s?(ua)+)?\Z")
FULL = {"u": "user", "a": "assistant"}
BLACK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(turns):
    """All edit strings by growing cost, without states or survivors: (cost, audit, repaired turns)."""
    best = {}
    stack = [(0, "", (), 0)]
    limit = 4 * len(turns)  # deleting everything always works
    while stack:
        cost, audit, kept, i = stack.pop()
        if cost > limit:
            continue
        initials = "".join(r[:1] for r, _ in kept)
        if not re.match(r"s?(ua)*u?\Z", initials):
            continue
        if i == len(turns) and GOOD.match(initials):
            limit = min(limit, cost)
            if (cost, audit) not in best:
                best[cost, audit] = kept
        for r in FULL.values():
            stack.append((cost + 3, audit + "I", (*kept, (r, "")), i))
        if i < len(turns):
            role, text, must_go, cut = turns[i]
            stack.append((cost + 4, audit + "D", kept, i + 1))
            if not must_go:
                if role:  # an empty role has no initial that could be kept
                    stack.append((cost + 3 * cut, audit + "K", (*kept, (role, text)), i + 1))
                for r in FULL.values():
                    stack.append((cost + 3 + 3 * cut, audit + "R", (*kept, (r, text)), i + 1))
    (cost, audit), kept = min(best.items())
    return cost, audit, kept


def brute(rows, harm=True):
    """rows: (conv_id, turn, role, text) -> result rows of the contract."""
    say = lambda x: " " if x is None else str(x)
    convs = defaultdict(list)
    for c, t, r, x in rows:
        r, x = say(r), say(x)
        d = zlib.crc32(f"{say(c)}:{say(t)}".encode()) % 20 if harm else 9
        convs[c]
        if d == 0:
            continue
        x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
        convs[c] += [(t is not None, t or 0, "user" if d == 4 else r, x, t)] * (2 if d == 3 else 1)
    out = []
    for c, rs in convs.items():
        rs.sort()
        n = dict(blank=0, duplicate=0, truncated=0)
        seen, turns = set(), []
        for _, _, r, x, _ in rs:
            last = BLACK.findall(x)[-1:]
            fault = "blank" if not last else "duplicate" if (r, x) in seen else "truncated" if last[0] not in ".!?" else None
            if fault:
                n[fault] += 1
            seen.add((r, x))
            turns.append((r, x, fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [r[:1] for r, *_ in turns]
        numbers = {t for *_, t in rs if t is not None}
        cost, audit, kept = cheapest(turns)
        out.append((c, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, n["blank"], n["duplicate"], n["truncated"],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()))
    return out


def talks(seed, n):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(0, 5)):
            rows.append((c if c else None, rnd.choice([t, t, t, t + 3, None]), rnd.choice(["user", "assistant", "system", "tool", "", None, "user"]),
                         rnd.choice(["a.", "b", "c? ", "", "\n", "d! ", None, "e. f", "x" * 50 + "."])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,pending", [(1, 4 << 20), (2, 0), (3, 200)])
def test_repair(spark, tmp_path, monkeypatch, seed, pending):
    """Every column against all edit strings by brute force; small ``pending`` makes survivors carry their own digests."""
    monkeypatch.setattr(turn_repair, "PENDING", pending)
    rows = talks(seed, 150)
    spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(5)).withColumn("__seen", F.lit(1)) \
        .write.parquet(str(tmp_path / "conversations.parquet"))
    got = [tuple(r) for r in QUERIES["op13_turn_repair"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows), key=repr)


def test_steps_against_brute():
    rnd = random.Random(5)
    kinds = [(r, x, must, cut) for r, x in (("user", "p"), ("assistant", "q"), ("system", "r"), ("tool", "t"), ("", "v"))
             for must, cut in ((False, False), (False, True), (True, False))]
    for _ in range(400):
        turns = [rnd.choice(kinds) for _ in range(rnd.randint(0, 6))]
        s, audit = turn_repair.Survivors(), b""
        for r, _, must, cut in turns:
            audit += s.push((r[:1] if r[:1] in "sua" else "", must, cut))
        _, rest, inserts = s.close()
        want = cheapest(turns)
        assert (s.cost, (audit + rest + inserts).decode()) == want[:2]


def test_survivors_coalesce():
    """Undecided edits stay few when turns settle them; a run that stays open keeps every letter."""
    s = turn_repair.Survivors()
    done = b""
    for k in range(20_000):
        done += s.push(("ua"[k % 2], False, k % 7 == 0))
    assert len(done) > 19_990 and max(len(s.path(x)) for x in range(4) if s.leaf[x]) < 10
    s, done = turn_repair.Survivors(), b""
    for _ in range(20_000):  # roles that all have to change: two survivors until the end
        done += s.push(("", False, False))
    assert done + b"".join(s.close()[1:]) == b"R" * 20_000 and s.cost == 60_000
    assert len(turn_repair._STEPS) < 2_000


def test_open_run_digest(monkeypatch):
    monkeypatch.setattr(turn_repair, "PENDING", 1000)
    c = turn_repair._Conversation()
    for k in range(301):
        c.turn("tool", f"{k}.", False)
    cost, audit, sha = c.close()
    assert c.forks is not None and not c.waiting
    turns, state, k = [], 0, iter(range(301))
    for e in audit:
        if e == "D":
            next(k)
            continue
        turns.append(f"{('user', 'assistant')[state]}:" + ("" if e == "I" else f"{next(k)}."))
        state = 1 - state
    assert hashlib.sha256("\n".join(turns).encode()).hexdigest() == sha and cost == 904 and state == 0


def test_repaired_turns(spark):
    rows = talks(7, 120)
    df = turn_repair.clean(spark.createDataFrame(rows, SCHEMA)).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    got = defaultdict(list)
    for r in sorted(turn_repair.repaired(df).collect(), key=lambda r: r["place"]):
        got[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
    for c, *_, audit, sha in brute(rows, harm=False):
        edits = got.get(c, [])
        assert "".join(e for e, _, _ in edits) == audit
        assert hashlib.sha256("\n".join(f"{r}:{x}" for e, r, x in edits if e != "D").encode()).hexdigest() == sha


def test_hot_and_repeated(spark, tmp_path):
    """A third of all rows is one repeated row, another third one conversation of long texts."""
    rows = [(900, 0, "user", "hello.")] * 3000 + [(902, k, "user" if k % 2 == 0 else "assistant", "w" * 2000 + ".") for k in range(3000)] + talks(9, 800)
    # 900 and 902 are ids that the other conversations do not have
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in QUERIES["op13_turn_repair"](spark, str(tmp_path)).collect()}
    assert len(got) == len({r[0] for r in rows})
    assert zlib.crc32(b"900:0") % 20 > 4  # not damaged
    assert (got[900]["duplicate"], got[900]["illegal"], got[900]["cost"], got[900]["audit"]) == (2999, 2999, 11_999, "K" + "D" * 2999 + "I")
    assert len(got[902]["audit"]) >= 2000 and got[902]["gaps"] > 0


def test_empty(spark, empty_dir, edge_dir):
    assert QUERIES["op13_turn_repair"](spark, empty_dir).count() == 0
    assert QUERIES["op13_turn_repair"](spark, edge_dir).count() == 5
