"""Mixing sources to target word counts with balanced (cube) sampling.

Each source has a target.  With ratio r = target / size of the source, every document of it is
taken floor(r) times and once more with probability f = r - floor(r).  The cube method decides the
extra copies: in groups of documents of one source, the probabilities move along the null space of
two constraints (number of documents and number of words), so both totals stay put, until at most two
documents of a group are undecided.  These meet again in fewer groups, and so on; in the last, one
group per source, the constraints are dropped one by one (landing).

Groups hold ``GROUP`` documents on average whatever the source's size, so a hot source is spread over
many tasks.  The random numbers come from a hash of the group's documents: reruns agree.

Null texts have size 0.  Null sources form a source of their own, last in order.  Documents without
words are taken 0 times.  Repeated rows are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._tables import store, words

GROUP = 512
COPIES = 64  # rows of one key that stay together
BROADCAST_SOURCES = 100_000
EPS = 1e-9


def targets(sources: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Add ``target`` to a stored table (source, source_size), one row per source.

    Targets are min(most * size, level * weight) with the level that makes them add up to all sizes;
    the level is found by raising it until no further source reaches its limit.  Ranks need the
    sources in order: a window over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    src = store(sources.withColumn("sid", rank).withColumn("weight", w.cast("long"))
                .withColumn("cap", F.col("source_size") * most), "mix-sources")
    total, free = src.agg(F.sum("source_size"), F.sum("weight")).first()
    total, rest, free, last = total or 0, total or 0, free or 1, -1
    while True:  # each turn adds a source at its limit or ends
        full = F.col("cap") * F.lit(free) <= F.col("weight") * F.lit(rest)
        n, caps, weight = src.agg(F.count_if(full), F.sum(F.when(full, F.col("cap"))),
                                  F.sum(F.when(~full, F.col("weight")))).first()
        if n == last or not weight:
            break
        last, rest, free = n, total - (caps or 0), weight
    level = F.col("weight") * F.lit(rest) / F.lit(free)
    return src.withColumn("target", F.least(F.col("cap").cast("double"), level.cast("double"))).drop("cap")


def flight(p: np.ndarray, size: np.ndarray, draw: np.random.Generator, land: bool) -> np.ndarray:
    """Move probabilities to 0 or 1 keeping their sum and the sum of p * size.

    Three undecided documents a, b, c have the null vector (sc - sb, sa - sc, sb - sa); equal sizes
    leave (1, -1, 0).  Two documents of different sizes stay undecided unless ``land``.
    """
    p = p.astype(float).tolist()
    s = size.astype(float).tolist()
    queue = [i for i, x in enumerate(p) if EPS < x < 1 - EPS]
    nxt, act = min(3, len(queue)), queue[:3]
    while True:
        if len(act) == 3:
            a, b, c = act
            u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
        elif len(act) == 2 and (land or s[act[0]] == s[act[1]]):
            u = (1.0, -1.0)  # the word constraint goes first
        elif len(act) == 1 and land:
            u = (1.0,)  # then the number of documents
        else:
            break
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(act, u) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(act, u) if d)
        step = up if draw.random() * (up + down) < down else -down
        for i, d in zip(act, u):
            p[i] = min(1.0, max(0.0, p[i] + step * d))
        keep = []
        for i in act:
            if p[i] < EPS or p[i] > 1 - EPS:
                p[i] = float(round(p[i]))
            else:
                keep.append(i)
        while len(keep) < 3 and nxt < len(queue):
            keep.append(queue[nxt])
            nxt += 1
        act = keep
    return np.array(p)


def _fly(land: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "size", "p"], kind="stable", ignore_index=True)
        seed = int(pdf["key"].to_numpy().astype("int64").view("uint64").sum() % (1 << 63)) + len(pdf)
        return pdf.assign(p=flight(pdf["p"].to_numpy(), pdf["size"].to_numpy(), np.random.default_rng(seed), land))
    return run


def spread(todo: DataFrame) -> DataFrame:
    """Add ``chunk``: 0, but for rows whose key more than ``COPIES`` rows share (repeated rows) their rank by ``COPIES``.

    Ranks come from counts per (key, part of the stored table), so no task sees all copies of a key; copies are alike, so which
    of them has which rank does not matter, and reruns agree.
    """
    part = F.shiftright("row", 33)
    per = todo.groupBy("key", part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
    many = per.groupBy("key").agg(F.sum("c").alias("all")).filter(F.col("all") > COPIES).select(F.col("key").alias("k2"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = store(per.join(many, F.col("key") == F.col("k2")).select(
        F.col("key").alias("k3"), F.col("part").alias("p3"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base")), "mix-copies")
    if base.limit(1).count() == 0:
        return todo.withColumn("chunk", F.lit(0).cast("long"))
    marked = todo.withColumn("part", part).join(base, (F.col("key") == F.col("k3")) & (F.col("part") == F.col("p3")), "left")
    within = F.row_number().over(Window.partitionBy("key", "part").orderBy("row")) - 1
    copies = marked.filter("base IS NOT NULL").withColumn("chunk", F.floor((F.col("base") + within) / COPIES))
    single = marked.filter("base IS NULL").withColumn("chunk", F.lit(0).cast("long"))
    return copies.unionByName(single).drop("k3", "p3", "part", "base")


def in_blocks(todo: DataFrame, turn: int) -> DataFrame:
    """Add ``block``: hash blocks of about ``GROUP`` rows of a source; copies of a row lie in several."""
    h = F.when(F.col("chunk") == 0, F.xxhash64("key", F.lit(turn))).otherwise(F.xxhash64("key", F.lit(turn), "chunk"))
    return todo.withColumn("block", F.pmod(h, F.ceil(F.col("n") / GROUP)))


def mix(docs: DataFrame, keep: Sequence[str], text: str = "text", source: str = "source",
        key: Sequence[str] = ("doc_id",), weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Columns ``keep`` of ``docs`` with size, source_size, target and taken (words that the mix takes
    of each document).  Other columns, whatever their names, are not carried."""
    kept = list(keep)
    # the row number of the stored row tells repeated rows apart from here on
    base = store(docs.select(
        *[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(kept)], F.size(words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(*key, text, source).alias("key0"), F.monotonically_increasing_id().alias("row"),
        F.col(source).alias("__src")), "mix-docs")
    per = (base.groupBy(F.col("__src").alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    src = store(targets(store(per, "mix-totals"), weights, most), "mix-targets")
    small = src.count() <= BROADCAST_SOURCES  # one row per source; beyond it a shuffle join that AQE splits
    if small:
        src = F.broadcast(src)
    doc = base.join(src.withColumnRenamed("source", "__s2"), F.col("__src").eqNullSafe(F.col("__s2")))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    doc = (doc.withColumn("whole", F.floor(ratio + EPS))
           .withColumn("p", F.greatest(ratio - F.col("whole"), F.lit(0.0))))
    todo = (doc.filter((F.col("size") > 0) & (F.col("p") > EPS))
            .select("row", F.xxhash64("key0", "sid").alias("key"), "sid", "size", "p", "n"))
    todo = spread(todo)
    decided, turn = None, 0
    while True:
        left = in_blocks(todo, turn)
        most_left = 0 if turn == 0 else todo.agg(F.max("n")).first()[0]
        land = turn > 0 and (most_left or 0) <= GROUP
        schema = "row long, key long, sid int, size long, p double, n long, chunk long, block long"
        flown = store(left.groupBy("sid", "block").applyInPandas(_fly(land), schema), f"mix-flight{turn}")
        over = (F.col("p") < EPS) | (F.col("p") > 1 - EPS)
        part = flown.filter(over).select("row", F.round("p").cast("long").alias("extra"))
        decided = part if decided is None else decided.unionByName(part)
        if land:
            break
        rest = flown.filter(~over).drop("block", "n")
        counts = rest.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
        todo = rest.join(F.broadcast(counts) if small else counts, "sid")
        turn += 1
    taken = F.col("size") * (F.col("whole") + F.coalesce(F.col("extra"), F.lit(0)))
    done = doc.join(decided, "row", "left")
    return done.select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(kept)], "size", "source_size", "target",
                       taken.cast("long").alias("taken"))
