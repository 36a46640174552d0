"""Equi-joins of the star build: key-set chains, label lookups and fact -> dimension lookups."""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import lenient_cast
from ..session import ensure_checkpoint_dir, run_concurrently

# Largest sides that are broadcast after their size has been measured: rows of one side, and bytes of all
# sides of one chain of joins together.  Label tables and (keys, id) projections of dimension tables stay far
# below; anything larger goes through a shuffle join that AQE can still convert or split at run time.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20
_ROW_BYTES = 32  # what a row costs beside its values (row header, hash entry)


def side_size(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and the bytes they take in memory, by one partially aggregated job (one row per task is
    shuffled)."""
    width = F.lit(_ROW_BYTES + 8 * len(df.columns))
    for f in df.schema.fields:
        if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = F.col(f"`{f.name}`")
            if not isinstance(f.dataType, (T.StringType, T.BinaryType)):
                value = value.cast("string")
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return r["n"], r["b"] or 0


def bounded_broadcasts(frames: Sequence[DataFrame], max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> list[DataFrame]:
    """Mark the sides of one chain of joins for broadcast, in their order, while each has at most ``max_rows``
    rows and all marked ones together at most ``max_bytes`` bytes; the others are returned as they are.

    Pass frames that are stored or checkpointed: each is read once to measure it and once to join it.
    """
    sizes = run_concurrently({str(i): (lambda f=f: side_size(f)) for i, f in enumerate(frames)})
    out, left = [], max_bytes
    for i, f in enumerate(frames):
        n, size = sizes[str(i)]
        small = n <= max_rows and size <= left
        left -= size if small else 0
        out.append(F.broadcast(f) if small else f)
    return out


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``bounded_broadcasts`` for a single side."""
    return bounded_broadcasts([df], max_rows, max_bytes)[0]


def union_distinct_keys(frames: Sequence[DataFrame], cols: Sequence[str],
                        aliases: Sequence[str] | None = None) -> DataFrame:
    """Distinct union of the key columns of several tables (the key set of a full outer chain)."""
    parts = [f.select(*[F.col(f"`{c}`") for c in cols]) for f in frames]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.distinct()
    if aliases:
        out = out.toDF(*aliases)
    return out


def outer_chain(keys: DataFrame, key_cols: Sequence[str], parts: Sequence[tuple[DataFrame, Sequence[str]]],
                measures: Sequence[str], how: str = "full") -> DataFrame:
    """Join each part to the key set on the key-set columns, one after another.

    ``parts`` is a list of (frame, its key columns in the order of ``key_cols``).  The
    conditions always refer to the key set's columns, so with ``how="full"`` a part row whose
    key is NULL survives with NULL keys.  Output: key-set columns + ``measures``.
    """
    out = keys
    for i, (frame, fkeys) in enumerate(parts):
        renamed = frame.select(*[F.col(f"`{c}`").alias(f"_k{i}_{j}") for j, c in enumerate(fkeys)],
                               *[F.col(f"`{m}`") for m in frame.columns if m in measures])
        cond = [F.col(k) == F.col(f"_k{i}_{j}") for j, k in enumerate(key_cols)]
        out = out.join(renamed, cond, how).drop(*[f"_k{i}_{j}" for j in range(len(fkeys))])
    return out.select(*[F.col(k) for k in key_cols], *[F.col(m) for m in measures])


def outer_union(parts: Sequence[tuple[DataFrame, Sequence[str]]], key_cols: Sequence[str],
                measures: Sequence[str]) -> DataFrame:
    """The rows of ``outer_chain(keys, key_cols, parts, measures, "full")`` with ``keys`` the distinct keys of all parts,
    from one grouping of a tagged union instead of a key set and a join per part.

    A key that each part holds at most once is one row of the grouping.  Keys that some part repeats (seen by
    their counts, in the same grouping) fan out as the joins do, to the product of their rows: only these go through
    ``outer_chain``, so no group is ever collected.  A row with a NULL in its key matches nothing: it is kept with NULL keys, and its key
    is a row without measures.  Each measure belongs to one part.  The grouping is checkpointed, as two results read it.
    """
    owner: dict[str, int] = {}
    for i, (frame, _) in enumerate(parts):
        for m in measures:
            if m in frame.columns and owner.setdefault(m, i) != i:
                raise ValueError(f"measure {m} is in two parts")
    if missing := [m for m in measures if m not in owner]:
        raise ValueError(f"measures in no part: {missing}")
    types = {m: parts[i][0].schema[m].dataType for m, i in owner.items()}
    tagged, alone = None, None
    for i, (frame, fkeys) in enumerate(parts):
        keys = [F.col(f"`{f}`").alias(k) for f, k in zip(fkeys, key_cols)]
        values = [(F.col(f"`{m}`") if owner[m] == i else F.lit(None).cast(types[m])).alias(m) for m in measures]
        rows = frame.select(*keys, *values, F.lit(i).alias("_tag"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    no_match = F.lit(False)
    for k in key_cols:
        no_match = no_match | F.col(k).isNull()
    # measures of rows that match nothing leave the grouping here and come back as rows of their own
    alone = tagged.filter(no_match).select(*[F.lit(None).cast(tagged.schema[k].dataType).alias(k) for k in key_cols], *measures)
    ensure_checkpoint_dir(tagged.sparkSession)
    grouped = (tagged.groupBy(*key_cols)
               .agg(*[F.first(F.when(~no_match, F.col(m)), ignorenulls=True).alias(m) for m in measures],
                    *[F.count(F.when((F.col("_tag") == i) & ~no_match, 1)).alias(f"_n{i}") for i in range(len(parts))])
               .withColumn("_repeats", F.greatest(F.lit(0), *[F.col(f"_n{i}") for i in range(len(parts))]) > 1)
               .drop(*[f"_n{i}" for i in range(len(parts))]).checkpoint(eager=True))
    columns = [F.col(c) for c in [*key_cols, *measures]]
    out = grouped.filter(~F.col("_repeats")).select(*columns).unionByName(alone)
    repeated = grouped.filter("_repeats").select(*key_cols)
    if repeated.limit(1).count():
        some = []
        for i, (frame, fkeys) in enumerate(parts):
            held = repeated.toDF(*[f"_r{j}" for j in range(len(key_cols))])
            cond = [F.col(f"`{f}`") == F.col(f"_r{j}") for j, f in enumerate(fkeys)]
            some.append((frame.join(held, cond, "left_semi"), fkeys))
        out = out.unionByName(outer_chain(repeated, key_cols, some, measures, "full"))
    return out


def label_join(df: DataFrame, labels: DataFrame, name_col: str, label_name_col: str, code_col: str,
               how: str = "inner", cast_code: str | None = None,
               max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Attach the code of each name from a label table (``how`` = "left" keeps unmatched names).

    A left join followed by a null drop is written as an inner join, which Catalyst then
    plans as such.  The label side is checkpointed, so measuring it does not compute it twice, and broadcast
    behind that measure.
    """
    ensure_checkpoint_dir(df.sparkSession)
    lab = labels.select(F.col(label_name_col).alias("_lname"), F.col(code_col).alias("_lcode"))
    lab = bounded_broadcast(lab.checkpoint(eager=True), max_broadcast_rows)
    out = df.join(lab, F.col(name_col) == F.col("_lname"), how).drop("_lname")
    code = F.col("_lcode")
    if cast_code:
        code = lenient_cast(code, cast_code)
    return out.withColumn(code_col, code).drop("_lcode")


# Most parts that the rows of one hot key are dealt to in a shuffled lookup; a key is hot from 2 / SPLITS of the rows on.
SPLITS = 1024
_TRACKED = 16 * SPLITS  # items the sketch follows, per task and lookup


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                        if not isinstance(f.dataType, (T.MapType, T.VariantType))])


def hot_keys(fact: DataFrame, keys: Sequence[Sequence[str]], splits: int = SPLITS) -> list[tuple[list[int], int]]:
    """Per list of key columns: the hashes of the keys that hold more than 2 / ``splits`` of the rows, and the number of parts
    that gives the largest of them parts of 1 / ``splits`` of the rows.

    One scan with a mergeable sketch of frequent items per list; at most ``splits`` / 2 hashes each reach the driver.
    The sketch's counts may be too large by a sixteenth of that bound, which only splits a key without need.
    """
    if not keys:
        return []
    held = [F.xxhash64(*[F.col(f"`{c}`") for c in cols]) for cols in keys]
    for i, cols in enumerate(keys):
        for c in cols:  # a key with a NULL matches nothing and is dealt by its row
            held[i] = F.when(F.col(f"`{c}`").isNotNull(), held[i])
    row = fact.select(*[h.alias(f"_h{i}") for i, h in enumerate(held)]).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k(_h{i}, {splits}, {max(_TRACKED, splits)})").alias(f"t{i}") for i in range(len(keys))]).first()
    fair = max(1, row["n"] / splits)
    out = []
    for i in range(len(keys)):
        hot = [(x["item"], x["count"]) for x in row[f"t{i}"] or [] if x["item"] is not None and x["count"] > 2 * fair]
        out.append(([h for h, _ in hot], min(splits, math.ceil(max((c for _, c in hot), default=1) / fair))))
    return out


def split_lookup(fact: DataFrame, side: DataFrame, fact_keys: Sequence[str], side_keys: Sequence[str],
                 hot: Sequence[int], parts: int, splits: int = SPLITS) -> DataFrame:
    """Left join by a shuffle in which no key fills a task: the rows of hot keys are dealt to ``parts`` parts by the hash of the
    whole row, the side's rows of these keys are sent to every part; rows with a NULL in the key match nothing and are dealt to
    ``splits`` parts.  One scan and one exchange of the fact.  A part is chosen from the row's values alone, so a
    repeated task sends each row where it went before (equal rows stay together)."""
    none = F.lit(False)
    for c in fact_keys:
        none = none | F.col(f"`{c}`").isNull()
    is_hot = lambda cols: F.xxhash64(*[F.col(f"`{c}`") for c in cols]).isin(list(hot)) if hot else F.lit(False)
    deal = _row_hash(fact)
    left = fact.withColumn("_part", F.when(none, F.pmod(deal, F.lit(splits)))
                           .when(is_hot(fact_keys), F.pmod(deal, F.lit(parts))).otherwise(F.lit(0).cast("long")))
    everywhere = F.when(is_hot(side_keys), F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    right = side.withColumn("_side_part", F.explode(F.coalesce(everywhere, F.array(F.lit(0).cast("long")))))
    cond = [F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in zip(fact_keys, side_keys)]
    return left.join(right, [*cond, F.col("_part") == F.col("_side_part")], "left").drop("_part", "_side_part")


def fk_lookup(fact: DataFrame, dims: Sequence[Mapping], max_broadcast_rows: int = BROADCAST_MAX_ROWS,
              check_natural_keys: bool = False, splits: int = SPLITS) -> DataFrame:
    """Left-join the fact to each dimension on natural keys and bring back only the dimension id.

    ``dims`` items: ``{"df": dim, "on": {fact_col: dim_col, ...}, "id": id_col}``.
    Each dimension (stored or checkpointed) is projected to (keys, id) and broadcast behind a size check that
    bounds all of them together, so the fact is never shuffled for the lookups.  A dimension beyond that bound is joined by a
    shuffle that splits hot and NULL keys (``split_lookup``; the hot keys of all such dimensions come from one more scan of the
    fact).  A natural key held by two dimension rows would multiply fact rows; ``check_natural_keys=True`` raises
    ``ValueError`` before that happens.
    """
    sides = []
    for i, d in enumerate(dims):
        on = dict(d["on"])
        if check_natural_keys:
            dup = (d["df"].groupBy(*[F.col(c) for c in on.values()]).count()
                   .filter(F.col("count") > 1).limit(1).count())
            if dup:
                raise ValueError(f"dimension with id {d['id']} repeats a natural key {list(on.values())}")
        sides.append(d["df"].select(*[F.col(dc).alias(f"_d{i}_{j}") for j, dc in enumerate(on.values())],
                                    F.col(d["id"])))
    marked = bounded_broadcasts(sides, max_broadcast_rows)
    shuffled = [i for i, (a, b) in enumerate(zip(sides, marked)) if a is b]
    hot = dict(zip(shuffled, hot_keys(fact, [list(dict(dims[i]["on"])) for i in shuffled], splits)))
    out = fact
    for i, (d, side) in enumerate(zip(dims, marked)):
        on = dict(d["on"])
        held = [f"_d{i}_{j}" for j in range(len(on))]
        if i in hot:
            out = split_lookup(out, side, list(on), held, *hot[i], splits)
        else:
            out = out.join(side, [F.col(fc) == F.col(h) for fc, h in zip(on, held)], "left")
        out = out.drop(*held)
    return out
