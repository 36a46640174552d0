"""Grouped aggregates, shares of a group total, counts and distinct rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .joins import bounded_broadcast


def group_avg(df: DataFrame, keys: Sequence[str], value: str, out: str = "avg") -> DataFrame:
    """``avg(value)`` per group; partial aggregation runs before the shuffle."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.avg(F.col(f"`{value}`")).alias(out))


def group_avg_min_max(df: DataFrame, keys: Sequence[str], value: str,
                      names: Sequence[str] = ("avg", "min", "max")) -> DataFrame:
    v = F.col(f"`{value}`")
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys])
            .agg(F.avg(v).alias(names[0]), F.min(v).alias(names[1]), F.max(v).alias(names[2])))


def share_of_total(df: DataFrame, group: Sequence[str], value: str, out: str = "share",
                   scale: float = 100.0, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """``value / sum(value) over group * scale``; a zero or NULL total gives NULL.

    Instead of a window (which puts a whole group, e.g. a whole year, into one task) the
    totals are aggregated (partial sums before the shuffle), checkpointed (one row per
    group, so the size check below does not recompute the input) and joined back,
    broadcast when the check passes.
    """
    ensure_checkpoint_dir(df.sparkSession)
    gcols = [F.col(f"`{g}`") for g in group]
    totals = df.groupBy(*gcols).agg(F.sum(F.col(f"`{value}`")).alias("_total"))
    totals = totals.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)], "_total")
    totals = bounded_broadcast(totals.checkpoint(eager=True), max_broadcast_rows)
    cond = [F.col(f"`{g}`").eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = df.join(totals, cond, "left")
    share = F.try_divide(F.col(f"`{value}`"), F.col("_total")) * F.lit(scale)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], share.alias(out))


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def union_all(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f) if by_name else out.union(f)
    return out


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """Row count as a one-row DataFrame (the action stays with the caller)."""
    return df.agg(F.count(F.lit(1)).alias(out))


def _present(df: DataFrame, name: str):
    """NOT NULL, and for floating columns also not NaN (what ``na.drop`` counts as missing)."""
    c = F.col(f"`{name}`")
    dtype = dict((f.name.lower(), f.dataType) for f in df.schema.fields)[name.lower()]
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def drop_null_any(df: DataFrame) -> DataFrame:
    """Rows with no NULL (or NaN) in any column, written as one conjunction.

    Unlike ``na.drop`` this is a plain ``IS NOT NULL`` filter, so a preceding outer join is
    turned into an inner join by Catalyst."""
    cond = F.lit(True)
    for c in df.columns:
        cond = cond & _present(df, c)
    return df.filter(cond)


def drop_null_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in dict.fromkeys(subset):
        cond = cond & _present(df, c)
    return df.filter(cond)
