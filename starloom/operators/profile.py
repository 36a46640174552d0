"""Column profiles of a table, computed as Spark aggregates.

``profile_columns`` counts exactly: the long form (column_name, value) comes from one ``unpivot`` of the string-cast
columns, so a profile of any width is one scan and one (partially pre-aggregated) shuffle.  ``first_values`` is a bounded
top-k aggregate: every task keeps the first k distinct values of each column beside its row and null counts, so one scan serves
counts and examples, and at most k values per task and column are ever exchanged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _long(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    cols = list(columns) if columns else list(df.columns)
    typed = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    return typed.unpivot([], [F.col(f"`{c}`") for c in cols], "column_name", "value")


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
                    rsd: float = 0.02) -> DataFrame:
    """Per column: n_rows, n_null, null_ratio, n_distinct (distinct non-NULL values).

    Exact (default): long form, one shuffle of the distinct (column, value) pairs.
    ``approx=True``: one pass with ``approx_count_distinct`` (HyperLogLog++, relative standard
    deviation ``rsd``) and null counts per column; no value is shuffled, which is the choice
    for very large tables.
    """
    if approx:
        cols = list(columns) if columns else list(df.columns)
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(cols):
            aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_z{i}"),
                     F.approx_count_distinct(F.col(f"`{c}`"), rsd).alias(f"_d{i}")]
        one = df.agg(*aggs)
        per_col = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_z{i}").alias("n_null"),
                                     F.col(f"_d{i}").alias("n_distinct")) for i, c in enumerate(cols)])
        long = one.select(F.col("_n").alias("n_rows"), F.inline(per_col))
        return long.select("column_name", "n_rows", "n_null",
                           F.try_divide(F.col("n_null"), F.col("n_rows")).alias("null_ratio"), "n_distinct")
    counted = _long(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    prof = counted.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("n_null"),
        F.count("value").alias("n_distinct"))
    return prof.select("column_name", "n_rows", "n_null",
                       F.try_divide(F.col("n_null"), F.col("n_rows")).alias("null_ratio"), "n_distinct")


class _Firsts:
    """Row and null count of a column, and its first k distinct values in code-point order."""

    def __init__(self, k: int):
        self.k, self.rows, self.nulls, self.values = k, 0, 0, []

    def add(self, col: pa.Array) -> None:
        self.rows += len(col)
        self.nulls += col.null_count
        if len(self.values) == self.k:  # only what comes before the last one kept
            col = col.filter(pc.less(col, pa.scalar(self.values[-1], col.type))) if self.k else col.slice(0, 0)
        new = set(pc.unique(col).to_pylist()) - {None}
        if new:
            self.values = heapq.nsmallest(self.k, new.union(self.values))


def first_values(df: DataFrame, k: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Partial state per task and column: rows (column_name, n_rows, n_null, value), counts on one row without a value, and
    up to ``k`` rows with one (and one for NULL, marked by ``is_null``).  ``first_k`` and ``counts`` merge them."""
    cols = list(columns) if columns else list(df.columns)
    typed = df.select(*[F.col(f"`{c}`").cast("string").alias(f"_{i}") for i, c in enumerate(cols)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [_Firsts(k) for _ in cols]
        for batch in batches:
            for s, col in zip(state, batch.columns):
                s.add(col)
        out = []
        for name, s in zip(cols, state):
            out.append((name, s.rows, s.nulls, False, None))
            if s.nulls:
                out.append((name, None, None, True, None))
            out += [(name, None, None, False, v) for v in s.values]
        types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             names=["column_name", "n_rows", "n_null", "is_null", "value"])

    return typed.mapInArrow(run, "column_name string, n_rows bigint, n_null bigint, is_null boolean, value string")


def first_k(partial: DataFrame, k: int) -> DataFrame:
    """(column_name, rank, value): the first ``k`` distinct values, NULL first, from ``first_values``."""
    values = partial.filter(F.col("value").isNotNull() | F.col("is_null")).select("column_name", "value")
    w = Window.partitionBy("column_name").orderBy(F.col("value").asc_nulls_first())
    return (values.withColumn("rank", F.dense_rank().over(w)).filter(F.col("rank") <= k)
            .groupBy("column_name", "rank").agg(F.min("value").alias("value")).select("column_name", "rank", "value"))


def profile_examples(df: DataFrame, k: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """First ``k`` distinct values (NULL included, sorted ascending with NULL first) per column."""
    return first_k(first_values(df, k, columns), k)


def counts_and_examples(df: DataFrame, k: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: n_rows, n_null, null_ratio and ``examples``, its first ``k`` distinct values, from one scan."""
    ensure_checkpoint_dir(df.sparkSession)
    partial = first_values(df, k, columns).checkpoint(eager=True)  # k + 2 rows per task and column at most
    counts = partial.groupBy("column_name").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"))
    examples = first_k(partial, k).groupBy("column_name").agg(  # k values
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]).alias("examples"))
    return counts.join(examples, "column_name", "left").select(
        "column_name", "n_rows", "n_null", F.try_divide(F.col("n_null"), F.col("n_rows")).alias("null_ratio"),
        F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))


def sparse_columns(profile: DataFrame, max_null_ratio: float = 0.4) -> DataFrame:
    """Columns a builder would drop: more than ``max_null_ratio`` NULLs, or at most one distinct value."""
    too_sparse = F.col("null_ratio") > F.lit(max_null_ratio)
    single = F.col("n_distinct") <= 1
    return (profile.filter(too_sparse | single)
            .select("column_name", too_sparse.alias("too_sparse"), single.alias("single_valued")))


def drop_sparse_columns(df: DataFrame, max_null_ratio: float = 0.4) -> DataFrame:
    """Drop the columns ``sparse_columns`` names (one row per column reaches the driver)."""
    names = [r["column_name"] for r in sparse_columns(profile_columns(df), max_null_ratio).collect()]
    return df.drop(*names)
