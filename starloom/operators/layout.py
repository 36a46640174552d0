"""De-duplication that leaves rows where the partitioned write needs them: one exchange for both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import bounded_broadcast

ROWS_PER_PART = 2_000_000
# A row is heavy from this share of its directory's rows on (and more than a part's rows); the sketch's error is about a
# third of it.
HEAVY_SHARE = 1 / 400
_TRACKED = 4096


def directory_sizes(df: DataFrame, partition_by: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """One row per directory: its key columns (``_key0`` ...), ``_n`` rows and ``_heavy``, the hashes of rows that occur more than
    ``rows_per_part`` times and in more than ``HEAVY_SHARE`` of the directory, from a mergeable sketch in one scan."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    keys = [F.col(f"`{c}`").alias(f"_key{i}") for i, c in enumerate(partition_by)]
    sizes = (df.select(*keys, row.alias("_row")).groupBy(*[f"_key{i}" for i in range(len(keys))])
             .agg(F.count(F.lit(1)).alias("_n"),
                  F.expr(f"approx_top_k(_row, {int(1 / HEAVY_SHARE)}, {_TRACKED})").alias("_top")))
    least = F.greatest(F.lit(float(rows_per_part)), F.col("_n") * HEAVY_SHARE)
    heavy = F.filter("_top", lambda x: x["count"] > least)
    return sizes.withColumn("_heavy", F.transform(heavy, lambda x: x["item"])).drop("_top")


def distinct_in_layout(df: DataFrame, partition_by: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The distinct rows of ``df``, dealt to tasks by (directory, part of the directory), for a write partitioned by
    ``partition_by`` without a further exchange.

    A directory has a part per ``rows_per_part`` of its rows (copies counted), and a row's part is its hash, so a directory with all
    rows is written by many tasks and copies meet in one.  Copies reach that task unmerged; rows with very many (found first by
    ``directory_sizes``) therefore take another way: they are merged inside the tasks that read them before anything is sent.  ``df`` is scanned once for
    the sizes and once to be dealt (once more where heavy rows exist), so give a stored or cheap frame.  NULL partition values are a
    directory of their own.  More directories than can be broadcast (``bounded_broadcast``): plain ``distinct``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    sizes = directory_sizes(df, partition_by, rows_per_part).checkpoint(eager=True)
    side = bounded_broadcast(sizes)
    if side is sizes:
        return df.distinct()
    columns = [F.col(f"`{c}`") for c in df.columns]
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(partition_by)]
    row = F.xxhash64(*columns)
    placed = df.join(side, same, "inner").select(
        *columns, F.pmod(row, F.ceil(F.col("_n") / rows_per_part)).alias("_part"), F.array_contains("_heavy", row).alias("_is_heavy"))
    # the exchange by (directory, part) also serves the grouping by all columns: no second one
    rest = (placed.filter(~F.col("_is_heavy")).drop("_is_heavy")
            .repartition(*[F.col(f"`{c}`") for c in partition_by], F.col("_part")).distinct().drop("_part"))
    if not sizes.filter(F.size("_heavy") > 0).limit(1).count():
        return rest
    return rest.unionByName(placed.filter("_is_heavy").select(*columns).distinct())
