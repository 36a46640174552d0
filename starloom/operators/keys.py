"""Dense surrogate keys (1..n in a total order) without a single-task window.

``row_number() OVER (ORDER BY ...)`` with no partition sends every row to one task.
Here the rows are range-partitioned on the order, sorted inside each range and
written to the session's reliable checkpoint folder (this also fixes the ids: a re-run
of a lost task reads the same checkpoint, so fact and dimension can never disagree).
A row's id is then the number of rows in earlier ranges plus its position in its own
range; positions come from ``monotonically_increasing_id`` of the checkpointed scan
(range index in the upper bits, row index in the lower 33 bits).  The counts per range stay a
frame of one row per range, joined as a broadcast.  Every value the exchange is keyed on is fixed
before it (the input is checkpointed), so retried tasks route every row the same way.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = 33


def _order_cols(df: DataFrame, order_by: Sequence[str], tie_break: bool) -> list[Column]:
    cols = list(order_by)
    if tie_break:
        # every remaining column breaks ties, so the order is total up to exact duplicates
        lowered = {c.lower() for c in cols}
        cols += [c for c in df.columns if c.lower() not in lowered]
    return [F.col(f"`{c}`").asc_nulls_first() for c in cols]


def add_surrogate_key(df: DataFrame, order_by: Sequence[str], id_col: str, tie_break: bool = True,
                      num_ranges: int | None = None, id_type: str = "int", start: int = 0) -> DataFrame:
    """Append ``id_col`` = ``start`` + row number (1-based) of each row in ascending ``order_by`` order (NULLs first)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = _order_cols(df, order_by, tie_break)
    # The input is checkpointed first: the range bounds are sampled by a job of their own, and
    # every value the exchange routes on must be the same on every recomputation of a lost task
    # (floating sums of a regrouped input can differ in their last bits, the "_row" position of a
    # row can differ too), or the exchange could drop or duplicate a row.  "_row" breaks ties
    # between exact copies, so many copies of one row can still be split across ranges; copies
    # are interchangeable, so which copy gets which id does not matter.
    src = df.checkpoint(eager=True).withColumn("_row", F.monotonically_increasing_id())
    ordered = _ranged_checkpoint(src, order + [F.col("_row").asc()], num_ranges)
    return _number(ordered, df.columns, id_col, id_type, start)


def _ranged_checkpoint(df: DataFrame, order: list[Column], num_ranges: int | None) -> DataFrame:
    ranged = df.repartitionByRange(num_ranges, *order) if num_ranges else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).checkpoint(eager=True)


def _number(ordered: DataFrame, columns: list[str], id_col: str, id_type: str, start: int) -> DataFrame:
    mid = F.monotonically_increasing_id()
    with_pos = ordered.select("*", F.shiftright(mid, _LOW_BITS).alias("_range"),
                              mid.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).alias("_pos"))
    # one row per range: a running sum of the counts gives each range's start; the plan's size does not
    # depend on the number of ranges, and nothing reaches the driver
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (with_pos.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
              .checkpoint(eager=True))
    with_pos = with_pos.join(F.broadcast(starts), "_range")  # as many rows as the exchange has partitions
    ids = (F.col("_start") + F.col("_pos") + F.lit(1 + start)).cast(id_type)
    return with_pos.select(*[F.col(f"`{c}`") for c in columns], ids.alias(id_col))
