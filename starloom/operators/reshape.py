"""Reshapes: wide year-per-column tables to long form and series to columns, each in one scan."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import lenient_float, lenient_int


def value_columns(df: DataFrame, id_cols: Sequence[str], drop: Sequence[str] = ()) -> list[str]:
    """All columns that are neither ids nor dropped, in file order (the year columns of a wide file)."""
    skip = {c.lower() for c in list(id_cols) + list(drop)}
    return [c for c in df.columns if c.lower() not in skip]


def unpivot_years(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str] | None = None,
                  name_col: str = "year", value_col: str = "value", value_type: str = "float",
                  id_aliases: Sequence[str] | None = None, dedup: bool = True) -> DataFrame:
    """Wide -> long in a single scan: one row per (ids, value column); NULL measures are kept.

    Column names become ``name_col`` cast leniently to int (year), values are cast
    leniently to ``value_type``.  ``dedup`` removes exact duplicate rows as the batch
    pipeline did after its union of per-column projections.
    """
    if value_cols is None:
        value_cols = value_columns(df, id_cols)
    typed = df.select(*[F.col(f"`{c}`") for c in id_cols],
                      *[lenient_float(F.col(f"`{c}`"), value_type).alias(c) for c in value_cols])
    long = typed.unpivot([F.col(f"`{c}`") for c in id_cols], [F.col(f"`{c}`") for c in value_cols],
                         name_col, value_col)
    aliases = list(id_aliases) if id_aliases else list(id_cols)
    out = long.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(id_cols, aliases)],
                      F.col(value_col), lenient_int(F.col(name_col)).alias(name_col))
    return out.distinct() if dedup else out


def pivot_sum(df: DataFrame, group_cols: Sequence[str], pivot_col: str, value_col: str,
              values: Mapping[str, str] | Sequence[str], strict: bool = False) -> DataFrame:
    """Series -> columns with ``sum`` per cell (duplicates in a cell are added up).

    ``values`` lists the pivot values (or maps value -> output column name).  Explicit
    values mean no discovery job and no column for a NULL series.  Values that are not listed have no column;
    ``strict`` raises ``ValueError`` when there are any (one more scan), ``pivot_map`` keeps them.
    """
    mapping = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    if strict:
        check_series(df, pivot_col, list(mapping))
    pivoted = (df.groupBy(*[F.col(f"`{c}`") for c in group_cols])
               .pivot(pivot_col, list(mapping.keys()))
               .agg(F.sum(F.col(f"`{value_col}`"))))
    return pivoted.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})


def pivot_map(df: DataFrame, group_cols: Sequence[str], pivot_col: str, value_col: str, map_col: str = "series",
              null_col: str = "no_series") -> DataFrame:
    """Series -> one ``map<string, sum>`` per group, for any number of series and without a list of them.

    A row has the series that its group has, and no schema grows with them: 100,000 series are 100,000 entries of
    the groups that hold them.  Values are added up per (group, series) first, with partial sums before the exchange, so a group with a
    third of all rows sends one row per series and task.  A series whose values are all NULL is an entry with NULL.  A
    map has no NULL key: the sum of the rows without a series is ``null_col``.  ``map_columns`` makes columns of the map.
    """
    groups = [F.col(f"`{c}`") for c in group_cols]
    cells = (df.groupBy(*groups, F.col(f"`{pivot_col}`").cast("string").alias("_series"))
             .agg(F.sum(F.col(f"`{value_col}`")).alias("_sum")))
    entry = F.when(F.col("_series").isNotNull(), F.struct("_series", "_sum"))
    return cells.groupBy(*groups).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias(map_col),
                                      F.max(F.when(F.col("_series").isNull(), F.col("_sum"))).alias(null_col))


def map_columns(df: DataFrame, values: Mapping[str, str] | Sequence[str], map_col: str = "series",
                rest: bool = True) -> DataFrame:
    """Columns for some series of a ``pivot_map`` (NULL where a row has no such series), without a job.

    The other entries stay in ``map_col``; ``rest=False`` drops it.
    """
    mapping = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    m = F.col(f"`{map_col}`")
    out = df.withColumns({a: F.try_element_at(m, F.lit(v)) for v, a in mapping.items()})
    if not rest:
        return out.drop(map_col)
    return out.withColumn(map_col, F.map_filter(m, lambda k, _: ~k.isin(list(mapping))) if mapping else m)


def check_series(df: DataFrame, series_col: str, expected: Sequence[str]) -> None:
    """Raise unless the non-NULL values of ``series_col`` are exactly ``expected``."""
    col = F.col(f"`{series_col}`")
    # per expected name whether it occurs, and one example of another name: one row, whatever the data
    known = col.isin(list(expected))
    row = df.agg(F.max(F.when(col.isNotNull() & ~known, col)).alias("other"),
                 *[F.max(F.coalesce(col == e, F.lit(False))).alias(f"e{i}") for i, e in enumerate(expected)]).first()
    missing = [e for i, e in enumerate(expected) if not row[f"e{i}"]]
    if row["other"] is not None or missing:
        raise ValueError(f"series do not fit their mapping: not mapped {row['other']!r}, not in the data {missing}")


def unpivot_then_pivot(df: DataFrame, id_cols: Sequence[str], series_col: str,
                       series: Mapping[str, str], year_cols: Sequence[str] | None = None,
                       id_aliases: Sequence[str] | None = None, year_name: str = "year",
                       value_type: str = "float", dedup: bool = True, strict: bool = True) -> DataFrame:
    """Wide (ids x series rows, one column per year) -> long (ids, year) with one column per series.

    One unpivot and one grouped pivot: a single shuffle, instead of a pivot job per year.
    ``strict`` raises ``ValueError`` when the data hold a series that ``series`` does not map, or lack
    one that it maps (rows without a series have no column).
    """
    if strict:
        check_series(df, series_col, list(series))
    if year_cols is None:
        year_cols = value_columns(df, list(id_cols) + [series_col])
    long = unpivot_years(df, list(id_cols) + [series_col], year_cols, name_col=year_name,
                         value_col="_v", value_type=value_type, dedup=False)
    aliases = list(id_aliases) if id_aliases else list(id_cols)
    long = long.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(id_cols, aliases)],
                       F.col(f"`{series_col}`").alias("_series"), F.col("_v"), F.col(year_name))
    out = pivot_sum(long, aliases + [year_name], "_series", "_v", series)
    return out.distinct() if dedup else out
