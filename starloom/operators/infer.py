"""Type inference for string columns as one lattice aggregate.

Types are ordered boolean, int, bigint, double and date, timestamp below string.  A value votes for each type whose written
form it has and whose range it lies in; a column's type is the narrowest that all its values have.  All columns and types
are counted in one scan with one row per task shuffled, so a wide file costs no pass per column; and the counts
say what a lenient cast to a narrower type would turn into NULL.

NULL and blank values have every type; a column without any other value is ``string``.  White space around a value is no part of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# From narrow to wide; a value of one type of a chain has the wider ones of that chain too.
TYPES = ["boolean", "int", "bigint", "double", "date", "timestamp"]
_FORM = {"boolean": "^(?i)(true|false)$", "int": "^[+-]?[0-9]+$", "bigint": "^[+-]?[0-9]+$",
         "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$", "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
         "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$"}


def _has(v: Column, t: str) -> Column:
    return F.coalesce(v.rlike(_FORM[t]) & v.try_cast(t).isNotNull(), F.lit(False))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: n_rows, n_values (neither NULL nor blank), inferred_type, and n_lost_<type>: values that are not of that type."""
    cols = list(columns or df.columns)
    trimmed = df.select(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).alias(f"_{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i in range(len(cols)):
        v = F.col(f"_{i}")
        aggs.append(F.count(v).alias(f"_v{i}"))
        aggs += [F.count_if(v.isNotNull() & ~_has(v, t)).alias(f"_l{i}_{t}") for t in TYPES]
    one = trimmed.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"_v{i}").alias("n_values"),
                              *[F.col(f"_l{i}_{t}").alias(f"n_lost_{t}") for t in TYPES]) for i, c in enumerate(cols)])
    long = one.select(F.inline(rows))
    best = F.lit("string")
    for t in reversed(TYPES):
        best = F.when((F.col("n_values") > 0) & (F.col(f"n_lost_{t}") == 0), F.lit(t)).otherwise(best)
    return long.select("column_name", "n_rows", "n_values", best.alias("inferred_type"), *[f"n_lost_{t}" for t in TYPES])


def cast_inferred(df: DataFrame, inferred: DataFrame) -> DataFrame:
    """``df`` with each inferred column cast to its type (one row per column reaches the driver)."""
    types = {r["column_name"]: r["inferred_type"] for r in inferred.select("column_name", "inferred_type").collect()}
    return df.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).try_cast(types[c]).alias(c)
                       if types.get(c, "string") != "string" else F.col(f"`{c}`") for c in df.columns])
