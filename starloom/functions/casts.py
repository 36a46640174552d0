"""Lenient casts that keep ANSI mode on.

Source files carry dirty values ('..', 'N/A', '', '1.5', numbers beyond int range).
A dirty value must become NULL, never abort the job and never saturate, so that the
later null drops and de-duplication see the same rows the legacy (non-ANSI) cast
semantics intended.  Rules:

* text -> int/bigint: optional sign and digits, optionally followed by a fraction
  which is truncated ('1.5' -> 1, ' 582 ' -> 582); anything else -> NULL; overflow -> NULL.
* number -> int/bigint: truncation toward zero; NaN / infinity / overflow -> NULL.
* text -> float/double: ``try_cast``.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_TEXT = r"^\s*([+-]?[0-9]+)([.][0-9]*)?\s*$"

_INTEGRAL = {"int": "int", "integer": "int", "bigint": "bigint", "long": "bigint", "smallint": "smallint"}
_FRACTIONAL = {"float": "float", "real": "float", "double": "double"}


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c, from_text: bool = True, int_type: str = "int") -> Column:
    """Truncating, NULL-on-error integer cast (see module doc)."""
    c = _as_col(c)
    if from_text:
        digits = F.regexp_extract(c.cast("string"), _INT_TEXT, 1)
        return F.when(digits == "", F.lit(None).cast(int_type)).otherwise(digits.try_cast(int_type))
    return c.try_cast(int_type)


def lenient_float(c, float_type: str = "float") -> Column:
    """NULL-on-error floating cast."""
    return _as_col(c).try_cast(float_type)


def lenient_cast(c, target: str, source: T.DataType | None = None) -> Column:
    """Cast ``c`` to ``target`` with the lenient rules, choosing the text or numeric rule by ``source``."""
    target = target.lower()
    from_text = source is None or isinstance(source, T.StringType)
    if target in _INTEGRAL:
        return lenient_int(c, from_text=from_text, int_type=_INTEGRAL[target])
    if target in _FRACTIONAL:
        return lenient_float(c, _FRACTIONAL[target])
    if target in ("string", "str"):
        return _as_col(c).cast("string")
    return _as_col(c).try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast many columns in a single projection, keeping column order.

    ``types`` maps column name -> target type name.  Names resolve case-insensitively
    like the rest of Spark.
    """
    by_lower = {k.lower(): v for k, v in types.items()}
    fields = {f.name.lower(): f for f in df.schema.fields}
    missing = [k for k in by_lower if k not in fields]
    if missing:
        raise ValueError(f"cast_columns: unknown columns {missing}")
    out = []
    for f in df.schema.fields:
        target = by_lower.get(f.name.lower())
        if target is None:
            out.append(F.col(f"`{f.name}`"))
        else:
            out.append(lenient_cast(F.col(f"`{f.name}`"), target, f.dataType).alias(f.name))
    return df.select(*out)
