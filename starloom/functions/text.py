"""Scalar text helpers, all JVM-side built-ins."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The visa category labels of the arrivals source.
VISA_CATEGORIES = {"1": "Business", "2": "Pleasure", "3": "Student"}


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every code point that counts as white space when a Python string is stripped.
_SPACE = (r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def strip_ws(c) -> Column:
    """Strip leading and trailing whitespace of any kind, the Unicode spaces (such as NBSP) included."""
    return F.regexp_replace(_as_col(c), rf"^{_SPACE}+|{_SPACE}+$", "")


def lower_names(c) -> Column:
    return F.lower(_as_col(c))


def month_name_to_int(c) -> Column:
    """Full (or abbreviated) English month name -> 1..12, any letter case; anything else -> NULL."""
    c = _as_col(c)
    full = F.try_to_timestamp(c, F.lit("MMMM"))
    short = F.try_to_timestamp(c, F.lit("MMM"))
    return F.month(F.coalesce(full, short))


def month_int_to_name(c) -> Column:
    """Timestamp/date -> full English month name (inverse direction, used to shape inputs)."""
    return F.date_format(_as_col(c), "MMMM")


def code_map_lookup(c, mapping: Mapping[str, str] = VISA_CATEGORIES) -> Column:
    """Look a code up in a literal map; unknown or NULL codes give NULL."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _as_col(c).cast("string"))
