"""The arrivals fact table: clean, cast, de-duplicate, and resolve the four dimension ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import cast_columns
from ..operators.joins import BROADCAST_MAX_ROWS, fk_lookup
from ..operators.layout import ROWS_PER_PART, distinct_in_layout
from ..sources.files import lowercase_names

# The fact contract (dropped columns, numeric columns cast to int, output order).
FACT_DROP = ["count", "visapost", "occup", "entdepu", "insnum"]
FACT_INT_COLUMNS = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode", "depdate", "i94bir",
                    "i94visa", "dtadfile", "biryear", "dtaddto", "admnum", "fltno"]
FACT_COLUMNS = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "i94mode", "i94addr",
                "depdate", "i94bir", "i94visa", "dtadfile", "entdepa", "entdepd", "matflag", "biryear", "dtaddto",
                "gender", "airline", "admnum", "fltno", "visatype"]
FACT_PARTITION = ["i94yr", "i94mon"]
FACT_IDS = ["id_temperature_us_state", "id_temperature_country", "id_economics_us_state", "id_economics_country"]


def clean_fact(source: DataFrame, int_type: str = "int", dedup: bool = True, in_layout: bool = False,
               rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Lower-case names, drop unused columns, cast codes leniently, remove exact duplicates.

    ``int_type="bigint"`` keeps identifiers such as ``admnum`` whole where they exceed int.  ``in_layout`` removes
    duplicates in the exchange that also deals the rows to the months' writers (``distinct_in_layout``).
    """
    f = lowercase_names(source).drop(*FACT_DROP)
    f = cast_columns(f, {c: int_type for c in FACT_INT_COLUMNS})
    if dedup and in_layout:
        return distinct_in_layout(f, FACT_PARTITION, rows_per_part)
    return f.distinct() if dedup else f


def i94_fact(source: DataFrame, economics_country: DataFrame, economics_us_state: DataFrame,
             temperature_country: DataFrame, temperature_us_state: DataFrame, int_type: str = "int",
             dedup: bool = True, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
             check_natural_keys: bool = False, in_layout: bool = False, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Fact rows with the ids of their state/country rows for their year and month (NULL when absent).

    State dimensions match on (year, month, i94addr), country dimensions on i94res, the
    yearly country economics on (year, i94res).  Dimensions are broadcast after a size check,
    so the fact is scanned once and never shuffled for the lookups.
    """
    f = clean_fact(source, int_type, dedup, in_layout, rows_per_part)
    f = fk_lookup(f, [
        {"df": temperature_us_state, "on": {"i94yr": "year", "i94mon": "month", "i94addr": "state_code"},
         "id": "id_temperature_us_state"},
        {"df": temperature_country, "on": {"i94yr": "year", "i94mon": "month", "i94res": "country_code"},
         "id": "id_temperature_country"},
        {"df": economics_us_state, "on": {"i94yr": "year", "i94mon": "month", "i94addr": "state_code"},
         "id": "id_economics_us_state"},
        {"df": economics_country, "on": {"i94yr": "year", "i94res": "country_code"},
         "id": "id_economics_country"},
    ], max_broadcast_rows=max_broadcast_rows, check_natural_keys=check_natural_keys)
    return f.select(*[F.col(c) for c in FACT_COLUMNS + FACT_IDS])
