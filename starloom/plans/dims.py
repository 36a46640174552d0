"""The four dimension tables of the star, as compositions of starloom operators.

Inputs have the shapes of the source files (all-string columns as read from CSV):

* political stability (wide): Country Name, Country Code, Series Name, Series Code, <year>...
* unemployment by country (wide): Country Name, Country Code, Series Name, Series Code, <year>...
* population: Country Name, Year, Count
* unemployment by state: Year, Month (English month name), State, County, Rate
* temperature: Region, Country, State, City, Month, Day, Year, AvgTemperature
* labels: (code, lower-cased name) tables from ``sources.labels.label_table``
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import cast_columns, lenient_float, lenient_int
from ..functions.text import month_name_to_int
from ..operators.aggregates import drop_null_any, drop_null_subset, group_avg, group_avg_min_max, share_of_total
from ..operators.joins import label_join, outer_chain, outer_union, union_distinct_keys
from ..operators.keys import add_surrogate_key
from ..operators.reshape import unpivot_then_pivot, unpivot_years
from ..session import ensure_checkpoint_dir, run_concurrently

# Output column order and id names of the star contract.
ECONOMICS_COUNTRY_COLUMNS = ["country_name", "year", "pss", "uwae", "uwbe", "uwie", "ut", "powp", "country_code"]
ECONOMICS_US_STATE_COLUMNS = ["year", "month", "state_name", "ut", "state_code"]
TEMPERATURE_COUNTRY_COLUMNS = ["year", "country_name", "month", "temperature", "min_temperature",
                               "max_temperature", "country_code"]
TEMPERATURE_US_STATE_COLUMNS = ["year", "state_name", "month", "temperature", "min_temperature",
                                "max_temperature", "state_code"]
# The order in which the rows of each dimension are numbered.
KEY_ORDER = {
    "economics_country": ["year", "country_name"],
    "economics_us_state": ["year", "state_name", "month"],
    "temperature_country": ["year", "country_name", "month"],
    "temperature_us_state": ["year", "state_name", "month"],
}
TEMPERATURE_MEASURES = ["temperature", "min_temperature", "max_temperature"]


# ----------------------------------------------------------------------------- economics by country

def political_stability_long(wide: DataFrame) -> DataFrame:
    """(country_name, country_code, pss FLOAT, year INT), one row per country and year column."""
    w = wide.drop("series Name", "Series Code")
    return unpivot_years(w, ["Country Name", "Country Code"], name_col="year", value_col="pss",
                         id_aliases=["country_name", "country_code"])


# Unemployment measure columns, in the sorted order of their series names.
UNEMPLOYMENT_MEASURES = ["uwae", "uwbe", "uwie", "ut"]


def discover_series(wide: DataFrame, series_col: str = "Series Name",
                    names: list[str] = UNEMPLOYMENT_MEASURES) -> dict[str, str]:
    """Series names found in the data, sorted, mapped in order to ``names`` (one small distinct job).

    This is the positional naming of a pivot whose columns are discovered from the data; it
    requires exactly ``len(names)`` non-NULL series.
    """
    col = F.col(f"`{series_col}`")
    # at most len(names) + 1 values reach the driver
    found = sorted(r[0] for r in wide.select(col).filter(col.isNotNull()).distinct().limit(len(names) + 1).collect())
    if len(found) != len(names):
        raise ValueError(f"expected {len(names)} series, found {len(found)}: {found}")
    return dict(zip(found, names))


def unemployment_long(wide: DataFrame, series: Mapping[str, str] | None = None) -> DataFrame:
    """(country_name, country_code, year, <one DOUBLE column per series alias>).

    ``series`` maps series name -> column; without it the series are discovered and named
    positionally (``discover_series``)."""
    if not series:
        series = discover_series(wide)
    w = wide.drop("Series Code")
    return unpivot_then_pivot(w, ["Country Name", "Country Code"], "Series Name", series,
                              id_aliases=["country_name", "country_code"])


def population_share(population: DataFrame) -> DataFrame:
    """(country_name, year INT, count INT, powp DOUBLE = count / yearly total * 100); duplicates
    count in the yearly total and are removed afterwards."""
    p = population.withColumnsRenamed({"Country Name": "country_name", "Year": "year", "Count": "count"})
    p = cast_columns(p, {"year": "int", "count": "int"})
    # one row per country and year: materialised, as the totals and the shares both read it
    ensure_checkpoint_dir(p.sparkSession)
    p = p.checkpoint(eager=True)
    return share_of_total(p, ["year"], "count", "powp").distinct()


def economics_country_no_labels(pss: DataFrame, unemployment: DataFrame, population: DataFrame,
                                measures=("pss", "uwae", "uwbe", "uwie", "ut", "powp"),
                                materialize: bool = True, normalize_keys: bool = False,
                                chain: str = "union") -> DataFrame:
    """Full outer chain of the three country-year parts from their distinct key set.

    ``chain="union"`` takes its rows from one grouping of the three parts (``outer_union``), ``chain="joins"`` from a
    key set and three joins.  Each part then feeds both the key set and its join; ``materialize`` checkpoints the parts
    (country x year aggregates, small) so their sources are scanned once, not twice.
    Names match case-sensitively and are lower-cased afterwards, so two sources spelling a
    country in different case give two rows; ``normalize_keys=True`` lower-cases the names
    before the key set and the joins, merging them into one row.
    """
    if normalize_keys:
        pss, unemployment, population = (p.withColumn("country_name", F.lower(F.col("country_name")))
                                         for p in (pss, unemployment, population))
    named = lambda df, name, year: df.select(
        F.lower(F.col(name)).alias("country_name"), F.col(year).alias("year"), *[F.col(m) for m in measures]).distinct()
    if chain == "union":
        return named(outer_union([(p, ["country_name", "year"]) for p in (pss, unemployment, population)],
                                 ["u_name", "u_year"], list(measures)), "u_name", "u_year")
    if materialize:
        ensure_checkpoint_dir(pss.sparkSession)
        parts = run_concurrently({"pss": lambda: pss.checkpoint(eager=True),
                                  "unemployment": lambda: unemployment.checkpoint(eager=True),
                                  "population": lambda: population.checkpoint(eager=True)})
        pss, unemployment, population = parts["pss"], parts["unemployment"], parts["population"]
    keys = union_distinct_keys([pss, unemployment, population], ["country_name", "year"], ["u_name", "u_year"])
    return named(outer_chain(keys, ["u_name", "u_year"],
                             [(pss, ["country_name", "year"]), (unemployment, ["country_name", "year"]),
                              (population, ["country_name", "year"])],
                             list(measures), how="full"), "u_name", "u_year")


def economics_country_rows(no_labels: DataFrame, country_labels: DataFrame) -> DataFrame:
    j = label_join(no_labels, country_labels, "country_name", "country_name", "country_code",
                   how="inner", cast_code="int")
    j = drop_null_subset(j, ["country_code", "year"])  # codes that are no number, rows without a year
    return j.select(*ECONOMICS_COUNTRY_COLUMNS)


def economics_country(no_labels: DataFrame, country_labels: DataFrame) -> DataFrame:
    rows = economics_country_rows(no_labels, country_labels)
    return add_surrogate_key(rows, KEY_ORDER["economics_country"], "id_economics_country")


# ----------------------------------------------------------------------------- economics by US state

def economics_us_state_no_labels(readings: DataFrame) -> DataFrame:
    typed = readings.select(lenient_int(F.col("Year")).alias("Year"), month_name_to_int(F.col("Month")).alias("Month"),
                            F.col("State"), lenient_float(F.col("Rate")).alias("Rate"))
    agg = group_avg(typed, ["Year", "Month", "State"], "Rate", "ut")
    return agg.select(F.col("Year").alias("year"), F.col("Month").alias("month"),
                      F.lower(F.col("State")).alias("state_name"), F.col("ut")).distinct()


def economics_us_state_rows(no_labels: DataFrame, state_labels: DataFrame) -> DataFrame:
    j = label_join(no_labels, state_labels, "state_name", "state_name", "state_code", how="inner")
    j = drop_null_any(j.select(*ECONOMICS_US_STATE_COLUMNS))
    return j


def economics_us_state(no_labels: DataFrame, state_labels: DataFrame) -> DataFrame:
    rows = economics_us_state_rows(no_labels, state_labels)
    return add_surrogate_key(rows, KEY_ORDER["economics_us_state"], "id_economics_us_state")


# ----------------------------------------------------------------------------- temperature

def _temperature_no_labels(readings: DataFrame, us: bool) -> DataFrame:
    key, name = ("State", "state_name") if us else ("Country", "country_name")
    rows = readings.filter(F.col("Country") == "US") if us else readings.filter(F.col("Country") != "US")
    typed = rows.select(lenient_int(F.col("Year")).alias("Year"), F.col(key),
                        lenient_int(F.col("Month")).alias("Month"),
                        lenient_float(F.col("AvgTemperature")).alias("AvgTemperature"))
    agg = group_avg_min_max(typed, ["Year", key, "Month"], "AvgTemperature", TEMPERATURE_MEASURES)
    return agg.select(F.col("Year").alias("year"), F.lower(F.col(key)).alias(name), F.col("Month").alias("month"),
                      *[F.col(m) for m in TEMPERATURE_MEASURES]).distinct()


def temperature_monthly(readings: DataFrame) -> DataFrame:
    """Both temperature aggregates from one scan of the daily readings.

    Rows of 'US' are grouped by state, all other non-NULL countries by country; the result
    (kind, year, name, month, avg/min/max) is small, so it is checkpointed for the two
    dimensions that read it.
    """
    us = F.col("Country") == "US"
    typed = readings.filter(F.col("Country").isNotNull()).select(
        lenient_int(F.col("Year")).alias("Year"), us.alias("is_us"),
        F.when(us, F.col("State")).otherwise(F.col("Country")).alias("Place"),
        lenient_int(F.col("Month")).alias("Month"),
        lenient_float(F.col("AvgTemperature")).alias("AvgTemperature"))
    agg = group_avg_min_max(typed, ["Year", "is_us", "Place", "Month"], "AvgTemperature", TEMPERATURE_MEASURES)
    ensure_checkpoint_dir(readings.sparkSession)
    return agg.checkpoint(eager=True)


def split_temperature_monthly(monthly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(country no-labels, US-state no-labels) from ``temperature_monthly``."""
    def part(is_us: bool, name: str) -> DataFrame:
        rows = monthly.filter(F.col("is_us") == F.lit(is_us))
        return rows.select(F.col("Year").alias("year"), F.lower(F.col("Place")).alias(name),
                           F.col("Month").alias("month"), *[F.col(m) for m in TEMPERATURE_MEASURES]).distinct()
    return part(False, "country_name"), part(True, "state_name")


def temperature_country_no_labels(readings: DataFrame) -> DataFrame:
    """Monthly avg/min/max per country over every row whose Country is not 'US' (NULL drops out)."""
    return _temperature_no_labels(readings, us=False)


def temperature_us_state_no_labels(readings: DataFrame) -> DataFrame:
    """Monthly avg/min/max per US state over the rows whose Country is 'US'."""
    return _temperature_no_labels(readings, us=True)


def temperature_country_rows(no_labels: DataFrame, country_labels: DataFrame) -> DataFrame:
    j = label_join(no_labels, country_labels, "country_name", "country_name", "country_code",
                   how="inner", cast_code="int")
    j = drop_null_any(j.select(*TEMPERATURE_COUNTRY_COLUMNS))
    return j


def temperature_country(no_labels: DataFrame, country_labels: DataFrame) -> DataFrame:
    rows = temperature_country_rows(no_labels, country_labels)
    return add_surrogate_key(rows, KEY_ORDER["temperature_country"], "id_temperature_country")


def temperature_us_state_rows(no_labels: DataFrame, state_labels: DataFrame) -> DataFrame:
    j = label_join(no_labels, state_labels, "state_name", "state_name", "state_code", how="inner")
    j = drop_null_any(j.select(*TEMPERATURE_US_STATE_COLUMNS))
    return j


def temperature_us_state(no_labels: DataFrame, state_labels: DataFrame) -> DataFrame:
    rows = temperature_us_state_rows(no_labels, state_labels)
    return add_surrogate_key(rows, KEY_ORDER["temperature_us_state"], "id_temperature_us_state")
