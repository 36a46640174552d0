"""End-to-end star build: dimensions first, read back, then the fact against the stored ids."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import union_all
from ..operators.key_registry import KeyRegistry, upsert
from ..operators.keys import add_surrogate_key
from ..session import run_concurrently
from ..operators.layout import ROWS_PER_PART
from ..sources.files import read_partitioned, refresh_partitions, write_partitioned
from ..sources.labels import label_table
from . import dims as D
from .fact import i94_fact

# Table names and partition columns of the stored star.
PARTITIONS = {
    "I94s": ["i94yr", "i94mon"],
    "temperature_us_state": ["year", "state_name"],
    "temperature_country": ["year", "country_name"],
    "economics_us_state": ["year", "month"],
    "economics_country": ["year"],
}
ID_COLUMNS = {
    "economics_country": "id_economics_country",
    "economics_us_state": "id_economics_us_state",
    "temperature_country": "id_temperature_country",
    "temperature_us_state": "id_temperature_us_state",
}
# Natural keys the fact looks each dimension up by.
NATURAL_KEYS = {
    "economics_country": ["year", "country_code"],
    "economics_us_state": ["year", "month", "state_code"],
    "temperature_country": ["year", "month", "country_code"],
    "temperature_us_state": ["year", "month", "state_code"],
}
# Label sections of the label file used for countries and for US states.
COUNTRY_SECTION = "i94cntyl"
STATE_SECTION = "i94addrl"


@dataclass
class StarInputs:
    political_stability: DataFrame
    unemployment_country: DataFrame
    population: DataFrame
    unemployment_us_state: DataFrame
    temperature: DataFrame
    fact_source: DataFrame
    label_lines: DataFrame
    series: Mapping[str, str] = field(default_factory=dict)


def build_dimension_rows(inp: StarInputs) -> dict[str, DataFrame]:
    """The rows of the four dimensions, before they have ids (nothing but the shared parts runs)."""
    labels = run_concurrently({
        "country": lambda: label_table(inp.label_lines, COUNTRY_SECTION, "country_code", "country_name"),
        "state": lambda: label_table(inp.label_lines, STATE_SECTION, "state_code", "state_name")})
    country_labels, state_labels = labels["country"], labels["state"]
    # the daily temperature readings are scanned once for both temperature dimensions
    temp_country, temp_state = D.split_temperature_monthly(D.temperature_monthly(inp.temperature))
    return run_concurrently({
        "economics_country": lambda: D.economics_country_rows(D.economics_country_no_labels(
            D.political_stability_long(inp.political_stability), D.unemployment_long(inp.unemployment_country,
                                                                                     inp.series),
            D.population_share(inp.population)), country_labels),
        "economics_us_state": lambda: D.economics_us_state_rows(
            D.economics_us_state_no_labels(inp.unemployment_us_state), state_labels),
        "temperature_country": lambda: D.temperature_country_rows(temp_country, country_labels),
        "temperature_us_state": lambda: D.temperature_us_state_rows(temp_state, state_labels),
    })


def build_dimensions(inp: StarInputs) -> dict[str, DataFrame]:
    rows = build_dimension_rows(inp)
    return run_concurrently({n: (lambda n=n: add_surrogate_key(rows[n], D.KEY_ORDER[n], ID_COLUMNS[n])) for n in rows})


def _read_back(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    # pin the written schema so partition columns keep their types, and restore column order
    return read_partitioned(spark, path, columns=df.columns, schema=df.schema)


def _watched(name: str) -> dict:
    """The checks of a table as aggregates over its rows while they are written."""
    out = {"n_rows": F.count(F.lit(1))}
    ids = [ID_COLUMNS[name]] if name in ID_COLUMNS else list(ID_COLUMNS.values())
    for i in ids:
        out[f"{i}_count"] = F.count(i)
    if name in ID_COLUMNS:
        out |= {"min_id": F.min(ids[0]), "max_id": F.max(ids[0]), "id_sum": F.sum(F.col(ids[0]).cast("decimal(38,0)"))}
    else:
        matched = F.lit(True)
        for i in ids:
            matched = matched & F.col(i).isNotNull()
        out["n_matched"] = F.count_if(matched)
    return out


@dataclass
class WriteReport:
    """What was measured while a star was written: per table its row count and id counts, and what follows from them."""

    tables: dict[str, dict] = field(default_factory=dict)

    def rows(self) -> list[tuple]:
        """(table_name, check_name, value, expected or None): counts, and per dimension whether its ids are dense.

        Ids that are 1..n have the largest id n, the least 1, no NULL and the sum n (n + 1) / 2.
        """
        out = []
        for name, m in sorted(self.tables.items()):
            out.append((name, "n_rows", m["n_rows"], None))
            if name in ID_COLUMNS:
                n, i = m["n_rows"], ID_COLUMNS[name]
                out += [(name, "n_ids", m[f"{i}_count"], n), (name, "max_id", m["max_id"] or 0, n),
                        (name, "min_id", m["min_id"] or 0, min(n, 1)), (name, "id_sum", int(m["id_sum"] or 0), n * (n + 1) // 2)]
            else:
                out += [(name, f"matched_{i}", m[f"{i}_count"], None) for i in ID_COLUMNS.values()]
                out.append((name, "matched_all", m["n_matched"], None))
        return out

    def failures(self) -> list[tuple]:
        return [r for r in self.rows() if r[3] is not None and r[2] != r[3]]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "table_name string, check_name string, value bigint, expected bigint")


def store_star(spark: SparkSession, dims: Mapping[str, DataFrame], fact_source: DataFrame, base_path: str,
               mode: str = "errorifexists", int_type: str = "int",
               max_records_per_file: int | None = None, report: WriteReport | None = None,
               partitions: Mapping[str, Sequence[str]] | None = None,
               one_exchange: bool = False, rows_per_part: int = ROWS_PER_PART) -> dict[str, DataFrame]:
    """Write the four dimensions, read them back, build the fact from the stored ids, write it.

    Writing the dimensions first means the ids the fact refers to are exactly the stored ones
    (a lineage recomputation can never hand the fact different ids).  Returns the five tables
    as read back from ``base_path`` (the fact under ``"I94s"``).  A natural key held by two rows of a
    stored dimension would multiply fact rows: it raises ``ValueError`` before the fact is built.  The key and row-count
    checks are measured on the rows while they are written and put into ``report``.  ``partitions`` gives a table other
    partition columns than ``PARTITIONS`` (readers find them by the folders); the fact keeps its months, which the refresh replaces.
    ``one_exchange`` scans the fact source once more to size the months and then removes duplicates and lays the fact out in one
    exchange, a task per ``rows_per_part`` rows of a month, instead of one exchange each.
    """
    base = base_path.rstrip("/")
    layout = {**PARTITIONS, **(partitions or {})}
    if layout["I94s"] != PARTITIONS["I94s"] or set(layout) != set(PARTITIONS):
        raise ValueError(f"partitions: only the dimensions' {sorted(ID_COLUMNS)} can be laid out otherwise")
    report = WriteReport() if report is None else report
    for name in PARTITIONS:
        report.tables[name] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{base}/{name}.parquet"
        write_partitioned(df, path, layout[name], mode=mode, colocate=True, observe=_watched(name), observed=report.tables[name])
        return _read_back(spark, df, path)

    stored = run_concurrently({name: (lambda name=name, df=df: store(name, df)) for name, df in dims.items()})
    fact = i94_fact(fact_source, stored["economics_country"], stored["economics_us_state"],
                    stored["temperature_country"], stored["temperature_us_state"], int_type=int_type,
                    check_natural_keys=True, in_layout=one_exchange, rows_per_part=rows_per_part)
    path = f"{base}/I94s.parquet"
    write_partitioned(fact, path, PARTITIONS["I94s"], mode=mode, max_records_per_file=max_records_per_file,
                      rebalance=not one_exchange, observe=_watched("I94s"), observed=report.tables["I94s"])
    stored["I94s"] = _read_back(spark, fact, path)
    return stored


def build_star(spark: SparkSession, inp: StarInputs, base_path: str, mode: str = "errorifexists",
               int_type: str = "int", max_records_per_file: int | None = None, report: WriteReport | None = None,
               partitions: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """The whole build from source frames: dimensions, then the fact against the stored dimensions."""
    stored = store_star(spark, build_dimensions(inp), inp.fact_source, base_path, mode=mode, int_type=int_type,
                        max_records_per_file=max_records_per_file, report=report, partitions=partitions)
    # a new build numbers anew: its registries (if a refresh made some) start from its own ids
    run_concurrently({n: (lambda n=n: registry_of(spark, base_path, n).seed(stored[n])) for n in ID_COLUMNS})
    return stored


def registry_of(spark: SparkSession, base_path: str, name: str) -> KeyRegistry:
    """The key registry of one dimension of the star stored under ``base_path``."""
    return KeyRegistry(spark, f"{base_path.rstrip('/')}/_keys/{name}", NATURAL_KEYS[name], ID_COLUMNS[name])


def refresh_dimensions(spark: SparkSession, inp: StarInputs, base_path: str,
                       partitions: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """Dimensions refreshed from new sources with stable ids; returns them as stored.

    Rows are matched by natural key: known ones keep their id and take the new values, new ones get ids after the largest so
    far, and rows that the sources no longer hold stay, as facts may point at them.  A star without a registry (built
    before there was one) seeds it from its stored dimensions.  The merged rows are checkpointed before a table is
    overwritten; a run that dies meanwhile is repeated and hands out the same ids.
    """
    base = base_path.rstrip("/")
    rows = build_dimension_rows(inp)

    def refresh(name: str) -> DataFrame:
        path, registry = f"{base}/{name}.parquet", registry_of(spark, base, name)
        columns = T.StructType([*rows[name].schema.fields, T.StructField(ID_COLUMNS[name], T.IntegerType())])
        stored = read_partitioned(spark, path, columns=columns.fieldNames(), schema=columns)
        if registry.read() is None:
            registry.seed(stored)
        new = registry.assign(rows[name], D.KEY_ORDER[name])
        merged = upsert(stored, new, NATURAL_KEYS[name]).checkpoint(eager=True)
        write_partitioned(merged, path, {**PARTITIONS, **(partitions or {})}[name], mode="overwrite", colocate=True)
        return _read_back(spark, merged, path)

    return run_concurrently({name: (lambda name=name: refresh(name)) for name in rows})


def refresh_fact_month(spark: SparkSession, inp: StarInputs, base_path: str, int_type: str = "int") -> DataFrame:
    """Monthly refresh of the fact: rebuild from a new month's source and overwrite only that
    month's partitions, against the dimensions already stored under ``base_path``.  Returns the whole fact with
    the columns and types of the build."""
    base = base_path.rstrip("/")
    stored = {n: spark.read.parquet(f"{base}/{n}.parquet") for n in ID_COLUMNS}
    fact = i94_fact(inp.fact_source, stored["economics_country"], stored["economics_us_state"],
                    stored["temperature_country"], stored["temperature_us_state"], int_type=int_type,
                    check_natural_keys=True)
    refresh_partitions(fact, f"{base}/I94s.parquet", PARTITIONS["I94s"], rebalance=True)
    return _read_back(spark, fact, f"{base}/I94s.parquet")


def star_quality(stored: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The quality checks of a stored star, as DataFrames (nothing runs until they are used).

    ``ids``: one row per dimension from ``pk_check``; ``repeated_natural_keys``: natural keys held
    by more than one dimension row (expected empty); ``fact_rows``: the fact's row count;
    ``coverage``: fact rows matched per dimension and in all four at once.
    """
    from ..operators.aggregates import row_count
    from ..operators.quality import natural_key_duplicates, pk_check, star_coverage
    dims = {n: stored[n] for n in ID_COLUMNS}
    fact = stored["I94s"] if "I94s" in stored else stored["fact"]
    repeated = union_all([natural_key_duplicates(df, NATURAL_KEYS[n]).select(F.lit(n).alias("table_name"), "n_rows")
                          for n, df in dims.items()])
    return {
        "ids": union_all([pk_check(df, ID_COLUMNS[n], n) for n, df in dims.items()]),
        "repeated_natural_keys": repeated,
        "fact_rows": row_count(fact),
        "coverage": star_coverage(fact, {n: (df, ID_COLUMNS[n]) for n, df in dims.items()}),
    }


def star_summary(stored: Mapping[str, DataFrame]) -> DataFrame:
    """One row per stored table: (table_name, n_rows, n_columns)."""
    rows = None
    for name, df in stored.items():
        part = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def star_sums(stored: Mapping[str, DataFrame]) -> DataFrame:
    """One row per stored table: rows, columns, the sum of its ids, and the sum of all its other numbers in whole
    thousandths (exact sums, as text), so that two builds can be compared by value."""
    parts = []
    for name, df in stored.items():
        ids, others = F.lit(0).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")
        for f in df.schema.fields:
            if not isinstance(f.dataType, T.NumericType):
                continue
            v = F.col(f"`{f.name}`")
            if f.name.startswith("id_"):
                ids = ids + F.coalesce(v.cast("decimal(20,0)"), F.lit(0))
            else:
                others = others + F.coalesce(F.floor(v.cast("double") * 1000).cast("decimal(20,0)"), F.lit(0))
        total = lambda c: F.coalesce(F.sum(c.cast("decimal(28,0)")), F.lit(0)).cast("string")
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), total(ids).alias("id_sum"), total(others).alias("value_sum"))
                     .select(F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"),
                             "id_sum", "value_sum"))
    return union_all(parts)
