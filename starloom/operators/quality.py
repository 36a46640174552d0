"""Quality checks of a built star: surrogate keys, natural keys, counts and coverage."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, run_concurrently
from .joins import bounded_broadcasts


def pk_check(dim: DataFrame, id_col: str, table_name: str | None = None) -> DataFrame:
    """One row: max, count, distinct count, min and NULL count of the id, and whether it is 1..n.

    ``max(id) = count(id)`` alone does not prove uniqueness; ``is_dense`` also needs
    ``count(distinct id) = count(id)``, ``min(id) = 1`` and no NULL.
    """
    i = F.col(f"`{id_col}`")
    agg = dim.agg(F.max(i).alias("max_id"), F.count(i).alias("n_ids"),
                  F.count_distinct(i).alias("n_distinct"), F.min(i).alias("min_id"),
                  F.count_if(i.isNull()).alias("n_null"))
    out = agg.select(
        F.lit(table_name or id_col).alias("table_name"), "max_id", "n_ids", "n_distinct", "min_id", "n_null",
        (F.col("max_id") == F.col("n_ids")).alias("max_equals_count"),
        ((F.col("max_id") == F.col("n_ids")) & (F.col("n_distinct") == F.col("n_ids"))
         & (F.col("min_id") == 1) & (F.col("n_null") == 0)).alias("is_dense"))
    return out


def natural_key_duplicates(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Natural keys held by more than one row (each would multiply fact rows in a lookup)."""
    return (dim.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def star_coverage(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """How many fact rows find their row in each dimension, and in all of them at once.

    ``dims`` maps a name to (dimension, id column); the fact holds the same id column.
    One pass over the fact: each dimension's id set (checkpointed) is broadcast behind a size check with a flag.
    Output rows: (check_name, n_fact, n_matched, matched_ratio).
    """
    f = fact
    flags = []
    ensure_checkpoint_dir(fact.sparkSession)

    def ids(i: int, dim: DataFrame, id_col: str) -> DataFrame:
        return dim.select(F.col(id_col).alias(f"_id{i}"), F.lit(True).alias(f"_m{i}")).distinct().checkpoint(eager=True)

    sets = run_concurrently({name: (lambda i=i, d=d, c=c: ids(i, d, c)) for i, (name, (d, c)) in enumerate(dims.items())})
    for i, ((name, (_, id_col)), side) in enumerate(zip(dims.items(), bounded_broadcasts([sets[n] for n in dims]))):
        f = f.join(side, F.col(id_col) == F.col(f"_id{i}"), "left")
        flags.append((name, F.coalesce(F.col(f"_m{i}"), F.lit(False))))
    all_flag = F.lit(True)
    for _, fl in flags:
        all_flag = all_flag & fl
    aggs = [F.count(F.lit(1)).alias("n_fact")]
    aggs += [F.count_if(fl).alias(f"m_{name}") for name, fl in flags]
    aggs.append(F.count_if(all_flag).alias("m__all"))
    one = f.agg(*aggs)
    names = [n for n, _ in flags] + ["_all"]
    long = one.unpivot(["n_fact"], [f"m_{n}" for n in names], "check_name", "n_matched")
    return long.select(F.regexp_replace("check_name", "^m_", "").alias("check_name"), "n_fact", "n_matched",
                       F.try_divide(F.col("n_matched"), F.col("n_fact")).alias("matched_ratio"))


STAR_JOIN_SQL = """
SELECT i94yr, i94mon, i94res, i94addr,
       ec.country_name AS ec_country_name, ec.country_code AS ec_country_code, ec.year AS ec_year,
       ec.pss AS ec_pss, ec.uwae AS ec_uwae, ec.uwbe AS ec_uwbe, ec.uwie AS ec_uwie, ec.ut AS ec_ut,
       ec.powp AS ec_powp,
       eus.state_name AS eus_state_name, eus.state_code AS eus_state_code, eus.year AS eus_year,
       eus.month AS eus_month, eus.ut AS eus_ut,
       tc.country_name AS tcv_country_name, tc.country_code AS tcv_country_code, tc.year AS tcv_year,
       tc.month AS tcv_month, tc.temperature AS tcv_temperature, tc.min_temperature AS tcv_min_temperature,
       tc.max_temperature AS tcv_max_temperature,
       tus.state_name AS tus_state_name, tus.state_code AS tus_state_code, tus.year AS tus_year,
       tus.month AS tus_month, tus.temperature AS tus_temperature, tus.min_temperature AS tus_min_temperature,
       tus.max_temperature AS tus_max_temperature
FROM {fact} f
JOIN {economics_country} ec ON f.id_economics_country = ec.id_economics_country
JOIN {economics_us_state} eus ON f.id_economics_us_state = eus.id_economics_us_state
JOIN {temperature_country} tc ON f.id_temperature_country = tc.id_temperature_country
JOIN {temperature_us_state} tus ON f.id_temperature_us_state = tus.id_temperature_us_state
"""


def star_join_sql(spark, views: Mapping[str, str]) -> DataFrame:
    """The star inner join of the fact with all four dimensions, as Spark SQL over temp views.

    ``views`` maps fact / economics_country / economics_us_state / temperature_country /
    temperature_us_state to registered view names.
    """
    return spark.sql(STAR_JOIN_SQL.format(**views))
