"""Registered queries: each builds its DataFrame from the test tables under ``sf_dir``.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is DuckDB SQL over
the same tables that must give the same rows (column names included).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import cast_columns
from ..functions.text import code_map_lookup, lower_names, month_name_to_int
from ..operators import aggregates as A
from ..operators import infer as I
from ..operators import profile as P
from ..operators import quality as Q
from ..operators import sketches as S
from ..operators.joins import label_join, union_distinct_keys
from ..operators.keys import add_surrogate_key
from ..operators.reshape import map_columns, pivot_map, pivot_sum
from ..session import run_concurrently, scratch_path
from ..sources.files import (lowercase_names, read_fact_source, read_header_csv, read_partitioned,
                             refresh_partitions, write_header_csv, write_partitioned)
from ..sources.labels import parse_label_section, read_label_lines, write_label_file
from . import analog as G
from . import dims as D
from .fact import FACT_COLUMNS, FACT_IDS, FACT_INT_COLUMNS, i94_fact
from .oracle import with_ctes
from .star import StarInputs, WriteReport, build_star, registry_of, star_sums, store_star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return G.table(spark, d, name)


# ============================================================================ sources and sinks

@register("csv_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def q_csv_scan(spark, d):
    src = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    path = write_header_csv(src, scratch_path(spark, "csv"))
    raw = read_header_csv(spark, path)
    return cast_columns(raw, {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"})


@register("lowercase_names", "SELECT * FROM orders")
def q_lowercase_names(spark, d):
    o = T(spark, d, "orders")
    return lowercase_names(o.toDF(*[c.upper() for c in o.columns]))


@register("label_sections", "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS label FROM customer")
def q_label_sections(spark, d):
    """Every customer code gets a stale line first (the later line must win) and a three-part
    line after its real one (it must be dropped); the parse keeps exactly the real names."""
    cust = T(spark, d, "customer")
    code = F.col("c_custkey").cast("string").alias("code")
    lines = A.union_all([
        cust.select(code, F.concat(F.lit("STALE "), "c_name").alias("label"), F.lit(0).alias("seq")),
        cust.select(code, F.col("c_name").alias("label"), F.lit(1).alias("seq")),
        cust.select(code, F.concat(F.col("c_name"), F.lit(" = JUNK")).alias("label"), F.lit(2).alias("seq")),
    ])
    sections = dict(G.label_sections_raw(spark, d))
    sections["i94cntyl"] = lines
    path = write_label_file(sections, scratch_path(spark, "labels"))
    return parse_label_section(read_label_lines(spark, path), "i94cntyl")


_MONTHLY_SQL = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders {where} GROUP BY ALL"""


def _monthly(orders: DataFrame) -> DataFrame:
    return (orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price")))


@register("parquet_roundtrip", _MONTHLY_SQL.format(where=""))
def q_parquet_roundtrip(spark, d):
    agg = _monthly(T(spark, d, "orders"))
    path = write_partitioned(agg, scratch_path(spark, "monthly"), ["year", "month"], colocate=True)
    return read_partitioned(spark, path, columns=agg.columns, schema=agg.schema)


@register("monthly_refresh", """
WITH latest AS (SELECT CAST(year(max(o_orderdate)) AS INTEGER) AS y, CAST(month(max(o_orderdate)) AS INTEGER) AS m
                FROM orders),
first_load AS (""" + _MONTHLY_SQL.format(where="WHERE o_orderstatus <> 'P'") + """),
refreshed AS (""" + _MONTHLY_SQL.format(where="") + """)
SELECT * FROM first_load WHERE NOT (year = (SELECT y FROM latest) AND month = (SELECT m FROM latest))
UNION ALL
SELECT * FROM refreshed WHERE year = (SELECT y FROM latest) AND month = (SELECT m FROM latest)""")
def q_monthly_refresh(spark, d):
    orders = T(spark, d, "orders")
    first = _monthly(orders.filter(F.col("o_orderstatus") != "P"))
    path = write_partitioned(first, scratch_path(spark, "refresh"), ["year", "month"], colocate=True)
    last = orders.agg(F.max("o_orderdate").alias("m")).first()["m"]
    month_rows = orders.filter((F.year("o_orderdate") == last.year) & (F.month("o_orderdate") == last.month))
    refresh_partitions(_monthly(month_rows), path, ["year", "month"])
    return read_partitioned(spark, path, columns=first.columns, schema=first.schema)


@register("head_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_head_preview(spark, d):
    return T(spark, d, "orders").orderBy("o_orderkey").limit(5)


@register("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def q_row_count(spark, d):
    return A.row_count(T(spark, d, "lineitem"))


# ============================================================================ projections, casts, filters

@register("select_columns", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment AS segment FROM customer")
def q_select_columns(spark, d):
    c = T(spark, d, "customer")
    return c.select(*c.columns[:3], F.col("c_mktsegment").alias("segment"))


@register("drop_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def q_drop_columns(spark, d):
    return T(spark, d, "part").drop("P_NAME", "p_type", "no_such_column")


@register("rename_columns", """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
       c_acctbal, c_mktsegment FROM customer""")
def q_rename_columns(spark, d):
    c = T(spark, d, "customer").withColumnsRenamed({"c_custkey": "customer_id", "c_name": "customer_name"})
    return c.toDF("customer_id", "customer_name", "nation_id", "c_acctbal", "c_mktsegment")


@register("literal_column", "SELECT p_partkey, 'part' AS source, 2016 AS load_year FROM part")
def q_literal_column(spark, d):
    return T(spark, d, "part").select("p_partkey", F.lit("part").alias("source"), F.lit(2016).alias("load_year"))


@register("cast_columns", """SELECT o_orderkey,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_custkey AS INTEGER) END AS cust_int,
       CAST(CAST(o_totalprice AS VARCHAR) AS REAL) AS price_float,
       CAST(trunc(o_totalprice) AS INTEGER) AS price_int
FROM orders""")
def q_cast_columns(spark, d):
    o = T(spark, d, "orders")
    cust = F.col("o_custkey").cast("string")
    text = (F.when(F.col("o_orderstatus") == "F", cust)
            .when(F.col("o_orderstatus") == "O", F.concat(cust, F.lit(".5")))
            .otherwise(F.lit("N/A")))
    src = o.select("o_orderkey", text.alias("cust_int"), F.col("o_totalprice").cast("string").alias("price_float"),
                   F.col("o_totalprice").alias("price_int"))
    return cast_columns(src, {"cust_int": "int", "price_float": "float", "price_int": "int"})


@register("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_filter_eq(spark, d):
    return T(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")


@register("filter_ne", "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING'")
def q_filter_ne(spark, d):
    return T(spark, d, "customer").filter(F.col("c_mktsegment") != "BUILDING")


def _nulled_orders(spark, d) -> DataFrame:
    o = T(spark, d, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
                    F.when(F.col("o_totalprice") < 50000, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                    "o_totalprice")


@register("drop_null_any", with_ctes(["nulled_orders"],
          "SELECT * FROM nulled_orders WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL"))
def q_drop_null_any(spark, d):
    return A.drop_null_any(_nulled_orders(spark, d))


@register("drop_null_subset", with_ctes(["nulled_orders"], "SELECT * FROM nulled_orders WHERE o_custkey IS NOT NULL"))
def q_drop_null_subset(spark, d):
    return A.drop_null_subset(_nulled_orders(spark, d), ["o_custkey", "o_custkey"])


@register("lower_names", "SELECT c_custkey, lower(c_name) AS c_name_lower FROM customer")
def q_lower_names(spark, d):
    return T(spark, d, "customer").select("c_custkey", lower_names("c_name").alias("c_name_lower"))


@register("month_name_to_int", """SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(month(o_orderdate) AS INTEGER) END AS month
FROM orders""")
def q_month_name_to_int(spark, d):
    o = T(spark, d, "orders")
    name = (F.when(F.col("o_orderstatus") == "P", F.concat(F.date_format("o_orderdate", "MMMM"), F.lit("x")))
            .when(F.col("o_orderstatus") == "O", F.upper(F.date_format("o_orderdate", "MMMM")))
            .otherwise(F.date_format("o_orderdate", "MMM")))
    return o.select("o_orderkey", month_name_to_int(name).alias("month"))


@register("code_map_lookup", """SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS visa_code,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Business' WHEN '2' THEN 'Pleasure'
            WHEN '3' THEN 'Student' END AS visa_category
FROM orders""")
def q_code_map_lookup(spark, d):
    code = F.substring("o_orderpriority", 1, 1)
    return T(spark, d, "orders").select("o_orderkey", code.alias("visa_code"), code_map_lookup(code).alias("visa_category"))


# ============================================================================ aggregates, set ops

@register("group_avg", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       l_linestatus, avg(l_quantity) AS avg_quantity FROM lineitem GROUP BY ALL""")
def q_group_avg(spark, d):
    li = T(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
                                        "l_linestatus", "l_quantity")
    return A.group_avg(li, ["year", "month", "l_linestatus"], "l_quantity", "avg_quantity")


@register("group_avg_min_max", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       l_returnflag, avg(l_quantity) AS avg_quantity, min(l_quantity) AS min_quantity, max(l_quantity) AS max_quantity
FROM lineitem GROUP BY ALL""")
def q_group_avg_min_max(spark, d):
    li = T(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
                                        "l_returnflag", "l_quantity")
    return A.group_avg_min_max(li, ["year", "month", "l_returnflag"], "l_quantity",
                               ["avg_quantity", "min_quantity", "max_quantity"])


@register("distinct_rows", """SELECT DISTINCT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem""")
def q_distinct_rows(spark, d):
    li = T(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year"))
    return A.distinct_rows(li)


@register("union_all", """SELECT c_nationkey AS nationkey, 'customer' AS src FROM customer
UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def q_union_all(spark, d):
    c = T(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"), F.lit("customer").alias("src"))
    s = T(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.lit("supplier").alias("src"))
    return A.union_all([c, s])


@register("union_distinct_keys", with_ctes(["keys"], "SELECT * FROM keys"))
def q_union_distinct_keys(spark, d):
    pss, un, pop = _economics_parts(spark, d)
    return union_distinct_keys([pss, un, pop], ["country_name", "year"], ["u_name", "u_year"])


@register("share_of_total", with_ctes(["pop"], "SELECT * FROM pop"))
def q_share_of_total(spark, d):
    return D.population_share(G.population(spark, d))


# ============================================================================ reshape

@register("unpivot_years", with_ctes(["pss"], "SELECT * FROM pss"))
def q_unpivot_years(spark, d):
    return D.political_stability_long(G.political_stability_wide(spark, d))


_PRIORITY_ALIASES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
                     "4-NOT SPECIFIED": "not_specified", "5-LOW": "low"}


@register("pivot_sum", with_ctes(["ocn"], "SELECT n_name AS country_name, CAST(year(o_orderdate) AS INTEGER) AS year, "
          + ", ".join(f"CAST(sum(CASE WHEN o_orderpriority = '{k}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) "
                      f"AS DOUBLE) AS {v}" for k, v in _PRIORITY_ALIASES.items())
          + " FROM ocn GROUP BY ALL"))
def q_pivot_sum(spark, d):
    ocn = G.orders_customers_nations(spark, d).select(
        F.col("n_name").alias("country_name"), F.year("o_orderdate").alias("year"), "o_orderpriority",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    p = pivot_sum(ocn, ["country_name", "year"], "o_orderpriority", "price", _PRIORITY_ALIASES)
    return p.select("country_name", "year", *[F.col(v).cast("double").alias(v) for v in _PRIORITY_ALIASES.values()])


@register("pivot_value_map", with_ctes(["ocn"], """,
cells AS (SELECT n_name AS country_name, CAST(year(o_orderdate) AS INTEGER) AS year,
                 CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority || ' ' || c_mktsegment END AS s,
                 sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM ocn GROUP BY ALL)
SELECT country_name, year, count(s) AS n_series, CAST(max(CASE WHEN s = '1-URGENT BUILDING' THEN v END) AS DOUBLE) AS urgent_building,
       CAST(max(CASE WHEN s IS NULL THEN v END) AS DOUBLE) AS no_series,
       string_agg(CASE WHEN s <> '1-URGENT BUILDING' THEN s || '=' || CAST(CAST(v * 100 AS BIGINT) AS VARCHAR) END, ',' ORDER BY s) AS others
FROM cells GROUP BY country_name, year"""))
def q_pivot_value_map(spark, d):
    """Sums per country, year and series (priority and segment; orders in progress have none), none of them listed beforehand."""
    ocn = G.orders_customers_nations(spark, d).select(
        F.col("n_name").alias("country_name"), F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") != "P", F.concat_ws(" ", "o_orderpriority", "c_mktsegment")).alias("s"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    whole = pivot_map(ocn, ["country_name", "year"], "s", "price").withColumn("n_series", F.size("series").cast("long"))
    out = map_columns(whole, {"1-URGENT BUILDING": "urgent_building"})
    cents = lambda e: F.concat(e["key"], F.lit("="), (e["value"] * 100).cast("bigint").cast("string"))
    others = F.array_join(F.transform(F.array_sort(F.map_entries("series")), cents), ",")
    return out.select("country_name", "year", "n_series", F.col("urgent_building").cast("double").alias("urgent_building"),
                      F.col("no_series").cast("double").alias("no_series"),
                      F.when(F.size("series") > 0, others).alias("others"))


@register("unpivot_then_pivot", with_ctes(["un"], "SELECT * FROM un"))
def q_unpivot_then_pivot(spark, d):
    return D.unemployment_long(G.unemployment_country_wide(spark, d), G.SERIES)


# ============================================================================ joins

def _economics_parts(spark, d, oc=None):
    """The three country-year parts; they all derive from orders x customer, materialised once."""
    oc = G.shared_orders_customers(spark, d) if oc is None else oc
    years = G.order_years(spark, d)
    pss = D.political_stability_long(G.political_stability_wide(spark, d, years, oc))
    un = D.unemployment_long(G.unemployment_country_wide(spark, d, years, oc), G.SERIES)
    pop = D.population_share(G.population(spark, d, oc))
    return pss, un, pop


@register("full_outer_chain", with_ctes(["ec_nl"], "SELECT * FROM ec_nl"))
def q_full_outer_chain(spark, d):
    return D.economics_country_no_labels(*_economics_parts(spark, d), chain="joins")


@register("outer_chain_one_shuffle", with_ctes(["ec_nl"], "SELECT * FROM ec_nl"))
def q_outer_chain_one_shuffle(spark, d):
    return D.economics_country_no_labels(*_economics_parts(spark, d), chain="union")


def _orders_per_country(spark, d) -> DataFrame:
    return (G.orders_customers_nations(spark, d).groupBy(F.lower(G.country_place()).alias("country_name"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


_LABEL_JOIN_SQL = """SELECT lower(country_place) AS country_name, count(*) AS n_orders,
       any_value(l.country_code) AS country_code
FROM ocn LEFT JOIN country_labels l ON lower(ocn.country_place) = l.country_name GROUP BY lower(country_place)"""


@register("label_left_join", with_ctes(["ocn", "country_labels"], _LABEL_JOIN_SQL))
def q_label_left_join(spark, d):
    return label_join(_orders_per_country(spark, d), G.country_labels(spark, d), "country_name", "country_name",
                      "country_code", how="left", cast_code="int")


@register("label_inner_join", with_ctes(["ocn", "country_labels"],
          "SELECT * FROM (" + _LABEL_JOIN_SQL + ") WHERE country_code IS NOT NULL"))
def q_label_inner_join(spark, d):
    return label_join(_orders_per_country(spark, d), G.country_labels(spark, d), "country_name", "country_name",
                      "country_code", how="inner", cast_code="int")


# ============================================================================ keys and dimensions

@register("surrogate_key", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, o_orderstatus,
       CAST(row_number() OVER (ORDER BY year(o_orderdate), month(o_orderdate), o_orderkey, o_orderstatus) AS INTEGER)
           AS order_id
FROM orders""")
def q_surrogate_key(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"),
                                     F.month("o_orderdate").alias("month"), "o_orderstatus")
    # the order has ties: the remaining columns break them in their order
    return add_surrogate_key(o, ["year", "month"], "order_id")


def dim_economics_us_state(spark, d) -> DataFrame:
    return D.economics_us_state(D.economics_us_state_no_labels(G.unemployment_us_state(spark, d)),
                                G.state_labels(spark, d))


def dim_temperature_us_state(spark, d) -> DataFrame:
    return D.temperature_us_state(D.temperature_us_state_no_labels(G.temperature(spark, d)), G.state_labels(spark, d))


def dim_temperature_country(spark, d) -> DataFrame:
    return D.temperature_country(D.temperature_country_no_labels(G.temperature(spark, d)), G.country_labels(spark, d))


def dim_economics_country(spark, d) -> DataFrame:
    return D.economics_country(D.economics_country_no_labels(*_economics_parts(spark, d)), G.country_labels(spark, d))


register("dim_state_month", with_ctes(["eus"], "SELECT * FROM eus"))(dim_economics_us_state)
register("dim_us_state_month", with_ctes(["tus"], "SELECT * FROM tus"))(dim_temperature_us_state)
register("dim_country_month", with_ctes(["tc"], "SELECT * FROM tc"))(dim_temperature_country)
register("dim_country_year", with_ctes(["ec"], "SELECT * FROM ec"))(dim_economics_country)


# the two dimensions of the refresh query: table, CTE, id column, name column, code column
_REFRESHED = [("economics_us_state", "eus", "id_economics_us_state", "state_name", "state_code"),
              ("temperature_country", "tc", "id_temperature_country", "country_name", "country_code")]


@register("dim_refresh_stable_keys", with_ctes(["eus", "tc"], """,
rows AS (""" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, year, month, {name} AS name, CAST({code} AS VARCHAR) AS code FROM {c}"
    for t, c, _, name, code in _REFRESHED) + """),
known AS (SELECT *, year > (SELECT min(year(o_orderdate)) FROM orders) AS first_delivery FROM rows)
SELECT table_name, year, month, name, code,
       CAST(row_number() OVER (PARTITION BY table_name, first_delivery ORDER BY year, name, month)
            + CASE WHEN first_delivery THEN 0
                   ELSE (SELECT count(*) FROM known k WHERE k.table_name = known.table_name AND k.first_delivery) END AS INTEGER)
           AS id FROM known""").replace("\n,\nrows AS", ",\nrows AS"))
def q_dim_refresh_stable_keys(spark, d):
    """Two deliveries of two dimensions: all but the earliest year, then everything.  The rows of the earliest year sort
    first but get the last ids, and all others keep theirs."""
    oc = G.shared_orders_customers(spark, d)
    first_year = oc.agg(F.min(F.year("o_orderdate")).alias("y")).first()["y"]
    late = oc.filter(F.year("o_orderdate") > F.lit(first_year))
    base = scratch_path(spark, "refresh")
    build = {"economics_us_state": lambda oc: D.economics_us_state_rows(
                 D.economics_us_state_no_labels(G.unemployment_us_state(spark, d, oc)), G.state_labels(spark, d)),
             "temperature_country": lambda oc: D.temperature_country_rows(
                 D.temperature_country_no_labels(G.temperature(spark, d, oc)), G.country_labels(spark, d))}

    def refresh(t: str, idc: str, name: str, code: str) -> DataFrame:
        registry = registry_of(spark, base, t)
        registry.assign(build[t](late), D.KEY_ORDER[t])
        now = registry.assign(build[t](oc), D.KEY_ORDER[t])
        return now.select(F.lit(t).alias("table_name"), "year", "month", F.col(name).alias("name"),
                          F.col(code).cast("string").alias("code"), F.col(idc).alias("id"))

    done = run_concurrently({t: (lambda t=t, i=i, n=n, c=c: refresh(t, i, n, c)) for t, _, i, n, c in _REFRESHED})
    return A.union_all(list(done.values()))


def _dims(spark, d, oc=None) -> dict[str, DataFrame]:
    """All four dimensions; with ``oc`` (orders x customer, materialised once) every source derives
    from it, and both temperature dimensions come from one scan of the readings."""
    temp_country, temp_state = D.split_temperature_monthly(D.temperature_monthly(G.temperature(spark, d, oc)))
    return run_concurrently({
        "economics_country": lambda: D.economics_country(
            D.economics_country_no_labels(*_economics_parts(spark, d, oc)), G.country_labels(spark, d)),
        "economics_us_state": lambda: D.economics_us_state(
            D.economics_us_state_no_labels(G.unemployment_us_state(spark, d, oc)), G.state_labels(spark, d)),
        "temperature_country": lambda: D.temperature_country(temp_country, G.country_labels(spark, d)),
        "temperature_us_state": lambda: D.temperature_us_state(temp_state, G.state_labels(spark, d))})


def _fact(spark, d, dims, oc=None, **options) -> DataFrame:
    return i94_fact(G.fact_source(spark, d, oc), dims["economics_country"], dims["economics_us_state"],
                    dims["temperature_country"], dims["temperature_us_state"], **options)


_FACT_SELECT = "SELECT " + ", ".join(FACT_COLUMNS + FACT_IDS) + " FROM fact"


@register("fact_fk_lookup", with_ctes(["fact"], _FACT_SELECT))
def q_fact_fk_lookup(spark, d):
    oc = G.shared_orders_customers(spark, d)
    return _fact(spark, d, _dims(spark, d, oc), oc)


@register("fact_one_exchange", with_ctes(["fact"], _FACT_SELECT))
def q_fact_one_exchange(spark, d):
    """The stored fact of a star whose duplicates were removed in the exchange that laid it out by month."""
    oc = G.shared_orders_customers(spark, d)
    stored = store_star(spark, _dims(spark, d, oc), G.fact_source(spark, d, oc), scratch_path(spark, "laid-out"), one_exchange=True)
    return stored["I94s"]


@register("fact_split_lookup", with_ctes(["fact"], _FACT_SELECT))
def q_fact_split_lookup(spark, d):
    """The fact with its dimension ids by shuffled lookups alone: hot and NULL keys are split over tasks."""
    oc = G.shared_orders_customers(spark, d)
    return _fact(spark, d, _dims(spark, d, oc), oc, max_broadcast_rows=-1)


_PK_PARTS = [("economics_country", "ec", "id_economics_country"), ("economics_us_state", "eus", "id_economics_us_state"),
             ("temperature_country", "tc", "id_temperature_country"),
             ("temperature_us_state", "tus", "id_temperature_us_state")]


def _star(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The star of the folder, built anew by each query that checks it: dimensions with checkpointed ids, and
    the fact against them."""
    oc = G.shared_orders_customers(spark, d)
    dims = _dims(spark, d, oc)
    return {**dims, "fact": _fact(spark, d, dims, oc)}


def _star_dims(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return _dims(spark, d, G.shared_orders_customers(spark, d))


@register("pk_check", with_ctes([c for _, c, _ in _PK_PARTS], "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, max({i}) AS max_id, count({i}) AS n_ids, count(DISTINCT {i}) AS n_distinct,
       min({i}) AS min_id, count(*) - count({i}) AS n_null, max({i}) = count({i}) AS max_equals_count,
       (max({i}) = count({i}) AND count(DISTINCT {i}) = count({i}) AND min({i}) = 1 AND count(*) = count({i}))
           AS is_dense
FROM {c}""" for t, c, i in _PK_PARTS)))
def q_pk_check(spark, d):
    star = _star_dims(spark, d)
    return A.union_all([Q.pk_check(star[t], i, t) for t, _, i in _PK_PARTS])


def _register_views(spark, d) -> dict[str, str]:
    views = {}
    for name, df in _star(spark, d).items():
        view = f"starloom_{name}"
        df.createOrReplaceTempView(view)
        views[name] = view
    return views


@register("star_join_sql", with_ctes(["fact"], Q.STAR_JOIN_SQL.format(
    fact="fact", economics_country="ec", economics_us_state="eus", temperature_country="tc",
    temperature_us_state="tus")))
def q_star_join_sql(spark, d):
    return Q.star_join_sql(spark, _register_views(spark, d))


_COVERAGE = [("temperature_us_state", "id_temperature_us_state", "tus"),
             ("temperature_country", "id_temperature_country", "tc"),
             ("economics_us_state", "id_economics_us_state", "eus"),
             ("economics_country", "id_economics_country", "ec")]


@register("star_coverage", with_ctes(["fact"], """
SELECT check_name, n_fact, n_matched, n_matched / n_fact AS matched_ratio FROM (
  SELECT count(*) AS n_fact,
         count(tus.id_temperature_us_state) AS temperature_us_state,
         count(tc.id_temperature_country) AS temperature_country,
         count(eus.id_economics_us_state) AS economics_us_state,
         count(ec.id_economics_country) AS economics_country,
         CAST(count_if(tus.id_temperature_us_state IS NOT NULL AND tc.id_temperature_country IS NOT NULL
                  AND eus.id_economics_us_state IS NOT NULL AND ec.id_economics_country IS NOT NULL) AS BIGINT) AS _all
  FROM fact f
  LEFT JOIN tus ON f.id_temperature_us_state = tus.id_temperature_us_state
  LEFT JOIN tc ON f.id_temperature_country = tc.id_temperature_country
  LEFT JOIN eus ON f.id_economics_us_state = eus.id_economics_us_state
  LEFT JOIN ec ON f.id_economics_country = ec.id_economics_country
) UNPIVOT (n_matched FOR check_name IN (temperature_us_state, temperature_country, economics_us_state,
                                         economics_country, _all))"""))
def q_star_coverage(spark, d):
    star = _star(spark, d)
    return Q.star_coverage(star["fact"], {name: (star[name], idc) for name, idc, _ in _COVERAGE})


_MATCHED_IDS = ["id_temperature_us_state", "id_temperature_country", "id_economics_us_state"]


@register("fully_matched_fact", with_ctes(["fact"], _FACT_SELECT + " WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in _MATCHED_IDS)))
def q_fully_matched_fact(spark, d):
    """Fact rows that found their state and country rows for their month (the id columns listed
    twice in the original check collapse to one condition each)."""
    fact = _star(spark, d)["fact"]
    return A.drop_null_subset(fact, _MATCHED_IDS + ["id_temperature_us_state"]).select(*FACT_COLUMNS, *FACT_IDS)


_NATURAL_KEYS = [("economics_country", "ec", ["year", "country_code"]),
                 ("economics_us_state", "eus", ["year", "month", "state_code"]),
                 ("temperature_country", "tc", ["year", "month", "country_code"]),
                 ("temperature_us_state", "tus", ["year", "month", "state_code"])]


@register("natural_key_check", with_ctes([c for _, c, _ in _NATURAL_KEYS], "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, count(*) AS n_keys, CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0)
       AS BIGINT) AS n_repeated_keys
FROM (SELECT {', '.join(k)}, count(*) AS n FROM {c} GROUP BY {', '.join(k)})""" for t, c, k in _NATURAL_KEYS)))
def q_natural_key_check(spark, d):
    """Per dimension: natural keys the fact looks up, and how many of them repeat (each
    repeat would multiply fact rows in the lookup)."""
    star = _star_dims(spark, d)
    parts = []
    for t, _, keys in _NATURAL_KEYS:
        per_key = star[t].groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(F.count(F.lit(1)).alias("n_keys"),
                                 F.count_if(F.col("n") > 1).alias("n_repeated_keys"))
                     .select(F.lit(t).alias("table_name"), "n_keys", "n_repeated_keys"))
    return A.union_all(parts)


@register("stream_monthly_refresh", with_ctes(["fact"], _FACT_SELECT))
def q_stream_monthly_refresh(spark, d):
    """Two monthly deliveries (earlier years, then the latest year) through the streaming refresh."""
    from ..streaming.refresh import run_monthly_refresh
    star = _star_dims(spark, d)
    src = G.fact_source(spark, d)
    base = scratch_path(spark, "stream")
    last_year = T(spark, d, "orders").agg(F.max(F.year("o_orderdate")).alias("y")).first()["y"]
    deliveries = [src.filter(F.col("I94YR") < F.lit(float(last_year))),
                  src.filter(F.col("I94YR") >= F.lit(float(last_year)))]
    for i, delivery in enumerate(deliveries):
        delivery.write.parquet(f"{base}/incoming/delivery={i}")
        run_monthly_refresh(spark, f"{base}/incoming", src.schema, star, f"{base}/I94s.parquet",
                            f"{base}/_checkpoint")
    out = spark.read.parquet(f"{base}/I94s.parquet")
    return out.select(*FACT_COLUMNS, *FACT_IDS)


@register("stream_delivery_ledger", with_ctes(["fact"], """,
months AS (SELECT i94yr, i94mon, i94yr > (SELECT min(i94yr) FROM fact_src) AS late, bool_or(cicid % 2 = 0) AS half
           FROM fact_src GROUP BY ALL),
held AS (SELECT i94yr, i94mon, count(*) AS n, CAST(sum(CAST(cicid AS HUGEINT)) AS VARCHAR) AS cicid_sum,
                count(id_economics_us_state) AS n_state FROM fact GROUP BY ALL)
SELECT i94yr, i94mon, n AS n_rows, cicid_sum, n_state, CASE WHEN late THEN '10' ELSE '9' END AS delivery,
       CASE WHEN late AND half THEN 1 ELSE 0 END::BIGINT AS n_ignored
FROM months JOIN held USING (i94yr, i94mon)""").replace("\n,\nmonths AS", ",\nmonths AS"))
def q_stream_delivery_ledger(spark, d):
    """Deliveries out of order over three runs: 10 (all years but the first), then the older 9 (every year, the later ones with
    half of their rows only), then 10 again from a lost checkpoint.  Per month: what the fact holds, and what the ledger says."""
    from ..streaming.ledger import APPLIED, IGNORED
    from ..streaming.refresh import run_monthly_refresh
    star = _star_dims(spark, d)
    src = G.fact_source(spark, d)
    base = scratch_path(spark, "ledger")
    first = T(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("y")).first()["y"]
    late = F.col("I94YR") > F.lit(float(first))

    def run(name: str) -> None:
        run_monthly_refresh(spark, f"{base}/incoming", src.schema, star, f"{base}/I94s.parquet", f"{base}/{name}",
                            ledger_path=f"{base}/ledger")

    src.filter(late).write.parquet(f"{base}/incoming/delivery=10")
    run("checkpoint")
    src.filter(~late | (F.col("CICID") % 2 == 0)).write.parquet(f"{base}/incoming/delivery=9")
    run("checkpoint")
    run("new-checkpoint")
    fact = spark.read.parquet(f"{base}/I94s.parquet").groupBy("i94yr", "i94mon").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("cicid").cast("decimal(38,0)")).cast("string").alias("cicid_sum"),
        F.count("id_economics_us_state").alias("n_state"))
    ledger = spark.read.parquet(f"{base}/ledger").groupBy("ledger_year", "ledger_month").agg(
        F.max(F.when(F.col("status") == APPLIED, F.col("delivery"))).alias("delivery"),
        F.countDistinct(F.when(F.col("status") == IGNORED, F.col("delivery"))).alias("n_ignored"))
    return (fact.join(ledger, (F.col("i94yr") == F.col("ledger_year")) & (F.col("i94mon") == F.col("ledger_month")))
            .select("i94yr", "i94mon", "n_rows", "cicid_sum", "n_state", "delivery", "n_ignored"))


def star_inputs_from_files(spark: SparkSession, d: str) -> StarInputs:
    """Write the analog sources as the files the builder reads (CSV, label text, fact source), then read them."""
    base = scratch_path(spark, "sources")
    years = G.order_years(spark, d)
    oc = G.shared_orders_customers(spark, d)
    csvs = {"political_stability_country.csv": G.political_stability_wide(spark, d, years, oc),
            "unemployment_country.csv": G.unemployment_country_wide(spark, d, years, oc),
            "population_country.csv": G.population(spark, d, oc),
            "unemployment_us_state.csv": G.unemployment_us_state(spark, d, oc),
            "temperature_country_us_state.csv": G.temperature(spark, d, oc)}
    writes = {name: (lambda df=df, name=name: write_header_csv(df, f"{base}/{name}")) for name, df in csvs.items()}
    writes["labels"] = lambda: write_label_file(G.label_sections_raw(spark, d), f"{base}/labels.sas")
    writes["fact"] = lambda: G.fact_source(spark, d, oc).write.parquet(f"{base}/i94.parquet")
    paths = run_concurrently(writes)
    read = {name: read_header_csv(spark, paths[name]) for name in csvs}
    labels = paths["labels"]
    return StarInputs(political_stability=read["political_stability_country.csv"],
                      unemployment_country=read["unemployment_country.csv"],
                      population=read["population_country.csv"],
                      unemployment_us_state=read["unemployment_us_state.csv"],
                      temperature=read["temperature_country_us_state.csv"],
                      fact_source=read_fact_source(spark, f"{base}/i94.parquet"),
                      label_lines=read_label_lines(spark, labels), series=G.SERIES)


# numbers of each table of the star beside its ids
_STAR_NUMBERS = [("economics_country", "ec", 10, ["year", "pss", "uwae", "uwbe", "uwie", "ut", "powp", "country_code"]),
                 ("economics_us_state", "eus", 6, ["year", "month", "ut"]),
                 ("temperature_country", "tc", 8, ["year", "month", *D.TEMPERATURE_MEASURES, "country_code"]),
                 ("temperature_us_state", "tus", 8, ["year", "month", *D.TEMPERATURE_MEASURES]),
                 ("I94s", "fact", 27, FACT_INT_COLUMNS)]


def _sums_sql(table: str, cte: str, n_columns: int, numbers: list[str]) -> str:
    ids = FACT_IDS if cte == "fact" else [f"id_{table}"]
    id_sum = " + ".join(f"coalesce(CAST({c} AS HUGEINT), 0)" for c in ids)
    value_sum = " + ".join(f"coalesce(CAST(floor(CAST({c} AS DOUBLE) * 1000) AS HUGEINT), 0)" for c in numbers)
    return (f"SELECT '{table}' AS table_name, count(*) AS n_rows, {n_columns} AS n_columns, "
            f"CAST(coalesce(sum({id_sum}), 0) AS VARCHAR) AS id_sum, "
            f"CAST(coalesce(sum({value_sum}), 0) AS VARCHAR) AS value_sum FROM {cte}")


_WRITE_CHECKS = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, unnest(['n_rows', 'n_ids', 'max_id', 'min_id', 'id_sum']) AS check_name,
       unnest([count(*), count({i}), max({i}), min({i}), CAST(sum({i}) AS BIGINT)]) AS value,
       unnest([NULL, count(*), count(*), 1, count(*) * (count(*) + 1) // 2]) AS expected FROM {c}""" for t, c, i in _PK_PARTS)


@register("star_write_checks", with_ctes(["fact"], f"""SELECT table_name, check_name, value::BIGINT AS value, expected::BIGINT AS expected
FROM ({_WRITE_CHECKS} UNION ALL
SELECT 'I94s', unnest(['n_rows', {", ".join(f"'matched_{i}'" for _, _, i in _PK_PARTS)}, 'matched_all']),
       unnest([count(*), {", ".join(f"count({i})" for _, _, i in _PK_PARTS)},
               CAST(count_if({" AND ".join(f"{i} IS NOT NULL" for _, _, i in _PK_PARTS)}) AS BIGINT)]),
       unnest([NULL::BIGINT, NULL, NULL, NULL, NULL, NULL]) FROM fact)"""))
def q_star_write_checks(spark, d):
    """Key and row-count checks of a stored star, measured on the rows while they are written."""
    report = WriteReport()
    oc = G.shared_orders_customers(spark, d)
    store_star(spark, _dims(spark, d, oc), G.fact_source(spark, d, oc), scratch_path(spark, "checked"), report=report)
    return report.frame(spark)


@register("star_build", with_ctes(["fact"], "\nUNION ALL\n".join(_sums_sql(*t) for t in _STAR_NUMBERS)))
def q_star_build(spark, d):
    stored = build_star(spark, star_inputs_from_files(spark, d), scratch_path(spark, "star"))
    return star_sums(stored)


# ============================================================================ profiles

_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("profile_csv", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
       (count(*) - count({c})) / count(*) AS null_ratio, count(DISTINCT {c}) AS n_distinct FROM customer"""
    for c in _CUSTOMER_COLS))
def q_profile_csv(spark, d):
    """Exploration read: a CSV export of customer read back with schema inference and a Latin-1
    decoder, then profiled column by column."""
    path = write_header_csv(T(spark, d, "customer").select(*_CUSTOMER_COLS), scratch_path(spark, "explore"))
    return P.profile_columns(read_header_csv(spark, path, infer_schema=True, encoding="ISO-8859-1"))



_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "urgent_flag", "source_tag"]


def _sparse_orders(spark, d) -> DataFrame:
    o = T(spark, d, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_custkey")).alias("o_custkey"),
                    "o_orderstatus",
                    F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority")).alias("urgent_flag"),
                    F.lit("X").alias("source_tag"))


def _profile_sql() -> str:
    parts = [f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
       (count(*) - count({c})) / count(*) AS null_ratio, count(DISTINCT {c}) AS n_distinct FROM sparse_orders"""
             for c in _PROFILE_COLS]
    return "\nUNION ALL\n".join(parts)


@register("profile_columns", with_ctes(["sparse_orders"], _profile_sql()))
def q_profile_columns(spark, d):
    return P.profile_columns(_sparse_orders(spark, d))


@register("profile_examples", with_ctes(["sparse_orders"], "SELECT column_name, rank, value FROM (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, CAST(row_number() OVER (ORDER BY v NULLS FIRST) AS INTEGER) AS rank, v AS value
FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM sparse_orders)""" for c in _PROFILE_COLS) + ") WHERE rank <= 10"))
def q_profile_examples(spark, d):
    return P.profile_examples(_sparse_orders(spark, d), k=10)


@register("sparse_columns", with_ctes(["sparse_orders"],
          "SELECT column_name, null_ratio > 0.4 AS too_sparse, n_distinct <= 1 AS single_valued FROM ("
          + _profile_sql() + ") WHERE null_ratio > 0.4 OR n_distinct <= 1"))
def q_sparse_columns(spark, d):
    return P.sparse_columns(P.profile_columns(_sparse_orders(spark, d)))


@register("drop_sparse_columns", with_ctes(["sparse_orders"], "SELECT o_orderkey, o_custkey, o_orderstatus FROM sparse_orders"))
def q_drop_sparse_columns(spark, d):
    """The table without its sparse and its single-valued column."""
    return P.drop_sparse_columns(_sparse_orders(spark, d))


@register("counts_and_examples", with_ctes(["sparse_orders"], "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, (count(*) - count({c})) / count(*) AS null_ratio,
       (SELECT string_agg(coalesce(v, '(null)'), '|' ORDER BY v NULLS FIRST)
        FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM sparse_orders ORDER BY v NULLS FIRST LIMIT 3)) AS examples FROM sparse_orders"""
    for c in _PROFILE_COLS)))
def q_counts_and_examples(spark, d):
    """Counts and the first three values of every column in one pass."""
    p = P.counts_and_examples(_sparse_orders(spark, d), k=3)
    shown = F.array_join(F.transform("examples", lambda x: F.coalesce(x, F.lit("(null)"))), "|")
    return p.withColumn("examples", shown)


@register("profile_from_sketches", with_ctes(["sparse_orders"], """,
kept AS (SELECT s.* FROM sparse_orders s JOIN orders o USING (o_orderkey)
         WHERE year(o_orderdate) > (SELECT min(year(o_orderdate)) FROM orders))
""".replace("kept AS", "kept AS") + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,
       (count(*) - count({c})) / count(*) AS null_ratio, true AS within_error FROM kept""" for c in _PROFILE_COLS))
    .replace("\n,\nkept AS", ",\nkept AS"))
def q_profile_from_sketches(spark, d):
    """Summaries stored per month in two deliveries (a month of the first comes again), then the profile of all years but
    the first from the summaries alone; its distinct counts lie within four standard errors of the exact ones."""
    dates = T(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    rows = _sparse_orders(spark, d).join(dates, "o_orderkey")
    path = scratch_path(spark, "summaries")
    first_year = dates.agg(F.min("year").alias("y")).first()["y"]
    half = F.col("month") <= 6
    S.store_summaries(rows.filter(half), path, ["year", "month"], _PROFILE_COLS)
    S.store_summaries(rows.filter(~half | (F.col("month") == 6)), path, ["year", "month"], _PROFILE_COLS)
    got = S.profile_from_summaries(S.read_summaries(spark, path).filter(F.col("year") > F.lit(first_year)))
    exact = P.profile_columns(rows.filter(F.col("year") > F.lit(first_year)), _PROFILE_COLS).select(
        F.col("column_name").alias("c"), F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact")) <= F.lit(4 * S.standard_error()) * F.col("exact")
    return got.join(exact, F.col("column_name") == F.col("c")).select("column_name", "n_rows", "n_null", "null_ratio", off.alias("within_error"))


# columns of the orders as text, and the SQL of the same text
_TEXT_COLS = {"o_orderkey": "CAST(o_orderkey AS VARCHAR)", "o_totalprice": "CAST(o_totalprice AS VARCHAR)",
              "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d')", "o_orderpriority": "o_orderpriority",
              "mixed": "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE ' ' || CAST(o_custkey AS VARCHAR) || ' ' END",
              "large": "CAST(o_orderkey * 100000000000 AS VARCHAR)", "blank": "CASE WHEN o_orderkey % 2 = 0 THEN '  ' END",
              "flag": "CASE WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'false' END"}


def _lost_sql(v: str) -> str:
    number, day = f"regexp_matches({v}, '^[+-]?[0-9]+$')", f"regexp_matches({v}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
    ok = {"boolean": f"lower({v}) IN ('true', 'false')", "int": f"{number} AND TRY_CAST({v} AS INTEGER) IS NOT NULL",
          "bigint": f"{number} AND TRY_CAST({v} AS BIGINT) IS NOT NULL",
          "double": f"regexp_matches({v}, '^[+-]?[0-9]+[.]?[0-9]*([eE][+-]?[0-9]+)?$')",
          "date": f"{day} AND TRY_CAST({v} AS DATE) IS NOT NULL", "timestamp": f"{day} AND TRY_CAST({v} AS DATE) IS NOT NULL"}
    return ", ".join(f"count(*) FILTER ({v} IS NOT NULL AND NOT ({ok[t]})) AS n_lost_{t}" for t in I.TYPES)


@register("infer_types", "WITH t AS (SELECT " + ", ".join(f"nullif(trim({x}), '') AS {c}" for c, x in _TEXT_COLS.items())
          + " FROM orders), c AS (" + " UNION ALL ".join(
              f"SELECT '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values, {_lost_sql(c)} FROM t" for c in _TEXT_COLS)
          + ") SELECT column_name, n_rows, n_values, CASE WHEN n_values = 0 THEN 'string' "
          + " ".join(f"WHEN n_lost_{t} = 0 THEN '{t}'" for t in I.TYPES) + " ELSE 'string' END AS inferred_type, "
          + ", ".join(f"n_lost_{t}" for t in I.TYPES) + " FROM c")
def q_infer_types(spark, d):
    """Narrowest type of every text column, and what a cast to each type would lose, in one pass."""
    o = T(spark, d, "orders")
    key = F.col("o_orderkey")
    text = o.select(key.cast("string").alias("o_orderkey"), F.col("o_totalprice").cast("string").alias("o_totalprice"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
                    F.when(key % 3 == 0, F.col("o_orderpriority")).otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))).alias("mixed"),
                    (key * F.lit(100000000000)).cast("string").alias("large"), F.when(key % 2 == 0, F.lit("  ")).alias("blank"),
                    F.when(key % 2 == 0, F.lit("TRUE")).otherwise(F.lit("false")).alias("flag"))
    return I.infer_types(text)
