"""Source tables in the shapes the star builder reads, derived by Spark from the test tables.

Analog roles: orders = arrivals (fact); nation (through customer) = country;
``c_mktsegment`` = US state; year/month of ``o_orderdate`` = time; ``o_orderpriority`` =
unemployment series; order counts / prices = measures.  Every frame is computed from the
given tables, so its work grows with them.

The label tables are whole.  Names without a label, gaps between the sources, missing cells and repeated
rows come from the sources themselves: region, world and territory totals beside the countries (each in one
source only), orders at sea and offshore, and rows that are delivered twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Analog series -> measure column of the unemployment pivot.  The lowest priority is
# delivered as a second row of the last series, so all orders are counted and cells with two rows add up.
SERIES = {"1-URGENT": "uwae", "2-HIGH": "uwbe", "3-MEDIUM": "uwie", "4-NOT SPECIFIED": "ut"}
# Names that the label tables do not know, and a country code that no country has.
WORLD = "WORLD"
TERRITORY = "TERRITORY "
AT_SEA = "AT SEA"
OFFSHORE = "OFFSHORE"
NO_COUNTRY = 99


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"))


def shared_orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined with customer once, stored as Parquet in the shared folder (readers prune its columns),
    for builds that derive several sources from it."""
    path = scratch_path(spark, "orders-customers")
    orders_customers(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def orders_customers_nations(spark: SparkSession, sf_dir: str, oc: DataFrame | None = None) -> DataFrame:
    # nation is a file-backed table: Catalyst broadcasts it from its file-size statistics, and AQE
    # re-checks the measured size at run time, so no extra counting job is needed here
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    oc = orders_customers(spark, sf_dir) if oc is None else oc
    return oc.join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def state_code(segment) -> "F.Column":
    return F.upper(F.substring(segment, 1, 2))


def country_place() -> "F.Column":
    """Country of an order; pending orders are at sea, which no label names."""
    return F.when(F.col("o_orderstatus") == "P", AT_SEA).otherwise(F.col("n_name"))


def state_place() -> "F.Column":
    """State of an order; those of the lowest priority are offshore, which no label names."""
    return F.when(F.col("o_orderpriority") == "5-LOW", OFFSHORE).otherwise(F.col("c_mktsegment"))


def order_years(spark: SparkSession, sf_dir: str) -> list[str]:
    """Distinct order years as the wide tables' year columns (a calendar date has at most 9999 of them)."""
    rows = (table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).filter(F.col("y").isNotNull())
            .distinct().collect())
    return [str(r["y"]) for r in sorted(rows, key=lambda r: r["y"])]


# ----------------------------------------------------------------------------- labels (code, label)

def country_labels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"),
                                                 F.col("n_name").alias("label"))


def state_labels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return c.select(state_code(F.col("c_mktsegment")).alias("code"), F.col("c_mktsegment").alias("label"))


def country_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_labels_raw(spark, sf_dir).select(F.col("code").alias("country_code"),
                                                    F.lower("label").alias("country_name"))


def state_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_labels_raw(spark, sf_dir).select(F.col("code").alias("state_code"),
                                                  F.lower("label").alias("state_name"))


def port_labels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderstatus").distinct()
    return o.select(F.col("o_orderstatus").alias("code"), F.concat(F.lit("PORT "), "o_orderstatus").alias("label"))


def mode_labels_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("label"))


def label_sections_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"i94cntyl": country_labels_raw(spark, sf_dir), "i94prtl": port_labels_raw(spark, sf_dir),
            "i94model": mode_labels_raw(spark, sf_dir), "i94addrl": state_labels_raw(spark, sf_dir)}


# ----------------------------------------------------------------------------- wide and long sources

def political_stability_wide(spark: SparkSession, sf_dir: str, years: list[str] | None = None,
                             oc: DataFrame | None = None) -> DataFrame:
    """One row per country, one string column per year (order count), '..' where missing; beside them one
    row per region that counts the orders of New Year's Day."""
    years = years or order_years(spark, sf_dir)
    ocn = orders_customers_nations(spark, sf_dir, oc).withColumn("y", F.year("o_orderdate").cast("string"))
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    ocn = ocn.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    own = F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("code"))
    whole = F.struct(F.col("r_name").alias("name"), F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"))
    new_year = (F.month("o_orderdate") == 1) & (F.dayofmonth("o_orderdate") == 1) & F.col("r_name").isNotNull()
    rows = ocn.select("y", F.inline(F.when(new_year, F.array(own, whole)).otherwise(F.array(own))))
    wide = rows.groupBy("name", "code").pivot("y", years).agg(F.count(F.lit(1)))
    return wide.select(F.col("name").alias("Country Name"), F.col("code").alias("Country Code"),
                       F.lit("Political Stability").alias("Series Name"), F.lit("PV.EST").alias("Series Code"),
                       *[F.coalesce(F.col(y).cast("string"), F.lit("..")).alias(y) for y in years])


def unemployment_country_wide(spark: SparkSession, sf_dir: str, years: list[str] | None = None,
                              oc: DataFrame | None = None) -> DataFrame:
    """One row per (country, series), one string column per year; the world total has the last series only."""
    years = years or order_years(spark, sf_dir)
    ocn = orders_customers_nations(spark, sf_dir, oc).withColumn("y", F.year("o_orderdate").cast("string"))
    own = F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("code"))
    world = F.struct(F.lit(WORLD).alias("name"), F.lit("WLD").alias("code"))
    last = F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW")
    rows = ocn.select("y", "o_orderpriority", F.inline(F.when(last, F.array(own, world)).otherwise(F.array(own))))
    wide = rows.groupBy("name", "code", "o_orderpriority").pivot("y", years).agg(F.count(F.lit(1)))
    return wide.select(F.col("name").alias("Country Name"), F.col("code").alias("Country Code"),
                       F.when(F.col("o_orderpriority") == "5-LOW", "4-NOT SPECIFIED").otherwise(F.col("o_orderpriority"))
                       .alias("Series Name"),
                       F.concat(F.lit("SL.UEM."), F.substring("o_orderpriority", 1, 1)).alias("Series Code"),
                       *[F.coalesce(F.col(y).cast("string"), F.lit("..")).alias(y) for y in years])


def population(spark: SparkSession, sf_dir: str, oc: DataFrame | None = None) -> DataFrame:
    """(Country Name, Year, Count) strings: line items per country and year, and per territory (delivered twice)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey")
    ocn = orders_customers_nations(spark, sf_dir, oc)
    j = li.join(ocn, F.col("l_orderkey") == F.col("o_orderkey"))
    own = F.struct(F.col("n_name").alias("name"), F.lit(1).alias("copies"))
    territory = F.struct(F.concat(F.lit(TERRITORY), F.col("c_mktsegment")).alias("name"), F.lit(2).alias("copies"))
    rows = j.select(F.year("o_orderdate").alias("y"), F.inline(F.array(own, territory)))
    agg = rows.groupBy("name", "copies", "y").agg(F.count(F.lit(1)).alias("n"))
    return agg.select(F.col("name").alias("Country Name"), F.col("y").cast("string").alias("Year"),
                      F.col("n").cast("string").alias("Count"), "copies").withColumn(
        "copies", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).drop("copies")


def unemployment_us_state(spark: SparkSession, sf_dir: str, oc: DataFrame | None = None) -> DataFrame:
    """(Year, Month name, State, County, Rate) strings: one row per order."""
    oc = orders_customers(spark, sf_dir) if oc is None else oc
    return oc.select(F.year("o_orderdate").cast("string").alias("Year"),
                     F.date_format("o_orderdate", "MMMM").alias("Month"),
                     state_place().alias("State"), F.col("c_name").alias("County"),
                     F.col("o_totalprice").cast("string").alias("Rate"))


def temperature(spark: SparkSession, sf_dir: str, oc: DataFrame | None = None) -> DataFrame:
    """(Region, Country, State, City, Month, Day, Year, AvgTemperature) strings: one row per order;
    finished orders play the 'US' rows."""
    ocn = orders_customers_nations(spark, sf_dir, oc)
    return ocn.select(F.col("n_regionkey").cast("string").alias("Region"),
                      F.when(F.col("o_orderstatus") == "F", F.lit("US")).otherwise(country_place()).alias("Country"),
                      state_place().alias("State"), F.col("c_name").alias("City"),
                      F.month("o_orderdate").cast("string").alias("Month"),
                      F.dayofmonth("o_orderdate").cast("string").alias("Day"),
                      F.year("o_orderdate").cast("string").alias("Year"),
                      F.col("o_totalprice").cast("string").alias("AvgTemperature"))


def fact_source(spark: SparkSession, sf_dir: str, oc: DataFrame | None = None) -> DataFrame:
    """28 upper-case columns, numeric codes as double, some text in numeric-looking columns; pending orders
    are delivered twice."""
    oc = orders_customers(spark, sf_dir) if oc is None else oc
    pending = F.col("o_orderstatus") == "P"
    copies = F.explode(F.array_repeat(F.lit(1), F.when(pending, 2).otherwise(1)))
    oc = oc.withColumn("_copy", copies)
    d = F.to_date("o_orderdate")
    arr = F.datediff(d, F.lit("1960-01-01").cast("date"))
    key = F.col("o_orderkey")
    bir = F.col("o_custkey") % 80
    dbl = lambda c: c.cast("double")
    return oc.select(
        dbl(key).alias("CICID"), dbl(F.year(d)).alias("I94YR"), dbl(F.month(d)).alias("I94MON"),
        dbl(F.col("c_nationkey")).alias("I94CIT"), F.when(pending, float(NO_COUNTRY)).otherwise(dbl(F.col("c_nationkey"))).alias("I94RES"),
        F.col("o_orderstatus").alias("I94PORT"), dbl(arr).alias("ARRDATE"), dbl(key % 3 + 1).alias("I94MODE"),
        state_code(state_place()).alias("I94ADDR"), dbl(arr + key % 20).alias("DEPDATE"),
        dbl(bir).alias("I94BIR"), dbl(F.substring("o_orderpriority", 1, 1)).alias("I94VISA"),
        F.lit(1.0).alias("COUNT"), F.date_format(d, "yyyyMMdd").alias("DTADFILE"),
        F.lit("SEO").alias("VISAPOST"), F.lit(None).cast("string").alias("OCCUP"),
        F.col("o_orderstatus").alias("ENTDEPA"), F.lit("O").alias("ENTDEPD"),
        F.lit(None).cast("string").alias("ENTDEPU"), F.lit("M").alias("MATFLAG"),
        dbl(F.year(d) - bir).alias("BIRYEAR"),
        F.when(F.col("o_orderstatus") == "P", F.lit("D/S"))
         .otherwise(F.date_format(F.date_add(d, 90), "MMddyyyy")).alias("DTADDTO"),
        F.when(key % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("GENDER"),
        F.lit(None).cast("string").alias("INSNUM"),
        F.concat(F.lit("A"), F.col("c_nationkey").cast("string")).alias("AIRLINE"),
        (F.col("o_totalprice") * 1000).alias("ADMNUM"),
        F.when(F.col("o_orderstatus") == "O", F.lit("LAND"))
         .otherwise(F.col("o_custkey").cast("string")).alias("FLTNO"),
        F.concat(F.lit("V"), F.substring("o_orderpriority", 1, 1)).alias("VISATYPE"))
