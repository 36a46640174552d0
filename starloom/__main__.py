"""Build the star from source files, or refresh a stored one.

``python -m starloom --out BASE ...`` builds and writes the five tables, prints the checks measured while they were
written and ends with status 1 if one fails.  ``python -m starloom refresh --out BASE --deliveries FOLDER`` applies the
deliveries of the fact source not yet seen (``delivery=NAME/`` folders, any order, the ledger lies beside the star); with
the dimension sources given as well, the dimensions are refreshed first, with stable ids.

The session comes from ``spark-submit`` / the cluster's own configuration; the shared
checkpoint folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans.star import ID_COLUMNS, StarInputs, WriteReport, build_star, refresh_dimensions
from .session import ensure_checkpoint_dir
from .sources.files import read_fact_source, read_header_csv
from .sources.labels import read_label_lines
from .streaming.refresh import run_monthly_refresh

DIMENSION_SOURCES = {"political_stability": "wide CSV, one column per year", "unemployment_country": "wide CSV, one row per series",
                     "population": "CSV: Country Name, Year, Count", "unemployment_us_state": "CSV: Year, Month, State, County, Rate",
                     "temperature": "CSV: Region, Country, State, City, Month, Day, Year, ...",
                     "labels": "label text file with the code sections"}


def parse_args(argv=None) -> argparse.Namespace:
    argv = list(sys.argv[1:] if argv is None else argv)
    refresh = argv[:1] == ["refresh"]
    p = argparse.ArgumentParser(prog="starloom refresh" if refresh else "starloom", description=__doc__.splitlines()[0])
    for name, text in DIMENSION_SOURCES.items():
        p.add_argument("--" + name.replace("_", "-"), required=not refresh, help=text)
    if refresh:
        p.add_argument("--deliveries", required=True, help="folder of the fact source's delivery=NAME folders")
        p.add_argument("--older", default="ignore", choices=["ignore", "refuse"], help="older deliveries than the stored one of a month")
        p.add_argument("--timeout", type=float, default=None, help="seconds")
    else:
        p.add_argument("--fact", required=True, help="arrivals source (any Spark-readable format)")
        p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
        p.add_argument("--max-records-per-file", type=int, default=None)
    p.add_argument("--partitions", default=None,
                   help='JSON object table -> partition columns, for dimensions that are not to lie as by default')
    p.add_argument("--fact-format", default="parquet")
    p.add_argument("--series", default=None,
                   help='JSON object series name -> column (uwae, uwbe, uwie, ut); default: discovered')
    p.add_argument("--out", required=True, help="base folder of the five output tables")
    p.add_argument("--bigint-ids", action="store_true", help="cast fact codes to bigint instead of int")
    a = p.parse_args(argv[1:] if refresh else argv)
    a.command = "refresh" if refresh else "build"
    given = [getattr(a, n) is not None for n in DIMENSION_SOURCES]
    if any(given) and not all(given):
        p.error("the dimensions are refreshed from all their sources or not at all")
    a.dimensions = all(given)
    return a


def _inputs(spark: SparkSession, a: argparse.Namespace, fact=None) -> StarInputs:
    csv = {n: read_header_csv(spark, getattr(a, n)) for n in DIMENSION_SOURCES if n != "labels"}
    return StarInputs(**csv, fact_source=fact, label_lines=read_label_lines(spark, a.labels),
                      series=json.loads(a.series) if a.series else {})


def build(spark: SparkSession, a: argparse.Namespace) -> int:
    report = WriteReport()
    build_star(spark, _inputs(spark, a, read_fact_source(spark, a.fact, fmt=a.fact_format)), a.out, mode=a.mode,
               int_type="bigint" if a.bigint_ids else "int", max_records_per_file=a.max_records_per_file, report=report,
               partitions=json.loads(a.partitions) if a.partitions else None)
    for row in report.rows():
        print(*row)
    failed = report.failures()
    if failed:
        print("failed:", *failed, file=sys.stderr)
    return 1 if failed else 0


def refresh(spark: SparkSession, a: argparse.Namespace) -> int:
    base = a.out.rstrip("/")
    if a.dimensions:
        refresh_dimensions(spark, _inputs(spark, a), base, json.loads(a.partitions) if a.partitions else None)
    dims = {n: spark.read.parquet(f"{base}/{n}.parquet") for n in ID_COLUMNS}
    # the declared columns are those of the deliveries found now, without the folder's own
    found = spark.read.format(a.fact_format).option("recursiveFileLookup", True).load(a.deliveries).schema
    run_monthly_refresh(spark, a.deliveries, found, dims, f"{base}/I94s.parquet", f"{base}/_refresh",
                        source_format=a.fact_format, int_type="bigint" if a.bigint_ids else "int", timeout_sec=a.timeout,
                        ledger_path=f"{base}/_ledger", older=a.older)
    return 0


def main(argv=None) -> int:
    a = parse_args(argv)
    spark = SparkSession.builder.appName("starloom").getOrCreate()
    ensure_checkpoint_dir(spark)
    return {"build": build, "refresh": refresh}[a.command](spark, a)


if __name__ == "__main__":
    sys.exit(main())
