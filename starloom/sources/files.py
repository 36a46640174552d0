"""Readers and writers: header CSV, fact source, partitioned Parquet sinks and monthly refresh."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_header_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    encoding: str = "UTF-8", sep: str = ",", infer_schema: bool = False) -> DataFrame:
    """CSV with a header row.  Without ``schema`` every column is a string (no inference,
    so no extra pass over the data); wide files keep their header-derived column set.
    ``infer_schema=True`` is for exploration (profiles) only: it costs a full extra pass."""
    reader = spark.read.option("header", True).option("encoding", encoding).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", bool(infer_schema))
    return reader.csv(path)


def write_header_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def lowercase_names(df: DataFrame) -> DataFrame:
    """Force every column name to lower case (what the fact reader did with its SAS codec)."""
    return df.toDF(*[c.lower() for c in df.columns])


def read_fact_source(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read the fact source in any Spark-supported format and lower-case its column names."""
    return lowercase_names(spark.read.format(fmt).options(**options).load(path))


def _layout(df: DataFrame, partition_by: Sequence[str], colocate: bool, rebalance: bool) -> DataFrame:
    if colocate:
        # small tables: one task per output directory
        return df.repartition(*[F.col(c) for c in partition_by])
    if rebalance:
        # large tables: group rows by output directory, and let AQE split a directory that holds a
        # large share of the rows into several tasks and merge small ones (no hot task, no flood of tiny files)
        return df.hint("rebalance", *partition_by)
    return df


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str], mode: str = "errorifexists",
                      max_records_per_file: int | None = None, colocate: bool = False,
                      rebalance: bool = False, observe: Mapping[str, Column] | None = None,
                      observed: dict | None = None) -> str:
    """Write ``df`` as Parquet partitioned by ``partition_by``.

    The default mode fails when the target exists.  ``colocate=True`` hash-repartitions by the
    partition columns so each directory is written by one task (dimension tables).
    ``rebalance=True`` (fact tables) uses the ``rebalance`` hint: rows are grouped by directory and
    adaptive execution splits skewed directories across tasks.  ``max_records_per_file`` bounds
    file sizes.  The aggregates ``observe`` (name -> column) are measured on the rows as they are written and put into
    ``observed``: no further scan.
    """
    watch = None
    if observe:
        watch = Observation()
        df = df.observe(watch, *[c.alias(n) for n, c in observe.items()])
    w = _layout(df, partition_by, colocate, rebalance).write.mode(mode).partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)
    if watch is not None and observed is not None:
        observed.update(watch.get)
    return path


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       max_records_per_file: int | None = None, rebalance: bool = False) -> str:
    """Monthly refresh: overwrite only the partitions present in ``df`` (dynamic overwrite);
    every other partition already under ``path`` is left as it is."""
    w = (_layout(df, partition_by, False, rebalance).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)
    return path


def read_partitioned(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     schema: T.StructType | None = None) -> DataFrame:
    """Read a partitioned Parquet table back.  Partition columns come back last and with inferred
    types; pass ``schema`` to pin them, and ``columns`` to restore a column order by name."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df
