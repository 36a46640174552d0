"""Small helpers shared by the operators: reading, storing in the shared folder, sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir, scratch_path

#: ASCII white space; every other code point belongs to a word.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_table(df: DataFrame, name: str, partition: str | None = None) -> DataFrame:
    """``store`` for large tables: zstd, and a folder per value of ``partition``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_groups(df: DataFrame, size: Column, per_group: int, least: int = 64) -> int:
    """Number of hash groups so that each holds about ``per_group`` units of ``size``."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return max(least, -(-int(total) // per_group))


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z only, as the word contracts ask."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(c: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), SPACE + "+"), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable holds the value, so later filters or projections that Catalyst merges with
    this one cannot evaluate it again for each element of an array.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def doc_bytes(c: str = "text") -> Column:
    return F.octet_length(F.coalesce(F.col(c), F.lit(""))) + F.lit(16)
