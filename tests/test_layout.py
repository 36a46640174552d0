"""De-duplication and layout of the fact by one exchange."""

import re

from pyspark.sql import functions as F

from starloom.operators.layout import directory_sizes, distinct_in_layout
from starloom.sources.files import read_partitioned, write_partitioned


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _copies(spark):
    """A third of the rows are equal; the others occur once or twice."""
    i = F.col("id")
    return spark.range(30_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 9_000).alias("a"), F.when(i % 3 == 0, "x").otherwise((i % 9_000 % 7).cast("string")).alias("b"),
        F.when(i % 3 == 0, 4).when(i % 9_000 % 11 == 0, None).otherwise(i % 9_000 % 5).cast("int").alias("mon"))


def test_heavy_rows_are_found_and_all_rows_kept(spark):
    df = _copies(spark)
    sizes = {r["_key0"]: r for r in directory_sizes(df, ["mon"], 500).collect()}
    assert len(sizes) == 6 and None in sizes and sum(r["_n"] for r in sizes.values()) == 30_000
    assert {k: len(r["_heavy"]) for k, r in sizes.items()} == {None: 0, 0: 0, 1: 0, 2: 0, 3: 0, 4: 1}
    assert _rows(distinct_in_layout(df, ["mon"], 500)) == _rows(df.distinct())
    assert _rows(distinct_in_layout(df, ["mon"])) == _rows(df.distinct())
    assert distinct_in_layout(df.limit(0), ["mon"]).count() == 0


def test_heavy_rows_do_not_fill_a_task(spark, tmp_dir):
    """What the exchange deals to a task, counted before copies are removed: the heavy row is not among it."""
    plan = distinct_in_layout(_copies(spark), ["mon"], 500)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"REPARTITION_BY_COL", plan)) == 1 and plan.count("ENSURE_REQUIREMENTS") == 1  # the heavy rows' own


def test_one_exchange_and_one_month_by_many_tasks(spark, tmp_dir):
    df = spark.range(40_000).select((F.col("id") % 39_000).alias("a"), F.lit(2016).alias("yr"), F.lit(4).alias("mon")).checkpoint()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = distinct_in_layout(df, ["yr", "mon"], 1_000)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        path = write_partitioned(out, tmp_dir + "/t", ["yr", "mon"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = read_partitioned(spark, path)
    assert back.count() == 39_000
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) >= 6 and max(per_file) < 39_000 / 3
