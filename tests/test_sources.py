import contextlib
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from starloom.sources.files import (_layout, lowercase_names, read_header_csv, read_partitioned,
                                    refresh_partitions, write_header_csv, write_partitioned)


def test_rebalance_layout_plans_a_rebalance_exchange(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("m"), "id")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        _layout(df, ["m"], colocate=False, rebalance=True).explain()
    assert "REBALANCE_PARTITIONS_BY_COL" in buf.getvalue()


def test_string_partition_values_keep_their_text_with_a_pinned_schema(spark, tmp_dir):
    df = spark.createDataFrame([("01", 1), ("10", 2)], "s string, v int")
    path = write_partitioned(df, f"{tmp_dir}/t", ["s"], colocate=True)
    inferred = spark.read.parquet(path)
    assert dict(inferred.dtypes)["s"] == "int"          # what plain partition discovery does
    pinned = read_partitioned(spark, path, columns=df.columns, schema=df.schema)
    assert pinned.columns == ["s", "v"]
    assert sorted(map(tuple, pinned.collect())) == [("01", 1), ("10", 2)]


def test_default_mode_fails_and_refresh_replaces_only_present_partitions(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "m int, v string")
    path = write_partitioned(df, f"{tmp_dir}/r", ["m"])
    with pytest.raises(AnalysisException):
        write_partitioned(df, path, ["m"])
    refresh_partitions(spark.createDataFrame([(2, "B")], "m int, v string"), path, ["m"])
    assert sorted(map(tuple, spark.read.parquet(path).select("m", "v").collect())) == [(1, "a"), (2, "B")]


def test_csv_round_trip_is_all_strings_and_names_lower_case(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2.5, "x")], "A int, B double, C string")
    back = read_header_csv(spark, write_header_csv(df, f"{tmp_dir}/c"))
    assert back.dtypes == [("A", "string"), ("B", "string"), ("C", "string")]
    assert lowercase_names(back).columns == ["a", "b", "c"]
