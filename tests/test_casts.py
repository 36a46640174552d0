from pyspark.sql import functions as F

from starloom.functions.casts import cast_columns, lenient_float, lenient_int


def _one(spark, values, expr, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("x")).alias("y")).collect()]


def test_lenient_int_text(spark):
    vals = ["1.5", " 582 ", "..", "LAND", "", "99999999999", "-3", "+7", "00296", "1e3", None, "D/S", "12.", "\t4\r"]
    got = _one(spark, vals, lambda c: lenient_int(c))
    assert got == [1, 582, None, None, None, None, -3, 7, 296, None, None, None, 12, 4]


def test_lenient_bigint_keeps_large_identifiers(spark):
    assert _one(spark, ["99999999999"], lambda c: lenient_int(c, int_type="bigint")) == [99999999999]


def test_lenient_int_from_double_truncates_and_nulls(spark):
    vals = [1.5, -1.5, float("nan"), 9.5e10, None, 2147483647.0]
    got = _one(spark, vals, lambda c: lenient_int(c, from_text=False), "x double")
    assert got == [1, -1, None, None, None, 2147483647]


def test_lenient_float(spark):
    got = _one(spark, ["..", "1.5", " 2 ", None, "abc"], lambda c: lenient_float(c))
    assert got == [None, 1.5, 2.0, None, None]


def test_cast_columns_one_projection_by_source_type(spark):
    df = spark.createDataFrame([("1.7", 3.9, "x")], "a string, B double, c string")
    out = cast_columns(df, {"a": "int", "b": "int"})
    assert out.columns == ["a", "B", "c"]
    assert dict(out.dtypes) == {"a": "int", "B": "int", "c": "string"}
    assert tuple(out.first()) == (1, 3, "x")


def test_cluster_conf_sizes_partitions():
    from starloom.session import cluster_conf
    c = cluster_conf(100 * 2**40, 8000)   # 100 TB on 1000 executors x 8 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(10 * 2**20, 8)["spark.sql.shuffle.partitions"]) == 16
