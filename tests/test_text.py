from pyspark.sql import functions as F

from starloom.functions.text import code_map_lookup, month_name_to_int, strip_ws


def test_month_names(spark):
    vals = ["January", "january", "DECEMBER", "Jan", "sep", "Foo", None, "", "Mayx"]
    df = spark.createDataFrame([(v,) for v in vals], "m string")
    got = [r[0] for r in df.select(month_name_to_int("m")).collect()]
    assert got == [1, 1, 12, 1, 9, None, None, None, None]


def test_strip_ws(spark):
    df = spark.createDataFrame([("\t a b \r",), (" \n",), (None,)], "s string")
    assert [r[0] for r in df.select(strip_ws("s")).collect()] == ["a b", "", None]


def test_code_map_lookup(spark):
    df = spark.createDataFrame([("1",), ("3",), ("4",), (None,)], "c string")
    got = [r[0] for r in df.select(code_map_lookup(F.col("c"))).collect()]
    assert got == ["Business", "Student", None, None]


def test_strip_removes_what_python_strips(spark):
    from starloom.functions.text import strip_ws
    texts = [" AL ", "  x　y \x85", "\x1c\tAK\x0b", "plain", "", "   "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(strip_ws("t")).collect()] == [t.strip() for t in texts]
