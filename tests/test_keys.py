import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.keys import add_surrogate_key


def _brute(df, order):
    w = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("id", F.row_number().over(w))


def test_matches_global_row_number_with_ties_and_nulls(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, 2001, 2002, 2003]), rnd.choice(["a", "b", None, "c"]), rnd.randint(1, 12),
             rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "year int, name string, month int, v double")
    got = add_surrogate_key(df, ["year", "name", "month"], "id", num_ranges=5)
    exp = _brute(df, ["year", "name", "month", "v"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[-1]) == sorted(map(tuple, exp.collect()),
                                                                           key=lambda r: r[-1])
    ids = [r["id"] for r in got.select("id").collect()]
    assert sorted(ids) == list(range(1, 3001))
    assert dict(got.dtypes)["id"] == "int"


def test_deterministic_between_runs(spark):
    df = spark.range(0, 2000).select((F.col("id") % 37).alias("k"), F.col("id").alias("v"))
    a = {tuple(r) for r in add_surrogate_key(df, ["k"], "id", num_ranges=4).collect()}
    b = {tuple(r) for r in add_surrogate_key(df, ["k"], "id", num_ranges=3).collect()}
    assert a == b


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int")
    assert add_surrogate_key(df, ["k"], "id").count() == 0


def test_many_exact_copies_are_split_across_ranges(spark):
    # a third of the rows are copies of one row: they must not all sit in one range
    hot = spark.range(0, 3000).select(F.lit(7).alias("k"), F.lit("x").alias("v"))
    rest = spark.range(0, 6000).select((F.col("id") % 50).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    df = hot.unionByName(rest)
    got = add_surrogate_key(df, ["k"], "id", num_ranges=6)
    assert sorted(r["id"] for r in got.collect()) == list(range(1, 9001))
    exp = _brute(df, ["k", "v"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_plan_does_not_grow_with_the_ranges(spark):
    from starloom.operators.keys import add_surrogate_key
    df = spark.range(3000).selectExpr("id * 7 % 3001 AS v")
    size = []
    for n in (4, 200):
        out = add_surrogate_key(df, ["v"], "k", num_ranges=n)
        size.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
        rows = sorted((r["v"], r["k"]) for r in out.collect())
        assert [k for _, k in rows] == list(range(1, 3001))
    assert abs(size[0] - size[1]) < 200
