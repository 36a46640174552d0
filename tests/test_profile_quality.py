from starloom.operators.profile import drop_sparse_columns, profile_columns, profile_examples, sparse_columns
from starloom.operators.quality import natural_key_duplicates, pk_check, star_coverage


def _df(spark):
    return spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, "a", "x"), (3, None, "x"), (None, None, "x")],
                                 "a int, b string, c string")


def test_profile_columns(spark):
    got = {r["column_name"]: tuple(r)[1:] for r in profile_columns(_df(spark)).collect()}
    assert got["a"] == (5, 1, 0.2, 3)
    assert got["b"] == (5, 4, 0.8, 1)
    assert got["c"] == (5, 0, 0.0, 1)


def test_profile_examples_first_k_null_first(spark):
    got = [(r["column_name"], r["rank"], r["value"]) for r in profile_examples(_df(spark), k=2).collect()]
    assert sorted(got, key=str) == sorted([("a", 1, None), ("a", 2, "1"), ("b", 1, None), ("b", 2, "a"),
                                           ("c", 1, "x")], key=str)


def test_sparse_columns_and_drop(spark):
    got = {r["column_name"]: (r["too_sparse"], r["single_valued"]) for r in sparse_columns(profile_columns(_df(spark))).collect()}
    assert got == {"b": (True, True), "c": (False, True)}
    assert drop_sparse_columns(_df(spark)).columns == ["a"]


def test_pk_check_detects_duplicates(spark):
    ok = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    bad = spark.createDataFrame([(1,), (3,), (3,)], "id int")
    assert pk_check(ok, "id").first()["is_dense"] is True
    r = pk_check(bad, "id").first()
    assert r["max_equals_count"] is True and r["is_dense"] is False


def test_natural_key_duplicates(spark):
    dim = spark.createDataFrame([(2000, "a"), (2000, "a"), (2001, "a")], "year int, name string")
    assert [tuple(r) for r in natural_key_duplicates(dim, ["year", "name"]).collect()] == [(2000, "a", 2)]


def test_star_coverage(spark):
    fact = spark.createDataFrame([(1, 1), (2, None), (None, 1)], "id_a int, id_b int")
    da = spark.createDataFrame([(1,), (2,)], "id_a int")
    db = spark.createDataFrame([(1,)], "id_b int")
    got = {r["check_name"]: (r["n_fact"], r["n_matched"]) for r in star_coverage(fact, {"a": (da, "id_a"), "b": (db, "id_b")}).collect()}
    assert got == {"a": (3, 2), "b": (3, 2), "_all": (3, 1)}


def test_profile_columns_approx_close_to_exact(spark):
    from pyspark.sql import functions as F
    df = spark.range(0, 20000).select((F.col("id") % 997).alias("a"),
                                      F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 31).alias("b"))
    exact = {r["column_name"]: r for r in profile_columns(df).collect()}
    approx = {r["column_name"]: r for r in profile_columns(df, approx=True).collect()}
    for c in ("a", "b"):
        assert approx[c]["n_rows"] == exact[c]["n_rows"] and approx[c]["n_null"] == exact[c]["n_null"]
        assert abs(approx[c]["n_distinct"] - exact[c]["n_distinct"]) <= 0.08 * exact[c]["n_distinct"]
