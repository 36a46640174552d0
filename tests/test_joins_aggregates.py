from pyspark.sql import functions as F

from starloom.operators.aggregates import drop_null_any, drop_null_subset, share_of_total
from starloom.operators.joins import bounded_broadcast, fk_lookup, label_join, outer_chain, union_distinct_keys


def test_outer_chain_full_keeps_null_key_rows(spark):
    a = spark.createDataFrame([("x", 1, 1.0), (None, 1, 9.0)], "name string, year int, m1 double")
    b = spark.createDataFrame([("x", 2, 2.0)], "name string, year int, m2 double")
    keys = union_distinct_keys([a, b], ["name", "year"], ["u_name", "u_year"])
    full = outer_chain(keys, ["u_name", "u_year"], [(a, ["name", "year"]), (b, ["name", "year"])], ["m1", "m2"])
    rows = sorted(map(tuple, full.collect()), key=str)
    # the NULL-key row of `a` matches nothing and survives with NULL keys (full outer)
    assert (None, None, 9.0, None) in rows
    assert ("x", 1, 1.0, None) in rows and ("x", 2, None, 2.0) in rows
    left = outer_chain(keys, ["u_name", "u_year"], [(a, ["name", "year"]), (b, ["name", "year"])], ["m1", "m2"],
                       how="left")
    assert (None, None, 9.0, None) not in [tuple(r) for r in left.collect()]


def test_label_join_left_inner_and_int_code(spark):
    df = spark.createDataFrame([("chad",), ("mars",)], "country_name string")
    lab = spark.createDataFrame([("101", "chad"), ("X1", "mars")], "country_code string, country_name string")
    left = label_join(df, lab, "country_name", "country_name", "country_code", how="left", cast_code="int")
    assert sorted(map(tuple, left.collect())) == [("chad", 101), ("mars", None)]
    inner = label_join(df, lab, "country_name", "country_name", "country_code", how="inner")
    assert inner.count() == 2


def test_bounded_broadcast_only_below_bound(spark):
    small = spark.range(10)
    big = spark.range(100)
    j1 = spark.range(1000).join(bounded_broadcast(small, 50), "id")
    j2 = spark.range(1000).join(bounded_broadcast(big, 50), "id")
    assert "broadcast" in j1._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in j2._jdf.queryExecution().analyzed().toString().lower()


def test_fk_lookup_brings_ids_null_when_absent(spark):
    fact = spark.createDataFrame([(2016, 4, "AL"), (2016, 4, None), (2016, 5, "AL")], "yr int, mon int, addr string")
    dim = spark.createDataFrame([(2016, 4, "AL", 7)], "year int, month int, state_code string, id_s int")
    out = fk_lookup(fact, [{"df": dim, "on": {"yr": "year", "mon": "month", "addr": "state_code"}, "id": "id_s"}])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(2016, 4, "AL", 7), (2016, 4, None, None), (2016, 5, "AL", None)], key=str)


def test_share_of_total_counts_duplicates_and_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 2000, 1), ("a", 2000, 1), ("b", 2000, 2), ("c", 2001, 0), ("d", None, 5)],
                               "name string, year int, count int")
    out = {(r["name"], r["year"], r["count"]): r["powp"] for r in share_of_total(df, ["year"], "count", "powp").collect()}
    assert out[("a", 2000, 1)] == 25.0 and out[("b", 2000, 2)] == 50.0
    assert out[("c", 2001, 0)] is None
    assert out[("d", None, 5)] == 100.0


def test_drop_nulls_treat_nan_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0), (None, 2.0)], "a int, b double")
    assert sorted(r["a"] for r in drop_null_any(df).collect()) == [2]
    assert drop_null_subset(df, ["a", "a"]).count() == 2
    assert drop_null_any(df).count() == df.na.drop(how="any").count()


def test_shares_sum_to_100_per_group(spark):
    df = spark.range(0, 500).select((F.col("id") % 7).alias("g"), (F.col("id") % 13 + 1).cast("int").alias("v"))
    out = share_of_total(df, ["g"], "v", "share")
    for r in out.groupBy("g").agg(F.sum("share").alias("s")).collect():
        assert abs(r["s"] - 100.0) < 1e-9


def test_fk_lookup_rejects_repeated_natural_keys(spark):
    import pytest
    fact = spark.createDataFrame([(1,)], "k int")
    dim = spark.createDataFrame([(1, 10), (1, 11)], "k2 int, id int")
    with pytest.raises(ValueError):
        fk_lookup(fact, [{"df": dim, "on": {"k": "k2"}, "id": "id"}], check_natural_keys=True)


def test_normalize_keys_merges_case_variants(spark):
    from starloom.plans.dims import economics_country_no_labels
    pss = spark.createDataFrame([("Chad", "TCD", 1.0, 2016)], "country_name string, country_code string, pss float, year int")
    un = spark.createDataFrame([("CHAD", "TCD", 2016, 1.0, 2.0, 3.0, 4.0)],
                               "country_name string, country_code string, year int, uwae double, uwbe double, uwie double, ut double")
    pop = spark.createDataFrame([("chad", 2016, 5, 100.0)], "country_name string, year int, count int, powp double")
    assert economics_country_no_labels(pss, un, pop, materialize=False).count() == 3
    merged = economics_country_no_labels(pss, un, pop, materialize=False, normalize_keys=True)
    assert [tuple(r) for r in merged.collect()] == [("chad", 2016, 1.0, 1.0, 2.0, 3.0, 4.0, 100.0)]
