import pytest

from starloom.operators.reshape import pivot_sum, unpivot_then_pivot, unpivot_years


def test_unpivot_keeps_nulls_and_casts(spark):
    wide = spark.createDataFrame(
        [("France", "FRA", "Stab", "S1", "0.5", ".."), ("Chad", "TCD", "Stab", "S1", None, "1.25"),
         ("Chad", "TCD", "Stab", "S1", None, "1.25")],
        "`Country Name` string, `Country Code` string, `Series Name` string, `Series Code` string, "
        "`1996` string, `1998` string")
    w = wide.drop("series Name", "Series Code")
    out = unpivot_years(w, ["Country Name", "Country Code"], value_col="pss",
                        id_aliases=["country_name", "country_code"])
    assert out.columns == ["country_name", "country_code", "pss", "year"]
    rows = sorted(map(tuple, out.collect()), key=str)
    # 2 distinct countries x 2 year columns, NULL measures kept, duplicate row removed
    assert rows == sorted([("France", "FRA", 0.5, 1996), ("France", "FRA", None, 1998),
                           ("Chad", "TCD", None, 1996), ("Chad", "TCD", 1.25, 1998)], key=str)
    assert dict(out.dtypes) == {"country_name": "string", "country_code": "string", "pss": "float", "year": "int"}


def test_unpivot_without_dedup_counts_rows_times_columns(spark):
    wide = spark.createDataFrame([("a", "1", "2", "3")] * 3, "k string, `2000` string, `2001` string, `2002` string")
    assert unpivot_years(wide, ["k"], dedup=False).count() == 9


def test_pivot_sum_adds_duplicates_ignores_unlisted_and_null(spark):
    df = spark.createDataFrame(
        [("x", 1, "A", 1.0), ("x", 1, "A", 2.0), ("x", 1, "B", 5.0), ("x", 1, None, 7.0), ("x", 1, "Z", 9.0)],
        "k string, y int, s string, v double")
    out = pivot_sum(df, ["k", "y"], "s", "v", {"A": "a", "B": "b"})
    assert out.columns == ["k", "y", "a", "b"]
    assert tuple(out.first()) == ("x", 1, 3.0, 5.0)


def test_unpivot_then_pivot(spark):
    wide = spark.createDataFrame(
        [("Chad", "TCD", "adv", "1", ".."), ("Chad", "TCD", "tot", "3", "4"), ("Chad", "TCD", "tot", "1", None)],
        "`Country Name` string, `Country Code` string, `Series Name` string, `2000` string, `2001` string")
    out = unpivot_then_pivot(wide, ["Country Name", "Country Code"], "Series Name", {"adv": "uwae", "tot": "ut"},
                             id_aliases=["country_name", "country_code"])
    assert out.columns == ["country_name", "country_code", "year", "uwae", "ut"]
    rows = sorted(map(tuple, out.collect()))
    assert rows == [("Chad", "TCD", 2000, 1.0, 4.0), ("Chad", "TCD", 2001, None, 4.0)]


def test_series_must_fit_their_mapping(spark):
    df = spark.createDataFrame([("Chad", "Unemployment, total", "1"), ("Chad", None, "2")], "name string, series string, `2016` string")
    out = unpivot_then_pivot(df, ["name"], "series", {"Unemployment, total": "ut"})
    assert [tuple(r) for r in out.select("name", "year", "ut").collect()] == [("Chad", 2016, 1.0)]
    for wrong in ({"Unemployment total": "ut"}, {"Unemployment, total": "ut", "absent": "x"}, {}):
        with pytest.raises(ValueError):
            unpivot_then_pivot(df, ["name"], "series", wrong)
