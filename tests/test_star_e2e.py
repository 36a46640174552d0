"""End-to-end star build from small source files in the shapes the builder reads.

Every expected row below was computed by hand from the fixture text.
"""

import pytest
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from starloom.plans.star import StarInputs, build_star, refresh_fact_month
from starloom.sources.files import read_fact_source, read_header_csv
from starloom.sources.labels import read_label_lines

PSS = """Country Name,Country Code,Series Name,Series Code,2016,2017
Chad,TCD,Political Stability,PV.EST,-1.5,..
France,FRA,Political Stability,PV.EST,0.5,0.75
France,FRA,Political Stability,PV.EST,0.5,0.75
,,,,,
"""
UNEMP = """Country Name,Country Code,Series Name,Series Code,2016,2017
Chad,TCD,Unemployment with advanced education,SA,5,..
Chad,TCD,Unemployment with basic education,SB,6,7
Chad,TCD,"Unemployment, total",ST,10,11
Chad,TCD,"Unemployment, total",ST,1,1
France,FRA,Unemployment with intermediate education,SI,3,4
Chad,TCD,,SX,8,9
"""
SERIES = {"Unemployment with advanced education": "uwae", "Unemployment with basic education": "uwbe",
          "Unemployment with intermediate education": "uwie", "Unemployment, total": "ut"}
POP = """Country Name,Year,Count
Chad,2016,100
France,2016,300
France,2016,300
Chad,2017,50
France,2017,
Chad,2018,3000000000
France,2018,
"""
STATE = """Year,Month,State,County,Rate
2016,April,Alabama,A,4.0
2016,April,Alabama,B,5.0
2016,april,Alabama,C,6.0
2016,Foo,Alabama,D,1.0
2016,May,Alabama,E,N/A
2016,April,Atlantis,F,3.0
2016,April,Alaska,G,2.5
"""
TEMP = """Region,Country,State,City,Month,Day,Year,AvgTemperature
Africa,Chad,,Ndjamena,4,1,2016,30.5
Africa,Chad,,Ndjamena,4,2,2016,31.5
Europe,France,,Paris,4,1,2016,10
Europe,France,,Paris,4,2,2016,..
North America,US,Alabama,Mobile,4,1,2016,20
North America,US,Alabama,Mobile,4,2,2016,22
North America,US,Alaska,Juneau,4,1,2016,-3
North America,,Nowhere,X,4,1,2016,50
North America,us,Texas,Houston,4,1,2016,25
Africa,Chad,,Ndjamena,5,1,2016,..
"""
LABELS = """/* I94CIT & I94RES */
value i94cntyl
\t101\t=\t'CHAD'
   111 =  'FRANCE'
   999 =  'Invalid: Atlantis'
;
value i94prtl
   'MOB' = 'MOBILE, AL'
;
value i94model
   1 = 'Air'
;
value i94addrl
\t'AL'='ALABAMA'
\t'AK'='ALASKA'
;
"""
FACT_COLS = ["CICID", "I94YR", "I94MON", "I94CIT", "I94RES", "I94PORT", "ARRDATE", "I94MODE", "I94ADDR", "DEPDATE",
             "I94BIR", "I94VISA", "COUNT", "DTADFILE", "VISAPOST", "OCCUP", "ENTDEPA", "ENTDEPD", "ENTDEPU", "MATFLAG",
             "BIRYEAR", "DTADDTO", "GENDER", "INSNUM", "AIRLINE", "ADMNUM", "FLTNO", "VISATYPE"]
STRINGS = {"I94PORT", "I94ADDR", "DTADFILE", "VISAPOST", "OCCUP", "ENTDEPA", "ENTDEPD", "ENTDEPU", "MATFLAG",
           "DTADDTO", "GENDER", "INSNUM", "AIRLINE", "FLTNO", "VISATYPE"}
FACT_SCHEMA = T.StructType([T.StructField(c, T.StringType() if c in STRINGS else T.DoubleType()) for c in FACT_COLS])


def fact_row(cicid, yr, mon, res, addr, admnum=1.0e6, fltno="00123", dtaddto="10292016"):
    return (float(cicid), float(yr), float(mon), float(res), float(res), "MOB", 20575.0, 1.0, addr, 20580.0,
            30.0, 2.0, 1.0, "20160401", "SEO", None, "G", "O", None, "M", 1986.0, dtaddto, "F", None, "AA",
            admnum, fltno, "B2")


FACT_ROWS = [fact_row(1, 2016, 4, 101, "AL"), fact_row(2, 2016, 4, 111, "AK"), fact_row(3, 2016, 4, 999, None),
             fact_row(1, 2016, 4, 101, "AL"),
             fact_row(5, 2016, 5, 101, "AL", admnum=9.5e10, fltno="LAND", dtaddto="D/S")]


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def make_inputs(spark, d, fact_rows=FACT_ROWS, fact_name="i94.parquet"):
    files = {n: write(f"{d}/{n}.csv", t) for n, t in
             [("pss", PSS), ("unemp", UNEMP), ("pop", POP), ("state", STATE), ("temp", TEMP)]}
    write(f"{d}/labels.sas", LABELS)
    spark.createDataFrame(fact_rows, FACT_SCHEMA).write.mode("overwrite").parquet(f"{d}/{fact_name}")
    csv = {n: read_header_csv(spark, p) for n, p in files.items()}
    return StarInputs(political_stability=csv["pss"], unemployment_country=csv["unemp"], population=csv["pop"],
                      unemployment_us_state=csv["state"], temperature=csv["temp"],
                      fact_source=read_fact_source(spark, f"{d}/{fact_name}"),
                      label_lines=read_label_lines(spark, f"{d}/labels.sas"), series=SERIES)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("star"))
    inp = make_inputs(spark, d)
    return d, inp, build_star(spark, inp, f"{d}/out")


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_economics_country(star):
    _, _, s = star
    got = rows(s["economics_country"], ["id_economics_country", "country_name", "year", "pss", "uwae", "uwbe",
                                        "uwie", "ut", "powp", "country_code"])
    assert got == [
        (1, "chad", 2016, -1.5, 5.0, 6.0, None, 11.0, 100 / 700 * 100, 101),
        (2, "france", 2016, 0.5, None, None, 3.0, None, 300 / 700 * 100, 111),
        (3, "chad", 2017, None, None, 7.0, None, 12.0, 100.0, 101),
        (4, "france", 2017, 0.75, None, None, 4.0, None, None, 111),
        # 2018 only in the population file: the count above int range and the NULL count both
        # become NULL, the yearly total is NULL, so the share is NULL
        (5, "chad", 2018, None, None, None, None, None, None, 101),
        (6, "france", 2018, None, None, None, None, None, None, 111),
    ]
    assert s["economics_country"].columns == ["country_name", "year", "pss", "uwae", "uwbe", "uwie", "ut", "powp",
                                              "country_code", "id_economics_country"]


def test_economics_us_state(star):
    _, _, s = star
    assert rows(s["economics_us_state"], s["economics_us_state"].columns) == [
        (2016, 4, "alabama", 5.0, "AL", 1), (2016, 4, "alaska", 2.5, "AK", 2)]
    assert dict(s["economics_us_state"].dtypes)["month"] == "int"


def test_temperature_dims(star):
    _, _, s = star
    assert rows(s["temperature_country"], s["temperature_country"].columns) == [
        (2016, "chad", 4, 31.0, 30.5, 31.5, 101, 1), (2016, "france", 4, 10.0, 10.0, 10.0, 111, 2)]
    assert rows(s["temperature_us_state"], s["temperature_us_state"].columns) == [
        (2016, "alabama", 4, 21.0, 20.0, 22.0, "AL", 1), (2016, "alaska", 4, -3.0, -3.0, -3.0, "AK", 2)]


def test_fact(star):
    _, _, s = star
    f = s["I94s"]
    assert f.count() == 4  # exact duplicate removed
    got = rows(f, ["cicid", "i94mon", "id_temperature_us_state", "id_temperature_country", "id_economics_us_state",
                   "id_economics_country"])
    assert got == [(1, 4, 1, 1, 1, 1), (2, 4, 2, 2, 2, 2), (3, 4, None, None, None, None),
                   (5, 5, None, None, None, 1)]
    r5 = f.filter("cicid = 5").first()
    assert r5["admnum"] is None and r5["fltno"] is None and r5["dtaddto"] is None
    assert len(f.columns) == 27 and "count" not in f.columns


def test_sink_fails_when_present(spark, star):
    d, inp, _ = star
    with pytest.raises(AnalysisException):
        build_star(spark, inp, f"{d}/out")


def test_rebuild_gives_identical_ids(spark, star):
    d, inp, s = star
    again = build_star(spark, inp, f"{d}/out2")
    for name in ("economics_country", "economics_us_state", "temperature_country", "temperature_us_state", "I94s"):
        cols = s[name].columns
        assert rows(s[name], cols) == rows(again[name], cols)


def test_monthly_refresh_replaces_only_that_month(spark, tmp_path):
    d = str(tmp_path)
    inp = make_inputs(spark, d)
    built = build_star(spark, inp, f"{d}/out")
    may = make_inputs(spark, d, [fact_row(7, 2016, 5, 111, "AK")], fact_name="may.parquet")
    fact = refresh_fact_month(spark, may, f"{d}/out")
    got = sorted((r["cicid"], r["i94mon"]) for r in fact.collect())
    assert got == [(1, 4), (2, 4), (3, 4), (7, 5)]
    assert fact.dtypes == built["I94s"].dtypes


def test_series_discovered_positionally_when_not_given(spark, star):
    from starloom.plans.dims import discover_series, unemployment_long
    _, inp, _ = star
    assert discover_series(inp.unemployment_country) == SERIES
    a = unemployment_long(inp.unemployment_country)
    b = unemployment_long(inp.unemployment_country, SERIES)
    assert rows(a, a.columns) == rows(b, b.columns)


def test_command_line_build(spark, tmp_path):
    from starloom.__main__ import main
    d = str(tmp_path)
    make_inputs(spark, d)
    main(["--political-stability", f"{d}/pss.csv", "--unemployment-country", f"{d}/unemp.csv",
          "--population", f"{d}/pop.csv", "--unemployment-us-state", f"{d}/state.csv",
          "--temperature", f"{d}/temp.csv", "--labels", f"{d}/labels.sas", "--fact", f"{d}/i94.parquet",
          "--out", f"{d}/cli"])
    assert spark.read.parquet(f"{d}/cli/I94s.parquet").count() == 4
    assert spark.read.parquet(f"{d}/cli/economics_country.parquet").count() == 6


def test_star_quality(star):
    from starloom.plans.star import star_quality
    _, _, s = star
    q = star_quality(s)
    assert all(r["is_dense"] for r in q["ids"].collect())
    assert q["repeated_natural_keys"].count() == 0
    assert q["fact_rows"].first()["n_rows"] == 4
    cov = {r["check_name"]: r["n_matched"] for r in q["coverage"].collect()}
    assert cov["_all"] == 2 and cov["economics_country"] == 3
