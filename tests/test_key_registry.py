"""Ids that outlive a refresh: known natural keys keep theirs, new ones follow."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.key_registry import KeyRegistry, RepeatedNaturalKey, upsert
from starloom.operators.keys import add_surrogate_key
from starloom.plans.star import ID_COLUMNS, NATURAL_KEYS, build_star, refresh_dimensions, refresh_fact_month, registry_of
from starloom.sources.files import read_header_csv

from .test_star_e2e import FACT_SCHEMA, POP, PSS, STATE, TEMP, fact_row, make_inputs, write

SCHEMA = "year int, name string, v double"


def reference(batches):
    """The ids by a plain dictionary: known keys keep theirs, new ones in (year, name) order, NULLs first."""
    ids = {}
    for batch in batches:
        for key in sorted({(y, n) for y, n, _ in batch} - set(ids), key=lambda k: tuple((x is not None, x) for x in k)):
            ids[key] = len(ids) + 1
    return ids


def test_ids_over_many_refreshes(spark, tmp_path):
    rnd = random.Random(1)
    reg = KeyRegistry(spark, str(tmp_path / "keys"), ["year", "name"], "id")
    assert reg.read() is None
    pool = [(y, n) for y in (None, 2001, 2002, 2003) for n in (None, "a", "b", "ç")]
    batches = []
    for _ in range(4):
        batch = [(*k, rnd.random()) for k in rnd.sample(pool, rnd.randint(1, 12))]
        batches.append(batch)
        got = {(r["year"], r["name"]): (r["v"], r["id"]) for r in reg.assign(spark.createDataFrame(batch, SCHEMA), ["year", "name"]).collect()}
        ids = reference(batches)
        assert got == {(y, n): (v, ids[y, n]) for y, n, v in batch}
    assert sorted(r["id"] for r in reg.read().collect()) == list(range(1, len(ids) + 1))


def test_first_assignment_is_add_surrogate_key(spark, tmp_path):
    df = spark.createDataFrame([(y, n, float(y)) for y in (3, 1, 2) for n in "cab"], SCHEMA)
    reg = KeyRegistry(spark, str(tmp_path / "keys"), ["year", "name"], "id")
    assert sorted(map(tuple, reg.assign(df, ["year", "name"]).collect())) == sorted(map(tuple, add_surrogate_key(df, ["year", "name"], "id").collect()))


def test_empty_batch_and_interrupted_refresh(spark, tmp_path):
    reg = KeyRegistry(spark, str(tmp_path / "keys"), ["year", "name"], "id")
    empty = spark.createDataFrame([], SCHEMA)
    assert reg.assign(empty, ["year"]).count() == 0
    one = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.5)], SCHEMA)
    first = sorted(map(tuple, reg.assign(one, ["year"]).collect()))  # its rows are never stored: the refresh dies here
    assert sorted(map(tuple, reg.assign(one, ["year"]).collect())) == first
    assert reg.assign(empty, ["year"]).count() == 0 and reg.read().count() == 2
    # an append of which only a part was committed: ids go on after the largest
    spark.createDataFrame([(9, "z", 7)], "year int, name string, id int").write.mode("append").parquet(reg.path)
    more = spark.createDataFrame([(0, "new", 0.5), (9, "z", 0.5)], SCHEMA)
    assert sorted((r["name"], r["id"]) for r in reg.assign(more, ["year"]).collect()) == [("new", 8), ("z", 7)]


def test_repeated_natural_key_is_refused(spark, tmp_path):
    reg = KeyRegistry(spark, str(tmp_path / "keys"), ["year", "name"], "id")
    twice = spark.createDataFrame([(1, None, 0.1), (1, None, 0.2)], SCHEMA)
    with pytest.raises(RepeatedNaturalKey):
        reg.assign(twice, ["year"])
    with pytest.raises(RepeatedNaturalKey):
        reg.seed(twice.withColumn("id", F.lit(1)))
    assert reg.read() is None


def test_hot_key_part(spark, tmp_path):
    """Two thirds of the keys share a year; a third of the rows is new."""
    reg = KeyRegistry(spark, str(tmp_path / "keys"), ["year", "name"], "id")
    rows = lambda n: spark.range(n).select(F.when(F.col("id") % 3 < 2, 2000).otherwise(F.col("id")).cast("int").alias("year"),
                                           F.col("id").cast("string").alias("name"), F.lit(1.0).alias("v"))
    before = {r["name"]: r["id"] for r in reg.assign(rows(6000), ["year", "name"]).collect()}
    after = {r["name"]: r["id"] for r in reg.assign(rows(9000), ["year", "name"]).collect()}
    assert all(after[k] == v for k, v in before.items()) and sorted(after.values()) == list(range(1, 9001))


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1.0, 1), (2, None, 2.0, 2), (3, "c", 3.0, 3)], SCHEMA + ", id int")
    new = spark.createDataFrame([(2, None, 9.0, 2), (4, "d", 4.0, 4)], SCHEMA + ", id int")
    assert sorted(map(tuple, upsert(old, new, ["year", "name"]).collect())) == [(1, "a", 1.0, 1), (2, None, 9.0, 2), (3, "c", 3.0, 3), (4, "d", 4.0, 4)]


def test_star_refresh_keeps_facts_valid(spark, tmp_path):
    """An earlier month and a country that sorts first arrive; another vanishes: stored facts still join to their rows."""
    d = str(tmp_path)
    inp = make_inputs(spark, d)
    star = build_star(spark, inp, f"{d}/out")
    ids = {n: {tuple(r[k] for k in NATURAL_KEYS[n]): r[ID_COLUMNS[n]] for r in star[n].collect()} for n in ID_COLUMNS}
    facts = sorted(map(tuple, star["I94s"].collect()), key=repr)
    temp = TEMP.replace("Africa,Chad,,Ndjamena,4,1,2016,30.5\nAfrica,Chad,,Ndjamena,4,2,2016,31.5\n", "Africa,Chad,,Ndjamena,1,1,2015,1.5\n")
    inp.temperature = read_header_csv(spark, write(f"{d}/temp2.csv", temp.replace("Juneau,4,1,2016,-3", "Juneau,4,1,2016,-8")))
    inp.unemployment_us_state = read_header_csv(spark, write(f"{d}/state2.csv", STATE + "2015,January,Alaska,Z,9.5\n"))
    inp.population = read_header_csv(spark, write(f"{d}/pop2.csv", POP + "Chad,2001,5\n"))
    inp.political_stability = read_header_csv(spark, write(f"{d}/pss2.csv", PSS))
    dims = refresh_dimensions(spark, inp, f"{d}/out")
    for n, old in ids.items():
        now = {tuple(r[k] for k in NATURAL_KEYS[n]): r[ID_COLUMNS[n]] for r in dims[n].collect()}
        assert old.items() <= now.items()
        new = sorted(set(now.values()) - set(old.values()))
        assert new == list(range(len(old) + 1, len(now) + 1))
        assert registry_of(spark, f"{d}/out", n).read().count() == len(now)
    assert {(r["year"], r["month"]): r["temperature"] for r in dims["temperature_country"].filter("country_name = 'chad'").collect()} \
        == {(2016, 4): 31.0, (2015, 1): 1.5}
    assert dims["temperature_us_state"].filter("state_name = 'alaska'").first()["temperature"] == -8.0
    assert sorted(map(tuple, spark.read.schema(star["I94s"].schema).parquet(f"{d}/out/I94s.parquet").select(*star["I94s"].columns).collect()), key=repr) == facts
    inp.fact_source = spark.createDataFrame([fact_row(7, 2015, 1, 101, "AK")], FACT_SCHEMA).toDF(*[c.lower() for c in FACT_SCHEMA.fieldNames()])
    got = refresh_fact_month(spark, inp, f"{d}/out").filter("i94yr = 2015").first()
    assert got["id_temperature_country"] == len(ids["temperature_country"]) + 1
    assert got["id_economics_us_state"] == len(ids["economics_us_state"]) + 1
