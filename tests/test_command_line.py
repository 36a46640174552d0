"""The two commands, on files: build with its checks, refresh with ledger and stable ids."""

import pytest

from starloom import __main__ as cli
from starloom.plans.star import ID_COLUMNS, WriteReport, store_star
from starloom.sources.files import write_partitioned
from pyspark.sql import functions as F

from .test_star_e2e import FACT_SCHEMA, SERIES, STATE, fact_row, make_inputs, write


def arguments(d):
    import json
    names = {"political-stability": "pss", "unemployment-country": "unemp", "population": "pop", "unemployment-us-state": "state",
             "temperature": "temp"}
    return [x for n, f in names.items() for x in (f"--{n}", f"{d}/{f}.csv")] + [
        "--labels", f"{d}/labels.sas", "--series", json.dumps(SERIES), "--out", f"{d}/out"]


def test_build_then_refresh(spark, tmp_path, capsys):
    d = str(tmp_path)
    make_inputs(spark, d)
    layout = ["--partitions", '{"temperature_us_state": ["state_name"]}']
    assert cli.main([*arguments(d), "--fact", f"{d}/i94.parquet", *layout]) == 0
    out = capsys.readouterr().out
    assert "I94s n_rows 4 None" in out and "temperature_country max_id" in out
    assert (tmp_path / "out/temperature_us_state.parquet/state_name=alabama").is_dir()
    old = {n: {r[i] for r in spark.read.parquet(f"{d}/out/{n}.parquet").collect()} for n, i in ID_COLUMNS.items()}

    spark.createDataFrame([fact_row(9, 2015, 1, 101, "AK")], FACT_SCHEMA).write.parquet(f"{d}/in/delivery=2")
    write(f"{d}/state.csv", STATE + "2015,January,Alaska,Z,9.5\n")
    assert cli.main(["refresh", *arguments(d), *layout, "--deliveries", f"{d}/in"]) == 0
    row = spark.read.parquet(f"{d}/out/I94s.parquet").filter("i94yr = 2015").first()
    assert row["cicid"] == 9 and row["id_economics_us_state"] == max(old["economics_us_state"]) + 1
    assert spark.read.parquet(f"{d}/out/I94s.parquet").count() == 5
    assert (tmp_path / "out/temperature_us_state.parquet/state_name=alabama").is_dir()

    spark.createDataFrame([fact_row(8, 2015, 1, 101, "AK")], FACT_SCHEMA).write.parquet(f"{d}/in/delivery=1")
    assert cli.main(["refresh", "--out", f"{d}/out", "--deliveries", f"{d}/in"]) == 0  # older, and no dimension sources
    assert [r["cicid"] for r in spark.read.parquet(f"{d}/out/I94s.parquet").filter("i94yr = 2015").collect()] == [9]


def test_arguments(tmp_path):
    with pytest.raises(SystemExit):
        cli.parse_args(["--out", "x"])
    with pytest.raises(SystemExit):
        cli.parse_args(["refresh", "--out", "x", "--deliveries", "y", "--labels", "only one source"])
    assert not cli.parse_args(["refresh", "--out", "x", "--deliveries", "y"]).dimensions


def test_failing_check_is_reported(spark, tmp_path, monkeypatch, capsys):
    d = str(tmp_path)
    make_inputs(spark, d)
    from starloom.plans import star
    number = star.add_surrogate_key
    monkeypatch.setattr(star, "add_surrogate_key", lambda df, order, i, **k: number(df, order, i, **k).withColumn(i, F.col(i) * 2))
    assert cli.main([*arguments(d), "--fact", f"{d}/i94.parquet"]) == 1
    assert "failed: ('economics_country', 'max_id'" in capsys.readouterr().err


def test_measured_without_a_further_scan(spark, tmp_path):
    """The metrics are part of the write's own plan."""
    df = spark.range(1000).select((F.col("id") % 7).alias("part"), F.col("id").alias("v"))
    seen: dict = {}
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            counter.add(b.num_rows)
            yield b

    write_partitioned(df.mapInArrow(count, df.schema), str(tmp_path / "t"), ["part"], observe={"n": F.count(F.lit(1)), "top": F.max("v")}, observed=seen)
    assert seen == {"n": 1000, "top": 999} and counter.value == 1000
    watched = df.observe("checks", F.count(F.lit(1)).alias("n"))
    assert "CollectMetrics" in watched._jdf.queryExecution().executedPlan().toString()


def test_layout_of_the_fact_is_fixed(spark, tmp_path):
    with pytest.raises(ValueError):
        store_star(spark, {}, spark.range(1), str(tmp_path), partitions={"I94s": ["i94yr"]})
    assert WriteReport().failures() == []
