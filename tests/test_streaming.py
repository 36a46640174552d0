import pytest

from starloom.plans.fact import FACT_COLUMNS
from starloom.plans.star import build_star
from starloom.streaming.refresh import run_monthly_refresh

from .test_star_e2e import FACT_SCHEMA, fact_row, make_inputs


def test_stream_processes_each_delivery_once(spark, tmp_path):
    d = str(tmp_path)
    inp = make_inputs(spark, d)
    star = build_star(spark, inp, f"{d}/out")
    dims = {k: v for k, v in star.items() if k != "I94s"}
    incoming, fact_path, ckpt = f"{d}/incoming", f"{d}/stream_fact", f"{d}/ckpt"

    spark.createDataFrame([fact_row(1, 2016, 4, 101, "AL"), fact_row(2, 2016, 4, 111, "AK")],
                          FACT_SCHEMA).write.parquet(f"{incoming}/delivery=0")
    run_monthly_refresh(spark, incoming, FACT_SCHEMA, dims, fact_path, ckpt)
    first = sorted((r["cicid"], r["i94mon"], r["id_temperature_us_state"])
                   for r in spark.read.parquet(fact_path).collect())
    assert first == [(1, 4, 1), (2, 4, 2)]

    # second delivery: a new month only; April stays as written by the first batch
    spark.createDataFrame([fact_row(9, 2016, 5, 101, "AL")], FACT_SCHEMA).write.parquet(f"{incoming}/delivery=1")
    run_monthly_refresh(spark, incoming, FACT_SCHEMA, dims, fact_path, ckpt)
    out = spark.read.parquet(fact_path)
    assert sorted((r["cicid"], r["i94mon"]) for r in out.collect()) == [(1, 4), (2, 4), (9, 5)]
    assert set(FACT_COLUMNS) <= set(out.columns)


def test_redelivered_month_in_one_run_or_two(spark, tmp_path):
    """Two deliveries of one month: the later replaces the earlier, whenever the job runs, without duplicates."""
    d = str(tmp_path)
    star = build_star(spark, make_inputs(spark, d), f"{d}/out")
    dims = {k: v for k, v in star.items() if k != "I94s"}
    first = spark.createDataFrame([fact_row(1, 2016, 4, 101, "AL"), fact_row(2, 2016, 4, 111, "AK")], FACT_SCHEMA)
    second = spark.createDataFrame([fact_row(1, 2016, 4, 101, "AL"), fact_row(3, 2016, 4, 111, "AK")], FACT_SCHEMA)
    found = []
    for runs in ("one", "two"):
        base = f"{d}/{runs}"
        first.write.parquet(f"{base}/incoming/delivery=0")
        if runs == "two":
            run_monthly_refresh(spark, f"{base}/incoming", FACT_SCHEMA, dims, f"{base}/fact", f"{base}/ckpt")
        second.write.parquet(f"{base}/incoming/delivery=1")
        run_monthly_refresh(spark, f"{base}/incoming", FACT_SCHEMA, dims, f"{base}/fact", f"{base}/ckpt")
        out = spark.read.parquet(f"{base}/fact")
        assert "delivery" not in out.columns
        found.append(sorted(r["cicid"] for r in out.collect()))
    assert found == [[1, 3], [1, 3]]


def test_timeout_raises(spark, tmp_path):
    d = str(tmp_path)
    star = build_star(spark, make_inputs(spark, d), f"{d}/out")
    dims = {k: v for k, v in star.items() if k != "I94s"}
    spark.createDataFrame([fact_row(1, 2016, 4, 101, "AL")], FACT_SCHEMA).write.parquet(f"{d}/incoming/delivery=0")
    with pytest.raises(TimeoutError):
        run_monthly_refresh(spark, f"{d}/incoming", FACT_SCHEMA, dims, f"{d}/fact", f"{d}/ckpt", timeout_sec=0.01)
    assert not [q for q in spark.streams.active if q.isActive]
