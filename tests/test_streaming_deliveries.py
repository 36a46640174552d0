import os

import pytest

from starloom.plans.star import build_star
from starloom.streaming.refresh import run_monthly_refresh

from .test_star_e2e import FACT_SCHEMA, fact_row, make_inputs


def test_delivery_of_several_files(spark, tmp_path):
    """All files of a delivery folder count; files beside each other without a folder are refused, not dropped."""
    d = str(tmp_path)
    star = build_star(spark, make_inputs(spark, d), f"{d}/out")
    dims = {k: v for k, v in star.items() if k != "I94s"}
    april = spark.createDataFrame([fact_row(i, 2016, 4, 101, "AL") for i in range(1, 5)], FACT_SCHEMA).repartition(3)
    april.write.parquet(f"{d}/folders/delivery=1")
    run_monthly_refresh(spark, f"{d}/folders", FACT_SCHEMA, dims, f"{d}/fact1", f"{d}/ckpt1")
    assert sorted(r["cicid"] for r in spark.read.parquet(f"{d}/fact1").collect()) == [1, 2, 3, 4]

    april.write.parquet(f"{d}/loose")
    with pytest.raises(Exception, match="delivery folder"):
        run_monthly_refresh(spark, f"{d}/loose", FACT_SCHEMA, dims, f"{d}/fact2", f"{d}/ckpt2")
    assert not os.path.exists(f"{d}/fact2")

    # single files, one of each month
    for month in (4, 5):
        spark.createDataFrame([fact_row(month, 2016, month, 101, "AL")], FACT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{d}/single")
    run_monthly_refresh(spark, f"{d}/single", FACT_SCHEMA, dims, f"{d}/fact3", f"{d}/ckpt3")
    assert sorted(r["cicid"] for r in spark.read.parquet(f"{d}/fact3").collect()) == [4, 5]
