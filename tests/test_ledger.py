"""Deliveries out of order, repeated and changed, over several runs of the refresh."""

import pytest

from starloom.plans.star import build_star
from starloom.streaming.refresh import run_monthly_refresh

from .test_star_e2e import FACT_SCHEMA, fact_row, make_inputs


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("star"))
    return {k: v for k, v in build_star(spark, make_inputs(spark, d), f"{d}/out").items() if k != "I94s"}


class Job:
    def __init__(self, spark, dims, base, older="ignore"):
        self.spark, self.dims, self.base, self.older = spark, dims, str(base), older

    def deliver(self, name, rows, parts=1):
        (self.spark.createDataFrame([fact_row(c, 2016, m, 101, "AL") for c, m in rows], FACT_SCHEMA).repartition(parts)
         .write.mode("append").parquet(f"{self.base}/incoming/delivery={name}"))

    def run(self, checkpoint="ckpt"):
        run_monthly_refresh(self.spark, f"{self.base}/incoming", FACT_SCHEMA, self.dims, f"{self.base}/fact", f"{self.base}/{checkpoint}",
                            ledger_path=f"{self.base}/ledger", older=self.older)
        return self.fact()

    def fact(self):
        return sorted((r["i94mon"], r["cicid"]) for r in self.spark.read.parquet(f"{self.base}/fact").collect())

    def ledger(self):
        return sorted((r["ledger_month"], r["delivery"], r["status"]) for r in self.spark.read.parquet(f"{self.base}/ledger").collect())


def test_older_delivery_in_a_later_run(spark, dims, tmp_path):
    job = Job(spark, dims, tmp_path)
    job.deliver(9, [(1, 4), (2, 4)])
    assert job.run() == [(4, 1), (4, 2)]
    job.deliver(1, [(3, 4), (4, 5)])  # older: its April is ignored, its May is the first
    assert job.run() == [(4, 1), (4, 2), (5, 4)]
    job.deliver(10, [(5, 4)])  # later by number, earlier as text
    assert job.run() == [(4, 5), (5, 4)]
    assert job.ledger() == [(4, "1", "ignored"), (4, "10", "applied"), (4, "9", "applied"), (5, "1", "applied")]


def test_repeated_batches_change_nothing(spark, dims, tmp_path):
    job = Job(spark, dims, tmp_path)
    job.deliver(1, [(1, 4), (2, 4), (3, 5)], parts=3)
    first = job.run()
    ledger = job.ledger()
    assert job.run() == first and job.ledger() == ledger  # nothing new
    assert job.run("lost") == first and job.ledger() == ledger  # all files again, from an empty checkpoint
    job.deliver(2, [(7, 5)])
    assert job.run("lost again") == [(4, 1), (4, 2), (5, 7)]
    assert job.run("and again") == [(4, 1), (4, 2), (5, 7)]
    assert [x for x in job.ledger() if x[2] == "applied"] == [(4, "1", "applied"), (5, "1", "applied"), (5, "2", "applied")]


def test_applied_delivery_with_other_files(spark, dims, tmp_path):
    """A file that comes late must not pass for the whole month."""
    job = Job(spark, dims, tmp_path)
    job.deliver(1, [(1, 4), (2, 4)])
    first = job.run()
    job.deliver(1, [(3, 4)])
    with pytest.raises(Exception, match="other files"):
        job.run()
    assert job.fact() == first


def test_refusing_older(spark, dims, tmp_path):
    job = Job(spark, dims, tmp_path, older="refuse")
    job.deliver("2016-05", [(1, 4)])
    first = job.run()
    job.deliver("2016-04", [(2, 4), (3, 5)])
    with pytest.raises(Exception, match="older"):
        job.run()
    assert job.fact() == first and job.ledger() == [(4, "2016-05", "applied")]


def test_refusing_older_with_a_lost_checkpoint(spark, dims, tmp_path):
    """Deliveries that were applied in their order are no older ones when all files are found again."""
    job = Job(spark, dims, tmp_path, older="refuse")
    for name in (1, 2):
        job.deliver(name, [(name, 4)])
        job.run()
    assert job.run("lost") == [(4, 2)]


def test_died_before_the_ledger(spark, dims, tmp_path, monkeypatch):
    """The fact was written, the ledger was not: the next run writes the same rows again."""
    from starloom.streaming import ledger
    job = Job(spark, dims, tmp_path)
    job.deliver(3, [(1, 4), (2, 4)])
    with monkeypatch.context() as m:
        m.setattr(ledger.DeliveryLedger, "note", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            job.run()
    assert job.fact() == [(4, 1), (4, 2)]
    assert job.run() == [(4, 1), (4, 2)] and job.ledger() == [(4, "3", "applied")]
