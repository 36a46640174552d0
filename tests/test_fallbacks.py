"""Size bounds of broadcasts and writes; the paths beyond a bound give the same rows."""

from pyspark.sql import functions as F

from starloom.operators.aggregates import share_of_total
from starloom.operators.joins import bounded_broadcasts, fk_lookup, label_join, side_size
from starloom.sources.files import write_partitioned


def test_fk_lookup_without_broadcast(spark):
    fact = spark.range(0, 5000).select((F.col("id") % 12 + 1).cast("int").alias("mon"),
                                       (F.col("id") % 7).cast("string").alias("addr"), "id")
    dim = spark.range(0, 60).select(((F.col("id") % 12) + 1).cast("int").alias("month"),
                                    (F.col("id") % 5).cast("string").alias("state_code"),
                                    (F.col("id") + 1).cast("int").alias("id_s")).dropDuplicates(["month", "state_code"])
    spec = [{"df": dim, "on": {"mon": "month", "addr": "state_code"}, "id": "id_s"}]
    a = fk_lookup(fact, spec)
    b = fk_lookup(fact, spec, max_broadcast_rows=0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert b.count() == 5000


def test_share_of_total_without_broadcast(spark):
    df = spark.range(0, 3000).select((F.col("id") % 9).alias("g"), (F.col("id") % 17).cast("int").alias("v"))
    a = share_of_total(df, ["g"], "v", "s")
    b = share_of_total(df, ["g"], "v", "s", max_broadcast_rows=0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_label_join_without_broadcast(spark):
    df = spark.range(0, 1000).select((F.col("id") % 40).cast("string").alias("name"), "id")
    lab = spark.range(0, 30).select(F.col("id").cast("string").alias("name"), (F.col("id") * 10).cast("string").alias("code"))
    a = label_join(df, lab, "name", "name", "code", how="left", cast_code="int")
    b = label_join(df, lab, "name", "name", "code", how="left", cast_code="int", max_broadcast_rows=0)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert "broadcast" not in b._jdf.queryExecution().analyzed().toString().lower()


def _broadcasts(df):
    return df._jdf.queryExecution().analyzed().toString().lower().count("strategy=broadcast")


def test_broadcast_is_bounded_by_bytes_of_all_sides_together(spark):
    wide = spark.range(0, 100).select("id", F.repeat(F.lit("x"), 1000).alias("v"))  # about 100 kB
    n, size = side_size(wide)
    assert n == 100 and 100_000 <= size <= 120_000
    one, two, three = bounded_broadcasts([wide, wide, wide.select("id")], max_bytes=150_000)
    facts = spark.range(0, 10)
    assert [_broadcasts(facts.join(s, "id")) for s in (one, two, three)] == [1, 0, 1]
    assert side_size(spark.range(0)) == (0, 0)


def test_a_month_with_all_rows_is_written_by_several_tasks(spark, tmp_dir):
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    old = {k: spark.conf.get(k) for k in keys}
    rows = spark.range(0, 200_000, 1, 8).select(F.lit(2016).alias("i94yr"), F.lit(4).alias("i94mon"),
                                                F.sha2(F.col("id").cast("string"), 256).alias("v"))
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        path = write_partitioned(rows, tmp_dir + "/fact", ["i94yr", "i94mon"], rebalance=True)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sizes = [r["n"] for r in spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 200_000 and len(sizes) >= 4 and max(sizes) <= 100_000
