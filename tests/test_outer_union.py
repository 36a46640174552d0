"""The outer chain as one grouping, hot keys of shuffled lookups, and the pivot into a map."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import fk_lookup, hot_keys, outer_chain, outer_union, split_lookup, union_distinct_keys
from starloom.operators.reshape import map_columns, pivot_map, pivot_sum


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _both(parts, measures):
    keys = union_distinct_keys([f.toDF(*["n", "y", *f.columns[2:]]) for f, _ in parts], ["n", "y"], ["u_n", "u_y"])
    return (_rows(outer_union(parts, ["u_n", "u_y"], measures)),
            _rows(outer_chain(keys, ["u_n", "u_y"], parts, measures, "full")))


@pytest.mark.parametrize("repeats", [False, True])
def test_outer_union_equals_the_joins(spark, repeats):
    rng = random.Random(4)
    names, years = ["a", "b", "c", None], [1, 2, None]

    def part(measures, schema):
        keys = [(n, y) for n in names for y in years if rng.random() < 0.7]
        if repeats:
            keys += rng.choices(keys, k=6)
        return spark.createDataFrame([(*k, *(rng.choice([None, 1.5, 2.5]) for _ in range(measures))) for k in keys], schema)

    parts = [(part(1, "n string, y int, p double"), ["n", "y"]),
             (part(2, "`the name` string, y2 int, q double, r double"), ["the name", "y2"]),
             (part(1, "n string, y int, s double"), ["n", "y"])]
    got, want = _both(parts, ["p", "q", "r", "s"])
    assert got == want and len(got) > 8


def test_outer_union_of_empty_parts_and_one_shuffle(spark):
    a = spark.createDataFrame([], "n string, y int, p double")
    b = spark.createDataFrame([("x", 1, "t")], "n string, y int, q string")
    got, want = _both([(a, ["n", "y"]), (b, ["n", "y"])], ["p", "q"])
    assert got == want == [("x", 1, None, "t")]
    with pytest.raises(ValueError, match="two parts"):
        outer_union([(a, ["n", "y"]), (a, ["n", "y"])], ["n", "y"], ["p"])
    out = outer_union([(a, ["n", "y"]), (b, ["n", "y"])], ["k1", "k2"], ["p", "q"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan  # what is left reads the grouping; joins only where a key repeats


def _hot_fact(spark, n=60_000):
    """A third of the rows has one address, a third none, the others have 5,000; all rows differ."""
    i = F.col("id")
    return spark.range(n).select(
        i.alias("cicid"), F.lit(2016).alias("yr"),
        F.when(i % 3 == 0, F.lit("HOT")).when(i % 3 == 1, F.concat(F.lit("A"), (F.xxhash64(i) % 2500).cast("string"))).alias("addr"))


def test_hot_keys_are_found(spark):
    (hot, parts), = hot_keys(_hot_fact(spark), [["yr", "addr"]], splits=64)
    want = spark.range(1).select(F.xxhash64(F.lit(2016), F.lit("HOT"))).first()[0]
    assert hot == [want] and 20 <= parts <= 23


def test_split_lookup_is_balanced_and_equals_a_broadcast(spark):
    fact = _hot_fact(spark)
    dim = fact.filter("addr is not null").select(F.col("yr").alias("year"), F.col("addr").alias("code")).distinct()
    dim = dim.filter("code <> 'A7'").withColumn("id_s", F.xxhash64("code"))
    d = [{"df": dim, "on": {"yr": "year", "addr": "code"}, "id": "id_s"}]
    split = fk_lookup(fact, d, max_broadcast_rows=-1, splits=64)
    assert _rows(split) == _rows(fk_lookup(fact, d))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.shuffle.partitions")}
    try:
        for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1"),
                     ("spark.sql.shuffle.partitions", "16")):
            spark.conf.set(k, v)
        rows = [r["count"] for r in fk_lookup(fact, d, max_broadcast_rows=-1, splits=64)
                .groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    # without the split, one task would hold a third of all rows, and one the rows without an address
    assert len(rows) == 16 and max(rows) < 2.5 * sum(rows) / len(rows)


def test_split_lookup_keeps_copies_and_repeated_side_rows(spark):
    fact = spark.createDataFrame([(1, "h")] * 5 + [(2, None), (2, None), (3, "x")], "a int, k string")
    side = spark.createDataFrame([("h", 10), ("h", 11), (None, 12)], "s string, id int")
    h = spark.range(1).select(F.xxhash64(F.lit("h"))).first()[0]
    out = split_lookup(fact, side, ["k"], ["s"], [h], 4).drop("s")
    assert _rows(out) == _rows(fact.join(side, fact["k"] == side["s"], "left").drop("s"))


def test_pivot_map_keeps_every_series(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["s1", "s2", "s 3", None]), rng.choice([None, 1, 2])) for _ in range(300)]
    rows += [("c", "lone", None)]
    df = spark.createDataFrame(rows, "g string, `the series` string, v int")
    want = collections.defaultdict(dict)
    for g, s, v in rows:
        old = want[g].get(s)
        want[g][s] = old if v is None else (old or 0) + v
    got = {r["g"]: {**r["series"], **({None: r["no_series"]} if None in want[r["g"]] else {})}
           for r in pivot_map(df, ["g"], "the series", "v").collect()}
    assert got == dict(want)
    cols = map_columns(pivot_map(df, ["g"], "the series", "v"), {"s1": "one", "nowhere": "none"})
    for r in cols.collect():
        assert r["one"] == want[r["g"]].get("s1") and r["none"] is None and set(r["series"]) == set(want[r["g"]]) - {"s1", None}
    listed = pivot_sum(df, ["g"], "the series", "v", ["s1", "s2"])
    assert {r["g"]: r["s1"] for r in listed.collect()} == {r["g"]: r["one"] for r in cols.collect()}
    with pytest.raises(ValueError, match="not mapped"):
        pivot_sum(df, ["g"], "the series", "v", ["s1", "s2"], strict=True)


def test_pivot_map_with_very_many_series(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), (F.col("id") % 100_000).cast("string").alias("s"), F.lit(1).alias("v"))
    r = pivot_map(df, ["g"], "s", "v").select(F.size("series").alias("n"), F.expr("series['77']").alias("v")).first()
    assert (r["n"], r["v"]) == (100_000, 2)
    assert pivot_map(df.limit(0), ["g"], "s", "v").count() == 0
