"""Sketches, bounded examples and type inference against plain Python."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.operators import infer, profile, sketches


def test_merged_sketches_stay_within_the_error(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(120_000).select((F.col("id") % 12).cast("int").alias("month"), (F.col("id") % 50_000).alias("many"),
                                     F.when(F.col("id") % 3 > 0, (F.col("id") % 7).cast("string")).alias("few"),
                                     F.lit(None).cast("double").alias("none"), (F.col("id") % 1000 / 8).alias("real"))
    sketches.store_summaries(df, path, ["month"])
    sketches.store_summaries(df.filter("month = 3"), path, ["month"])  # a month that comes again replaces its summary
    for months in (range(12), [3], [0, 11], []):
        part = df.filter(F.col("month").isin(list(months))) if months else df.limit(0)
        got = {r["column_name"]: r for r in sketches.profile_from_summaries(
            sketches.read_summaries(spark, path).filter(F.col("month").isin(list(months)) if months else F.lit(False))).collect()}
        if not months:
            assert got == {}
            continue
        for c in ("many", "few", "none", "real"):
            n, z, u = part.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.countDistinct(c)).first()
            assert (got[c]["n_rows"], got[c]["n_null"]) == (n, z)
            assert abs(got[c]["n_distinct"] - u) <= 4 * sketches.standard_error() * u


def test_firsts_of_arrow_batches():
    rnd = random.Random(2)
    for k in (0, 1, 3, 10):
        s, rows = profile._Firsts(k), []
        for _ in range(30):
            batch = [rnd.choice([None, "", "é", "z", "Z", "😀", "\uffff", str(rnd.randint(0, 400))]) for _ in range(rnd.randint(0, 40))]
            rows += batch
            s.add(pa.array(batch, pa.string()))
        assert s.values == sorted({x for x in rows if x is not None})[:k]
        assert (s.rows, s.nulls) == (len(rows), rows.count(None))


def test_examples_and_plan(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "b", "a", "ç"]), rnd.randint(0, 500), None) for _ in range(4000)]
    df = spark.createDataFrame(rows, "s string, n int, z string").repartition(7)
    got = {(r["column_name"], r["rank"]): r["value"] for r in profile.profile_examples(df, 4).collect()}
    want = {}
    for i, c in enumerate("snz"):
        values = {None if r[i] is None else str(r[i]) for r in rows}
        for rank, v in enumerate(sorted(values, key=lambda x: (x is not None, x or ""))[:4], 1):
            want[c, rank] = v
    assert got == want
    both = {r["column_name"]: r for r in profile.counts_and_examples(df, 4).collect()}
    assert both["z"]["examples"] == [None] and both["z"]["n_null"] == 4000 and both["n"]["n_rows"] == 4000
    # one exchange behind the scan of a stored table, of at most k values a task and column
    plan = profile.profile_examples(spark.range(10**6).select(F.col("id"), (F.col("id") % 9).alias("m")), 4)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("Exchange hashpartitioning") == 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert profile.profile_examples(df, 3).count() == 0
    assert infer.infer_types(df).select("column_name", "n_rows", "inferred_type").collect() == [("a", 0, "string"), ("b", 0, "string")]
    assert sketches.column_summaries(df, ["b"]).count() == 0


def brute_type(values):
    def has(v, t):
        if t == "boolean":
            return v.lower() in ("true", "false")
        if t in ("int", "bigint"):
            return re.fullmatch("[+-]?[0-9]+", v) is not None and -(1 << (31 if t == "int" else 63)) <= int(v) < 1 << (31 if t == "int" else 63)
        if t == "double":
            return re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", v) is not None
        import datetime
        try:
            day = datetime.date.fromisoformat(v[:10]) if re.match(r"\d{4}-\d\d-\d\d", v) else None
            rest = v[10:]
            if t == "timestamp" and rest:
                datetime.time.fromisoformat(rest[1:9])
                return day is not None and re.fullmatch(r"[ T]\d\d:\d\d:\d\d(\.\d+)?", rest) is not None
            return day is not None and rest == ""
        except ValueError:
            return False
    real = [v.strip(" ") for v in values if v is not None and v.strip(" ")]
    lost = {t: sum(not has(v, t) for v in real) for t in infer.TYPES}
    return (next((t for t in infer.TYPES if real and not lost[t]), "string"), len(real), lost)


POOL = ["1", "-7", " 12 ", "+3", "2147483647", "2147483648", "-9223372036854775809", "1.5", ".5", "5.", "1e3", "..", "N/A", "", "  ", None,
        "true", "FALSE", "2016-04-01", "2016-02-30", "2016-04-01 10:00:00", "2016-04-01T10:00:00.25", "1 2", "nan", "1d", "0x1F", "١"]


@pytest.mark.parametrize("seed", [1, 2])
def test_infer_types(spark, seed):
    rnd = random.Random(seed)
    pools = [rnd.sample(POOL, rnd.randint(1, 4)) for _ in range(25)] + [["1", "2"], ["1", "2147483648"], ["1", ".5"], ["2016-04-01"],
             ["2016-04-01", "2016-04-01 10:00:00"], ["true", None], [None], [" "]]
    rows = [tuple(rnd.choice(p) for p in pools) for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(pools))))
    got = {r["column_name"]: r for r in infer.infer_types(df).collect()}
    for i in range(len(pools)):
        t, n, lost = brute_type([r[i] for r in rows])
        assert (got[f"c{i}"]["inferred_type"], got[f"c{i}"]["n_values"]) == (t, n), pools[i]
        assert {x: got[f"c{i}"][f"n_lost_{x}"] for x in infer.TYPES} == lost, pools[i]
    typed = infer.cast_inferred(df, infer.infer_types(df))
    assert {f.name: f.dataType.simpleString() for f in typed.schema} == {c: r["inferred_type"] for c, r in got.items()}
    assert typed.select(*[F.count(F.col(c)) for c in typed.columns if got[c]["inferred_type"] != "string"]).first() is not None
