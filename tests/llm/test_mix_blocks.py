"""Repeated rows: blocks stay of bounded size, totals near their targets, reruns with other partitions alike."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from starloom.llm import source_mix
from starloom.llm.registry import QUERIES


def test_blocks_of_repeated_rows(spark):
    keys = spark.range(30_000).select(F.col("id").alias("row"), F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).cast("long").alias("key"),
                                      F.lit(0).alias("sid"), F.lit(5).cast("long").alias("size"), F.lit(0.5).alias("p"),
                                      F.lit(30_000).cast("long").alias("n")).repartition(16)
    keys = keys.drop("row").withColumn("row", F.monotonically_increasing_id()).checkpoint()
    chunks = source_mix.spread(keys).select("row", "key", "sid", "size", "p", "n", "chunk")
    assert chunks.count() == 30_000
    per_chunk = Counter(r["chunk"] for r in chunks.filter("key = 7").collect())
    assert max(per_chunk.values()) == source_mix.COPIES and len(per_chunk) == -(-10_000 // source_mix.COPIES)
    for turn in (0, 1):
        sizes = [r["count"] for r in source_mix.in_blocks(chunks, turn).groupBy("sid", "block").count().collect()]
        assert max(sizes) < 4 * source_mix.GROUP


def test_a_third_of_equal_rows(spark, tmp_path):
    n = 3000
    ids = [1] * n + list(range(10, 10 + 2 * n))
    texts = ["five words are in this"] * n + [" ".join(["w"] * (i % 40 + 1)) for i in range(2 * n)]
    source = ["a", "b", "c"] * n
    found = []
    for name, rows in (("one", 10**6), ("many", 500)):
        (tmp_path / name).mkdir()
        pq.write_table(pa.table({"doc_id": ids, "text": texts, "source": source, "lang": ["en"] * 3 * n}), tmp_path / name / "documents.parquet",
                       row_group_size=rows)
        found.append([tuple(r) for r in QUERIES["op6_source_mix"](spark, str(tmp_path / name)).collect()])
    assert Counter(found[0]) == Counter(found[1])
    taken, target, most = Counter(), {}, 0
    for _, size, _, t, x in found[0]:
        taken[t] += x
        most = max(most, size)
    for t, x in taken.items():
        assert abs(t - x) <= 2 * most
