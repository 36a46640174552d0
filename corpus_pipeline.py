"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark leaks, source mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared folder and
reads it back as the next stage's documents.  All stages but the last return the columns of ``documents``, whatever
further columns there are; the last adds what the mix takes.

Null texts, empty texts and repeated rows: the quality rules reject documents of fewer than ten words, so
none of the former is left after the first stage, and of repeated rows the second stage leaves one.  Rows without a doc_id
pass the second and third stage unchanged.  Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema

from starloom.llm import decontaminate, jaccard_join, quality_rules, source_mix, substring_dedup
from starloom.llm._tables import scratch_table, table
from starloom.llm._tokens import Words

#: Words that a passage must have to be cut from all documents but the first.
PASSAGE = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table rejects go."""
    return docs.filter(quality_rules.keep_condition("text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: 5-word shingles, similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, k=5, num=4, den=5)


def _cut(schema: pa.Schema):
    def finish(part: pa.Table, words: Words, removed: np.ndarray) -> pa.RecordBatch:
        texts = substring_dedup.kept_raw(words, removed, part.column("text"))
        gone = np.concatenate(([0], np.cumsum(removed)))
        gone = gone[words.first[1:]] - gone[words.first[:-1]]
        changed = gone > 0
        cols = []
        for f in schema:
            c = part.column(f.name).combine_chunks()
            if f.name == "text":
                c = pa.array(texts, pa.string())
            elif f.name == "n_chars":  # follows the text where that changed
                old = c.to_pylist()
                c = pa.array([len(t) if x else o for t, x, o in zip(texts, changed, old)], f.type)
            cols.append(c.cast(f.type))
        out = pa.RecordBatch.from_arrays(cols, names=schema.names)
        return out.filter(pa.array((words.count == 0) | (gone < words.count)))  # nothing left: the document goes
    return finish


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` words or more that an earlier document has are cut out."""
    slim = docs.withColumn("doc_id", docs["doc_id"].cast("long"))
    schema = to_arrow_schema(slim.schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema)
    carry = [c for c in docs.columns if c not in ("doc_id", "text")]
    return substring_dedup.dedup(slim, _cut(schema), ddl, carry=carry, width=PASSAGE)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with words taken (repeats counted) and the source's target."""
    out = source_mix.mix(docs, keep=docs.columns)
    names = [*docs.columns, "mix_words", "mix_source_words", "mix_target", "mix_taken"]
    return out.toDF(*names).filter("mix_taken > 0")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", passages),
    ("benchmark decontamination", benchmark),
    ("source mix", mix),
]

#: The cube method and the model thresholds are not SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
