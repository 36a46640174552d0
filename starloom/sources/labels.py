"""Code -> label sections of a SAS-style label text file, parsed as a distributed Spark job.

A section looks like::

    /* comment */
    value i94cntyl
        236 = 'AFGHANISTAN'
        ...
    ;

Parsing rules (kept exactly):
1. all tab characters are deleted first;
2. the section starts at the first occurrence of its name anywhere in the text;
3. it stops at the first ``;`` after that point;
4. the remainder of the line holding the name is skipped;
5. single quotes are deleted;
6. only lines that split on ``=`` into exactly two parts are kept;
7. both parts are stripped of surrounding whitespace;
8. for a repeated code the last line wins.
A missing section, or a section without a closing ``;``, raises ``ValueError``.

The file is read line by line (``spark.read.text``), so it is split across tasks like any
other text source.  Line order is kept as (file name, position in file).  Positions depend on how
files are cut into tasks, so the numbered lines are checkpointed once: all sections, and the
bounds and the body of a section, are found in the same numbering, and the text is read once.
Only two one-row aggregates (start and end of the section) reach the driver.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..session import ensure_checkpoint_dir


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a label file (or folder of part files) as (f, p, line), tabs already removed.

    The numbering is fixed here (checkpoint in the shared folder); later settings cannot move it.
    """
    ensure_checkpoint_dir(spark)
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("f"),
                    F.monotonically_increasing_id().alias("p"),
                    F.translate(F.col("value"), "\t", "").alias("line"))
            .checkpoint(eager=True))


def _order() -> "F.Column":
    return F.struct(F.col("f"), F.col("p"))


def parse_label_section(lines: DataFrame, section: str) -> DataFrame:
    """Parse one section into (code STRING, label STRING), one row per code."""
    name_at = F.instr(F.col("line"), section)
    tail = F.substring(F.col("line"), name_at, F.length(F.col("line")))
    start = (lines.filter(name_at > 0)
             .agg(F.min(F.struct(F.col("f"), F.col("p"), F.instr(tail, ";").alias("semi"))).alias("s"))
             .first()["s"])
    if start is None:
        raise ValueError(f"label section {section!r} not found")
    f0, p0 = start["f"], start["p"]
    after_start = (F.col("f") > f0) | ((F.col("f") == f0) & (F.col("p") > p0))
    empty = lines.filter(F.lit(False)).select(F.lit("").alias("code"), F.lit("").alias("label"))
    if start["semi"] > 0:
        # the section closes on its own first line, which is skipped: nothing remains
        return empty
    end = (lines.filter(after_start & (F.instr(F.col("line"), ";") > 0))
           .agg(F.min(_order()).alias("e")).first()["e"])
    if end is None:
        raise ValueError(f"label section {section!r} has no closing ';'")
    f1, p1 = end["f"], end["p"]
    before_end = (F.col("f") < f1) | ((F.col("f") == f1) & (F.col("p") < p1))
    at_end = (F.col("f") == f1) & (F.col("p") == p1)
    body = (lines.filter(after_start & (before_end | at_end))
            .select(_order().alias("o"),
                    F.when(at_end, F.substring_index(F.col("line"), ";", 1)).otherwise(F.col("line")).alias("line")))
    parts = F.split(F.translate(F.col("line"), "'", ""), "=", -1)
    pairs = (body.select("o", parts.alias("kv"))
             .filter(F.size("kv") == 2)
             .select("o", strip_ws(F.col("kv")[0]).alias("code"), strip_ws(F.col("kv")[1]).alias("label")))
    return pairs.groupBy("code").agg(F.max_by(F.col("label"), F.col("o")).alias("label"))


def label_table(lines: DataFrame, section: str, code_col: str, name_col: str) -> DataFrame:
    """A label dimension (code, lower-cased name) from one section."""
    return parse_label_section(lines, section).select(
        F.col("code").alias(code_col), F.lower(F.col("label")).alias(name_col))


def write_label_file(sections: Mapping[str, DataFrame], path: str, comment: str = "labels",
                     num_files: int | None = None) -> str:
    """Write code/label DataFrames (columns ``code``, ``label``, optional ``seq``) as one SAS-style text.

    Lines are globally ordered by (section, line kind, code, seq) with a range repartition, so
    the part files, read in name order, form one text in that order.  ``seq`` orders several
    lines of one code (for example a stale line before its replacement).
    """
    frames = []
    for i, (name, df) in enumerate(sections.items()):
        spark = df.sparkSession
        seq = F.col("seq").cast("int") if "seq" in df.columns else F.lit(0)

        def fixed(kind: int, text: str):
            return spark.range(1).select(F.lit(i).alias("s"), F.lit(kind).alias("k"), F.lit("").alias("c"),
                                         F.lit(0).alias("q"), F.lit(text).alias("line"))
        frames.append(fixed(0, f"/* {name.upper()} - {comment} */"))
        frames.append(fixed(1, f"value {name}"))
        frames.append(df.select(F.lit(i).alias("s"), F.lit(2).alias("k"), F.col("code").cast("string").alias("c"),
                                seq.alias("q"),
                                F.format_string("\t%s\t=\t'%s'", F.col("code").cast("string"),
                                                F.col("label")).alias("line")))
        frames.append(fixed(3, ";"))
    lines = frames[0]
    for fr in frames[1:]:
        lines = lines.unionByName(fr)
    keys = [F.col("s"), F.col("k"), F.col("c"), F.col("q")]
    if num_files:
        lines = lines.repartitionByRange(num_files, *keys)
    else:
        lines = lines.repartitionByRange(*keys)
    lines.sortWithinPartitions(*keys).select("line").write.text(path)
    return path


def label_sections(lines: DataFrame, sections: Iterable[str]) -> dict[str, DataFrame]:
    return {s: parse_label_section(lines, s) for s in sections}
