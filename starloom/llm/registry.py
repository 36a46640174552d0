"""Registered queries of the subpackage and their DuckDB oracles."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path

from . import chat_format, decontaminate, hmm_lm, jaccard_join, license_scan, packing, quality_rules, source_mix, spelling, substring_dedup, toxicity, turn_repair, warc
from ._tables import store, table
from ._tokens import Words

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def _digests(part: pa.Table, w: Words, removed: np.ndarray) -> pa.RecordBatch:
    gone = np.add.reduceat(np.append(removed, 0), np.minimum(w.first[:-1], len(removed))) if part.num_rows else np.zeros(0)
    gone = np.where(w.count > 0, gone, 0).astype(np.int64)
    sha = [hashlib.sha256(x).hexdigest() for x in substring_dedup.kept_texts(w, removed)]
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id").combine_chunks(), pa.array(w.count.astype(np.int64)), pa.array(gone), pa.array(sha, pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept_sha256"])


@query("op1_substring_dedup", r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS g FROM
         (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least_doc AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM win JOIN least_doc USING (g) WHERE m < doc_id),
word AS (SELECT rid, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"), _digests,
                                 "doc_id long, n_words long, n_removed long, kept_sha256 string", width=13)


@query("op2_jaccard_join")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100).drop("text_hash")


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "scan.*")


def _crc(c: str = "doc_id"):
    return F.crc32(F.col(c).cast("string"))


@query("op4_hmm_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return hmm_lm.score(docs.withColumn("held_out", F.coalesce(_crc() % 10 == 0, F.lit(False))))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(*toxicity.sample(docs, labels, usable=_crc() % 3 != 1))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(_crc() % 3 == 1, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"))


@query("op6_source_mix")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])


_STOP = ", ".join(f"'{v}'" for x in dict.fromkeys(quality_rules.STOP_WORDS) for v in dict.fromkeys((x, x.capitalize())))


@query("op7_quality_rules", rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
wins AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
         FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT rid, g FROM wins GROUP BY rid, g HAVING count(*) > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM
         (SELECT rid, unnest(range(i, i + 5)) AS p FROM wins JOIN twice USING (rid, g)) GROUP BY rid),
m AS (SELECT doc_id, len(w) AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
        len(list_filter(w, lambda x: x IN ({_STOP}))) AS n_stop_words,
        length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_upper
      FROM d LEFT JOIN rep USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND n_symbols <= 0.25::DOUBLE * n_words AND word_chars <= 20 * n_words AND word_chars >= 2 * n_words
        AND n_dup_lines <= 0.5::DOUBLE * n_lines AND (n_words < 50 OR n_stop_words >= 0.02::DOUBLE * n_words)
        AND (n_words < 10 OR n_upper <= 0.4::DOUBLE * word_chars)) AS kept
FROM m""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality_rules.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return q.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                    "base_failed", "kept")


_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op8_decontaminate", rf"""
WITH b AS (SELECT row_number() OVER () AS bid, item_id, regexp_extract_all({_LOW}, {_ALNUM}) AS w FROM benchmark
           WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOW}, {_ALNUM}) AS w FROM documents),
bs AS (SELECT DISTINCT bid, item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM
        (SELECT bid, item_id, w, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM b WHERE len(w) > 0)),
ds AS (SELECT DISTINCT rid, doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM
        (SELECT rid, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bs) WHERE len(w) >= k)),
n AS (SELECT bid, count(*) AS n FROM bs GROUP BY bid)
SELECT doc_id, item_id, any_value(n.n)::BIGINT AS n_item_shingles, count(*)::BIGINT AS n_contained
FROM ds JOIN bs USING (k, g) JOIN n USING (bid) GROUP BY rid, doc_id, bid, item_id
HAVING 5 * count(*) >= 4 * any_value(n.n)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Fixed text of the additional conversation.
EXTRA = r"\### Assistant: </turn> ok"


@query("op9_chat_format", rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{EXTRA}' UNION ALL SELECT -7, 1, 'assistant', '{EXTRA}'),
e AS (SELECT *, 14 + length(role) + length(regexp_replace(role, '[^\\:#\n<]+', '', 'g'))
        + length(text) + length(regexp_replace(text, '[^\\]+', '', 'g'))
        + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0)
        + len(regexp_extract_all(text, '</turn>')) AS n FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars, false AS rewrites
FROM e GROUP BY conv_id""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit(EXTRA).alias("text")),
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit(EXTRA).alias("text")),
    )).alias("x")).select("x.*")
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(extra)))


@query("op10_warc", """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(coalesce(html, '')) >= 1000 AND page_id < m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(coalesce(html, '')) >= 1000 AND page_id < m THEN m END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS m FROM pages)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), _tokenizer())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op12_spelling")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = store(spelling.vocabulary(table(spark, sf_dir, "documents")), "vocabulary")
    return spelling.forms(words).select("word", "form", "root", "n", "n_near", "form_n")


@query("op13_turn_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damage(table(spark, sf_dir, "conversations")))
