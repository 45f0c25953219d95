"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (exact_dedup, fingerprints, importance_resampling, line_dedup, lm_scoring, near_dedup, packing,
                         periodic_runs, pii, sentencepiece_codec, sharding, token_counts, toxicity)
from daybook.llm.common import fold_crc, table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it again."""
    pieces = sentencepiece_codec.Pieces.load(sentencepiece_codec.MODEL)
    found = sentencepiece_codec.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces)
    return found.select("doc_id", "ids", F.size("ids").alias("n_ids"), "round_trip")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.learn(docs))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in pii.KINDS],
                        F.sha2(listed("base_spans").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"), size=4, percent=80)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, machine).select(
        "doc_id", (fold_crc("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_and_next(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM documents, range(1, length(string_split(coalesce(text, ''), chr(10))) + 1) AS r(i)),
k AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY doc_id
"""


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, first(doc_id ORDER BY len DESC, doc_id) AS keep_id
  FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_codec.Pieces.load(sentencepiece_codec.MODEL)
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces, limit=4096).drop("text")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = importance_resampling.resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                            table(spark, sf_dir, "benchmark"), percent=25, least_words=20)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def planted(documents: list[list[bytes]], ids: list) -> list[list[bytes]]:
    """The words with the repeats that the query's contract plants by doc_id;
    a null id plants none."""
    out = []
    for words, doc_id in zip(documents, ids):
        h, n = crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        out.append(words)
    return out


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect(table(spark, sf_dir, "documents").select("doc_id", "text"), before=planted, digests=True)
    return found.select("doc_id", "n_runs", "start", "length", "period",
                        F.floor(1000 * F.col("length") / F.col("period")).cast("long").alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_pii": op2_pii,
    "op3_near_dedup": op3_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_fingerprints": op6_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op8_sharding": op8_sharding,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op7_line_dedup": OP7_SQL,
    "op10_exact_dedup": OP10_SQL,
}
