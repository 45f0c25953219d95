"""The corpus pipeline: stages applied to ``documents`` one after another.

1. toxicity: documents that the factorization machine rejects go.
2. line dedup: of a line found in at least ten documents only the first
   occurrence stays; a document that loses all its lines stays, empty.
3. near-dedup: of each group of near copies (word 5-shingles, similarity 0.8 or
   more) the document with the smallest doc_id stays.
4. PII: the spans found become placeholders.
5. packing: each document's length bucket, batch and place in it.

Every stage but the last returns the columns of its input.  An empty table
passes every stage.  Extra columns pass the first four, also those named like
a column that an operator adds.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from daybook.llm import line_dedup, near_dedup, packing, pii, toxicity  # noqa: E402
from daybook.llm.common import table  # noqa: E402
from daybook.session import remove_dir, run_dir  # noqa: E402


def _beside(docs: DataFrame, added: tuple[str, ...], operator: Callable[[DataFrame], DataFrame],
            **changed) -> DataFrame:
    """The operator's rows with the columns of ``docs``; its own columns
    ``added`` may be named like one of them."""
    aside = {c: f"_own_{c}" for c in docs.columns if c in added}
    out = operator(docs.withColumnsRenamed(aside))
    for name, value in changed.items():
        if name in docs.columns:
            out = out.withColumn(name, value.cast(docs.schema[name].dataType))
    return out.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return _beside(docs, ("score", "predicted"), lambda d: toxicity.score_documents(d, machine).where("predicted = 0"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _beside(docs, ("n_lines", "n_dropped"), lambda d: line_dedup.drop_repeated_lines(d, min_docs=10, keep="first"),
                   n_chars=F.char_length("text"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs, size=5, percent=80).select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pii.learn(docs)
    return _beside(docs, ("base_spans", "spans", "redacted"),
                   lambda d: pii.find(d, model).withColumn("text", F.col("redacted")), n_chars=F.char_length("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("pii", redact),
    ("packing", pack),
]

#: The stages learn models, which SQL cannot; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the
    shared folder and read again, and the folder before it is removed."""
    docs, folder = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = run_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        if folder:
            remove_dir(spark, folder)
        docs, folder = spark.read.parquet(out), out
    return docs
