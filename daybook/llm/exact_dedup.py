"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

Two texts are equal when they are identical after all white space is deleted.
Each normalised text is cut into chunks at places its own content chooses (the
first sentence mark after ``MIN_CHUNK`` characters, ``MAX_CHUNK`` at the
latest), and each chunk becomes the SHA-256 of its content.  The identifiers
are verified: chunk contents meet once per identifier, and an identifier found
with two contents is widened by the content itself.  A document is then only
its recipe, the ordered list of identifiers, which is what gets shuffled and
compared; the text itself does not move again.

Defined cases: null text counts as empty, and all texts without a visible
character form one group.  Among equal texts the row with the most code points
in the original text stays, then the smallest doc_id; a null doc_id comes
after all others.  Rows repeated under one doc_id are one document and share
its verdict.  Extra columns pass through ``exact_dedup``; a column that
clashes with a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import WS, cut, join_salted, whole_text

MIN_CHUNK, MAX_CHUNK = 256, 2048
CUTS = ".!?;。"


def normalised(text: Column) -> Column:
    return F.translate(text, WS, "")


def chunks(norm: Column) -> Column:
    """Content-defined pieces whose concatenation is ``norm``."""
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?[{CUTS}]|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(norm, F.lit(pattern), F.lit(0))


def sha256_id(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk.cast("binary"), 256))


def ambiguous(texts: DataFrame, chunk_id: Callable[[Column], Column]) -> list:
    """Identifiers that stand for more than one content; for SHA-256, none.

    The distinct chunks (deduplicated before the shuffle) meet by identifier.
    What is returned is a list of hash collisions, so empty in practice.
    """
    parts = texts.select(F.explode(chunks(F.col("_norm"))).alias("chunk"))
    distinct = parts.select(chunk_id(F.col("chunk")).alias("id"), "chunk").distinct()
    clash = distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return [r["id"] for r in clash.select("id").collect()]


def exact_dedup(docs: DataFrame, chunk_id: Callable[[Column], Column] = sha256_id) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256."""
    texts = docs.withColumn("_norm", normalised(whole_text()))
    clash = ambiguous(texts.select("_norm"), chunk_id)

    def verified(c: Column) -> Column:
        if not clash:
            return chunk_id(c)
        return F.when(chunk_id(c).isin(clash), F.concat(chunk_id(c), c.cast("binary"))).otherwise(chunk_id(c))

    rest = [c for c in docs.columns if c not in ("text", "keep_id", "group_size", "kept", "text_sha256")]
    rows = cut(texts.select(
        *rest, F.char_length(whole_text()).cast("long").alias("_len"),
        F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"),
        F.transform(chunks(F.col("_norm")), verified).alias("_recipe")))
    first = F.min(F.struct(-F.col("_len"), F.col("doc_id").isNull(), F.col("doc_id")))
    groups = rows.groupBy("_recipe").agg(first["doc_id"].alias("keep_id"),
                                         F.count(F.lit(1)).alias("group_size"))
    # a document alone in its group needs no partner
    return (join_salted(rows, groups.where("group_size > 1"), ["_recipe"], "left")
            .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
            .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long")))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .drop("_recipe", "_len"))
