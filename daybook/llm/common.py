"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import shared_dir

#: The white space of every contract here: space and \t \n \v \f \r.
WS = " \t\n\x0b\x0c\r"
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words between white space; an empty array where there is none."""
    trimmed = F.btrim(text, F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+", -1))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once per row, however often it is used."""
    return F.transform(F.array(value), body)[0]


def fold_crc(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % mod


def give_back() -> None:
    """Hand freed memory back to the system, after a step that needed much: the
    Python worker that ran it lives on beside the executor's heap."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def small_batches(batch: pa.RecordBatch, chars: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Slices of about ``chars`` bytes of text, one row at least, to bound a task's memory."""
    at = 0
    while at < batch.num_rows:
        end, seen = at, 0
        while end < batch.num_rows and (end == at or seen < chars):
            seen += len(batch.column("text")[end].as_buffer() or b"") if batch.column("text")[end].is_valid else 0
            end += 1
        yield batch.slice(at, end - at)
        at = end


@contextmanager
def shuffles_once(spark: SparkSession):
    """The shuffle files of each job inside go when it ends, instead of when
    the driver next happens to collect its garbage.  For jobs whose results are
    kept or collected, not computed again."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the cluster's shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def join_salted(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner", salts: int = 16) -> DataFrame:
    """Join ``rows``, of which one key may have a large share, to ``few``,
    which has one row per key: each key's rows meet in ``salts`` tasks."""
    left = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, groups: list[str], cell: Column, order: list[Column],
             into: str) -> DataFrame:
    """Gapless numbers from 0 within ``groups``, without one task per group.

    Rows are ordered by ``cell`` (a small int of bounded range, spread over
    each group) and by ``order`` within a cell.  Only the counts of the cells
    meet in a window; the rows are sorted cell by cell.
    """
    from pyspark.sql import Window as W

    keyed = df.withColumn("_cell", cell)
    counts = keyed.groupBy(*groups, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_base", F.coalesce(F.sum("_n").over(
        W.partitionBy(*groups).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(W.partitionBy(*groups, "_cell").orderBy(*order)) - 1
    return (keyed.withColumn("_row", local)
            .join(before.drop("_n"), [*groups, "_cell"])
            .withColumn(into, (F.col("_base") + F.col("_row")).cast("long"))
            .drop("_cell", "_row", "_base"))
