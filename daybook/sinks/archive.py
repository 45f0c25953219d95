"""Daily line archive: every parsed event as one text line under ``dt=<day>``.

The day is the arrival day (as the reference files lines by the day they are
processed).  Lines are rebalanced by day before the write: under adaptive
execution a large day is split over many tasks and files, small ones are
merged, so a backfill over many days does not leave a file per task and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.codec import encode_line
from daybook.schema import ARCHIVE_LEGACY_SUFFIX
from daybook.sinks.daily import write_batch


def archive_lines(flat: DataFrame, arrival: str = "ingest_ts", clean: bool = True,
                  legacy_suffix: bool = False) -> DataFrame:
    """``dt, value``.  ``legacy_suffix`` adds the ``", "`` the reference's
    key/value text writer leaves after each line."""
    line = encode_line(flat, clean=clean)
    if legacy_suffix:
        line = F.concat(line, F.lit(ARCHIVE_LEGACY_SUFFIX))
    return flat.select(F.to_date(arrival).alias("dt"), line.alias("value"))


def write_archive(lines: DataFrame, path: str, run: str, batch_id: int = 0, codec: str | None = None) -> None:
    """Lines of one batch under ``dt, run, batch_id``; a rerun replaces them.
    ``codec`` (``gzip``, ``bzip2``, ...) compresses the files; they read alike."""
    write_batch(lines.hint("rebalance", "dt"), path, run, batch_id, ["dt"], "text", codec)


def start_archive_stream(lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, codec: str | None = None):
    """Append streaming ``dt, value`` rows with the file sink: days are folders,
    and its log of finished batches in ``path``, which :func:`read_archive`
    follows, leaves out what a batch that failed has written."""
    w = (lines.writeStream.format("text").partitionBy("dt").outputMode("append").queryName("archive")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.option("compression", codec) if codec else w
    return (w.trigger(**trigger) if trigger else w).start()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``value, dt``; a filter on ``dt`` prunes partitions."""
    return spark.read.text(path).select("value", F.col("dt").cast("date").alias("dt"))


def write_legacy_lines(records: DataFrame, path: str, run: str, batch_id: int = 0, day=None) -> None:
    """Good legacy lines of all three labels as text under ``dt, run, batch_id``.

    ``records`` come from :func:`daybook.operators.legacy.legacy_records`;
    ``day`` is a column or a date, today by default.  Writing the same run and
    batch again replaces its lines of that day.
    """
    d = F.current_date() if day is None else F.lit(day).cast("date")
    write_batch(records.where(F.col("status") == "ok").select(F.col("line").alias("value"), d.alias("dt")),
                path, run, batch_id, ["dt"], "text")
