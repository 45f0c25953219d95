"""Event text files: one JSON document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_wire_text(spark: SparkSession, path: str) -> DataFrame:
    """``value, ingest_ts``: each line, with its file's modification time as
    the arrival time."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_modification_time").alias("ingest_ts"))


def stream_wire_text(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming form of :func:`read_wire_text` (new files in ``path``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("ingest_ts"))


def write_wire_text(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.select("value").write.mode(mode).text(path)
