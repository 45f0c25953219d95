"""The run a micro-batch belongs to: one per checkpoint folder."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json

from pyspark.sql import SparkSession


@dataclasses.dataclass(frozen=True)
class StreamRun:
    """``id`` is the query id kept in the checkpoint, ``started`` when the
    checkpoint was made; both survive restarts and differ between checkpoints."""
    id: str
    started: dt.datetime | None


def run_of(spark: SparkSession, checkpoint: str) -> StreamRun:
    """The run of a checkpoint whose query has started."""
    path = f"{checkpoint}/metadata"
    text = "".join(r["value"] for r in spark.read.text(path).collect())  # one short JSON line
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = fs.getFileStatus(hpath).getModificationTime() / 1000
    return StreamRun(json.loads(text)["id"], dt.datetime.fromtimestamp(made, dt.timezone.utc))
