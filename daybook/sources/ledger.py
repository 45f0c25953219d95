"""Offset ledger: the last processed offset of every Kafka partition.

``record`` appends, per batch and partition, the offset range the batch
covered (an empty batch writes nothing).  Rows carry the run (the checkpoint's
query) and when they were written.  ``current`` keeps, per module, group, topic
and partition, the last batch of the run that wrote last: a group that goes
back to an older checkpoint goes on from there, whatever another run wrote in
between.  Re-recording a batch changes nothing.

Ranges come from the rows of a batch (:meth:`OffsetLedger.record`) or from the
progress of the query (:meth:`OffsetLedger.record_progress`).  Only the latter
know where a range ends on a compacted or transactional topic, where the last
offsets may hold no row; its rows follow those of the same batch and win.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pyspark.sql.streaming import StreamingQueryListener

from daybook.session import delete_partition, list_partitions, path_exists
from daybook.streaming.run import StreamRun

LOG_SCHEMA = T.StructType([
    T.StructField("module", T.StringType()),
    T.StructField("group_id", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_started", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("from_offset", T.LongType()),
    T.StructField("until_offset", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
    T.StructField("part", T.StringType()),
])
LATEST = "latest"


def batch_offsets(rows: DataFrame, batch: str | None = None) -> DataFrame:
    """``[batch,] topic, partition, from_offset, until_offset`` of Kafka rows
    (partial aggregation: one row per partition leaves each task)."""
    keys = ([batch] if batch else []) + ["topic", "partition"]
    return rows.groupBy(*keys).agg(F.min("offset").alias("from_offset"),
                                   (F.max("offset") + 1).alias("until_offset"))


def progress_ranges(progress: str | dict) -> list[tuple[str, int, int | None, int]]:
    """(topic, partition, from, until) of every Kafka source in the JSON of a
    ``StreamingQueryProgress``.  A partition new in this batch has no start."""
    def offsets(x) -> dict:
        x = json.loads(x) if isinstance(x, str) and x else x
        ok = isinstance(x, dict) and x and all(isinstance(p, dict) for p in x.values())
        return {(t, int(p)): int(o) for t, ps in x.items() for p, o in ps.items()} if ok else {}

    if isinstance(progress, str):
        progress = json.loads(progress)
    out = []
    for source in progress["sources"]:
        if "kafka" in source.get("description", "kafka").lower():
            start = offsets(source.get("startOffset"))
            out += [(t, p, start.get((t, p)), until) for (t, p), until in sorted(offsets(source.get("endOffset")).items())]
    return out


class OffsetLedger:
    def __init__(self, spark: SparkSession, path: str, module: str, group_id: str):
        self.spark, self.path, self.module, self.group_id = spark, path, module, group_id

    def record(self, rows: DataFrame, run: StreamRun, batch_id: int | None = None,
               batch: str | None = None, now: Column | None = None) -> None:
        """Append the offset ranges of one batch (``batch_id``) or of many
        batches at once (a ``batch`` column of ``rows``)."""
        bid = F.col(batch).cast("long") if batch else F.lit(batch_id).cast("long")
        self._append(batch_offsets(rows, batch).withColumn("batch_id", bid), run, now)

    def record_progress(self, progress: str | dict, run: StreamRun | None = None, now: Column | None = None) -> None:
        """Append the offset ranges in the JSON of a ``StreamingQueryProgress``,
        whose query id is the run.  A batch without input writes nothing."""
        if isinstance(progress, str):
            progress = json.loads(progress)
        ranges = [(*r, progress["batchId"]) for r in progress_ranges(progress)]
        if not ranges or not progress.get("numInputRows", 1):
            return
        rows = self.spark.createDataFrame(
            ranges, "topic string, partition int, from_offset long, until_offset long, batch_id long")  # one row a partition
        self._append(rows, run or StreamRun(progress["id"], None), now)

    def _append(self, ranges: DataFrame, run: StreamRun, now: Column | None) -> None:
        now = now if now is not None else F.current_timestamp()
        (ranges.select(F.lit(self.module).alias("module"), F.lit(self.group_id).alias("group_id"),
                       "topic", F.col("partition").cast("int").alias("partition"),
                       F.lit(run.id).alias("run_id"), F.lit(run.started).cast("timestamp").alias("run_started"),
                       F.col("batch_id").cast("long").alias("batch_id"), "from_offset", "until_offset",
                       now.cast("timestamp").alias("written_at"), F.lit(run.id).alias("part"))
         .write.mode("append").partitionBy("part").parquet(self.path))

    def log(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last batch of the run that wrote last."""
        keys = ["module", "group_id", "topic", "partition"]
        of_run = rows.groupBy(*keys, "run_id").agg(
            F.max("written_at").alias("written_at"), F.max("run_started").alias("run_started"),
            F.max(F.struct("batch_id", "until_offset", "from_offset")).alias("x"))
        last = F.max(F.struct("written_at", "run_started", "x", "run_id"))
        return (of_run.groupBy(*keys).agg(last.alias("y"))
                .select(*keys, "y.written_at", "y.run_started", "y.run_id", "y.x.*"))

    def current(self) -> DataFrame:
        """``module, group_id, topic, partition, until_offset`` (last wins)."""
        mine = (F.col("module") == self.module) & (F.col("group_id") == self.group_id)
        return self._last(self.log().where(mine)).select(
            "module", "group_id", "topic", "partition", "until_offset")

    def compact(self) -> None:
        """Keep only the last row of every partition (of all groups), in one
        folder.  The kept rows are committed before older folders go, and the
        last row wins wherever it is, so a crash in between changes nothing."""
        old = list_partitions(self.spark, self.path, "part")
        kept = self._last(self.log()).withColumn("part", F.lit(f"kept-{uuid.uuid4().hex}"))
        (kept.select(*LOG_SCHEMA.fieldNames()).coalesce(1)
         .write.mode("append").partitionBy("part").parquet(self.path))
        for p in old:
            delete_partition(self.spark, self.path, "part", p)

    def starting_offsets(self, partitions: dict[str, int] | None = None) -> DataFrame:
        """``starting_offsets``, the JSON the Kafka source takes, in one row;
        no row when the ledger holds nothing for this group.

        ``partitions`` (topic -> partition count) fills partitions the ledger
        has never seen with ``-1`` (latest), since a specific
        ``startingOffsets`` must name every partition.  The JSON lists each
        topic's partitions; a topic has a bounded number of partitions, so the
        per-topic list is small by construction.
        """
        current = self.current().select("topic", "partition", "until_offset")
        if partitions:
            every = (self.spark.createDataFrame(list(partitions.items()), "topic string, n int")
                     .select("topic", F.explode(F.sequence(F.lit(0), F.col("n") - 1))
                             .alias("partition")))
            current = (every.join(current, ["topic", "partition"], "full")
                       .select("topic", "partition",
                               F.coalesce("until_offset", F.lit(-1).cast("long"))
                               .alias("until_offset")))
        return starting_offsets_json(current).where(F.col("starting_offsets") != "{}")

    def resume_from(self, partitions: dict[str, int] | None = None) -> str:
        """Where a new checkpoint starts: the stored offsets, or the latest
        ones when nothing is stored for this group."""
        if not self.current().limit(1).count():
            return LATEST
        return self.starting_offsets(partitions).first()["starting_offsets"]


class LedgerListener(StreamingQueryListener):
    """Writes the ranges of every finished batch of one query to the ledger;
    add it with ``spark.streams.addListener``."""

    def __init__(self, ledger: OffsetLedger, query_id: str):
        self.ledger, self.query_id = ledger, query_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query_id:
            self.ledger.record_progress(event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def starting_offsets_json(current: DataFrame) -> DataFrame:
    per_topic = (current.groupBy("topic")
                 .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(
                     F.col("partition").cast("string").alias("k"),
                     F.col("until_offset").alias("v")))) ).alias("offsets")))
    entries = F.array_sort(F.collect_list(F.struct(F.col("topic").alias("k"),
                                                   F.col("offsets").alias("v"))),
                           lambda a, b: F.when(a["k"] < b["k"], -1)
                           .when(a["k"] > b["k"], 1).otherwise(0))
    return per_topic.agg(F.to_json(F.map_from_entries(entries)).alias("starting_offsets"))
