"""Structured Streaming form of the event job and of the legacy job.

Every query is one ``foreachBatch`` over its source.  What a micro-batch
writes lies under the batch's own ``run, batch_id`` (the run is the
checkpoint's query id), so a replay replaces its own output, another
checkpoint never overwrites it, and no streaming state or watermark is
needed: a row counts for its day however late it comes.

* :func:`start_event_job` - the whole job: one read and one checked parse per
  micro-batch feed quarantine, archive, identity outbox, PV, UV and, last,
  the offset ledger.
* :func:`start_pv_query`, :func:`start_uv_query` - one metric alone, over
  the rows that the event job does not quarantine.
* :func:`start_legacy_job` - guard, three-way dispatch and dated line output
  of the legacy documents, the rest to quarantine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.operators.identity import identity_outbox
from daybook.operators.legacy import legacy_records
from daybook.operators.metrics import page_views, visitor_rows
from daybook.operators.quality import bad_rows, good_rows, parse_checked
from daybook.schema import KAFKA_SCHEMA
from daybook.sinks.archive import archive_lines, start_archive_stream, write_archive, write_legacy_lines
from daybook.sinks.counts import FilterCounts
from daybook.sinks.daily import DailyIncrements, write_batch
from daybook.sinks.visitors import SeenVisitors
from daybook.sources.kafka import kafka_rows
from daybook.sources.ledger import OffsetLedger
from daybook.streaming.run import StreamRun, run_of


def start_batches(raw: DataFrame, step: Callable[[DataFrame, StreamRun, int], None], checkpoint: str,
                  trigger: dict | None = None, name: str | None = None):
    """Run ``step(batch, run, batch_id)`` for every micro-batch of ``raw``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        step(batch, run_of(batch.sparkSession, checkpoint), batch_id)

    w = raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.queryName(name) if name else w
    return (w.trigger(**trigger) if trigger else w).start()


# --- metrics -----------------------------------------------------------------

def parse_batch(batch: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``dt`` of the good rows of a batch of source rows.  Only
    their leaves and those that can make a row bad are parsed."""
    return good_rows(parse_checked(batch, columns=columns)).select(*columns, "dt")


def add_page_views(flat: DataFrame, pv: DailyIncrements, run: StreamRun, batch_id: int) -> None:
    pv.write(page_views(flat).groupBy("dt").agg(F.count(F.lit(1)).alias("n")), run.id, batch_id)


def add_visitors(flat: DataFrame, seen: SeenVisitors, uv: DailyIncrements, run: StreamRun, batch_id: int,
                 counts: FilterCounts | None = None) -> None:
    """New visitors are stored first and counted from what was stored, so a
    replay between the two writes gives the same increments.  The batch is
    read once: its distinct visitors are kept for the lookup of their days.
    ``counts`` takes the batch's rows before and after the lookup."""
    rows = visitor_rows(flat)
    visitors = (rows.groupBy("dt", "unionid").agg(F.count(F.lit(1)).alias("n")) if counts
                else rows.dropDuplicates(["dt", "unionid"])).persist()
    try:
        around = counts.start() if counts else None
        uv.write(seen.add(visitors, run.id, batch_id, counts=around), run.id, batch_id)
        if counts:
            counts.record(around, run.id, batch_id)
    finally:
        visitors.unpersist()


def start_pv_query(raw: DataFrame, pv: DailyIncrements, checkpoint: str, trigger: dict | None = None):
    """Running daily page views of source rows (``value, ingest_ts``)."""
    return start_batches(raw, lambda b, run, i: add_page_views(parse_batch(b, ["pageUrl"]), pv, run, i),
                         checkpoint, trigger)


def start_uv_query(raw: DataFrame, seen: SeenVisitors, uv: DailyIncrements, checkpoint: str,
                   trigger: dict | None = None, counts: FilterCounts | None = None):
    """Running daily visitors of source rows (``value, ingest_ts``)."""
    return start_batches(raw, lambda b, run, i: add_visitors(parse_batch(b, ["unionid"]), seen, uv, run, i, counts),
                         checkpoint, trigger)


def start_archive_query(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                        codec: str | None = None):
    """The daily line archive of source rows, without ``foreachBatch``."""
    return start_archive_stream(archive_lines(good_rows(parse_checked(raw))), path, checkpoint, trigger, codec)


# --- the event job -----------------------------------------------------------

class EventOutputs:
    """Where the event job writes, all under ``base``."""

    def __init__(self, spark: SparkSession, base: str, module: str = "daybook", group_id: str = "daybook"):
        self.quarantine, self.outbox, self.archive = f"{base}/quarantine", f"{base}/identity_outbox", f"{base}/archive"
        self.pv = DailyIncrements(spark, f"{base}/pv")
        self.uv = DailyIncrements(spark, f"{base}/uv")
        self.seen = SeenVisitors(spark, f"{base}/seen")
        self.ledger = OffsetLedger(spark, f"{base}/ledger", module, group_id)


def event_batch(batch: DataFrame, run: StreamRun, batch_id: int, out: EventOutputs,
                mode: str = "documented") -> None:
    """One micro-batch, parsed and checked once.  Bad rows go to quarantine
    and nowhere else; the ledger covers good and bad rows and is written last,
    so a failure before it replays the batch."""
    keep = [c for c in ("topic", "partition", "offset") if c in batch.columns]
    checked = parse_checked(batch, keep=keep).persist()
    try:
        write_batch(bad_rows(checked), out.quarantine, run.id, batch_id)
        good = good_rows(checked)
        write_batch(identity_outbox(good, mode, keep=keep), out.outbox, run.id, batch_id)
        write_archive(archive_lines(good), out.archive, run.id, batch_id)
        add_page_views(good, out.pv, run, batch_id)
        add_visitors(good, out.seen, out.uv, run, batch_id)
        if keep:
            out.ledger.record(checked, run, batch_id)
    finally:
        checked.unpersist()


def start_event_job(raw: DataFrame, out: EventOutputs, checkpoint: str, trigger: dict | None = None,
                    mode: str = "documented"):
    """Start the whole job over ``raw`` (Kafka-shaped rows with ``ingest_ts``,
    e.g. of :func:`daybook.sources.kafka.resume_stream`)."""
    return start_batches(raw, lambda b, run, i: event_batch(b, run, i, out, mode), checkpoint, trigger, "events")


# --- the legacy job ----------------------------------------------------------

def legacy_batch(batch: DataFrame, run: StreamRun, batch_id: int, base: str) -> None:
    """Good lines under ``<base>/lines``, by arrival day; documents that the
    guard, the label or a field rejects under ``<base>/quarantine``."""
    records = legacy_records(batch, keep=["ingest_ts", "value"]).persist()
    try:
        write_legacy_lines(records, f"{base}/lines", run.id, batch_id, day=F.to_date("ingest_ts"))
        write_batch(records.where(F.col("status") != "ok").select("value", F.col("status").alias("reason"), "ingest_ts"),
                    f"{base}/quarantine", run.id, batch_id)
    finally:
        records.unpersist()


def start_legacy_job(raw: DataFrame, base: str, checkpoint: str, trigger: dict | None = None):
    """The legacy streaming job over rows ``value, ingest_ts``."""
    return start_batches(raw, lambda b, run, i: legacy_batch(b, run, i, base), checkpoint, trigger, "legacy")


# --- Kafka-shaped files ------------------------------------------------------

def kafka_file_stream(spark: SparkSession, source: str) -> DataFrame:
    """Stream over Kafka-shaped parquet files arriving in ``source``."""
    return kafka_rows(spark.readStream.schema(KAFKA_SCHEMA).parquet(source))


def drain(query):
    """Wait for a query started with ``availableNow``; returns it."""
    query.awaitTermination()
    return query


NOW = {"availableNow": True}
