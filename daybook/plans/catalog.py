"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the driver's ``events`` table, derives the wire input
with :mod:`daybook.sources.fixtures` and runs the operator over all of it.
Queries that exercise a sink write under a fresh folder of the shared
``spark.checkpoint.dir`` and return what they read back.  Days are returned
as ``yyyy-MM-dd`` text so results compare exactly with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.functions.codec import decode_line, encode_line, parse_events
from daybook.operators import identity, legacy, metrics, quality
from daybook.schema import FLAT_COLUMNS, KAFKA_SCHEMA
from daybook.session import run_dir, use_utc
from daybook.sinks.archive import archive_lines, read_archive, write_archive, write_legacy_lines
from daybook.sinks.bucketed import BucketedVisitors
from daybook.sinks.counts import FilterCounts
from daybook.sinks.daily import DailyIncrements
from daybook.sinks.merge import merge_days
from daybook.sinks.totals import DailyTotals
from daybook.sinks.visitors import SeenVisitors
from daybook.sources import fixtures
from daybook.sources.kafka import kafka_rows, resume_stream
from daybook.sources.ledger import OffsetLedger
from daybook.sources.text import read_wire_text, stream_wire_text, write_wire_text
from daybook.streaming import state, stream
from daybook.streaming.run import StreamRun

MODULE, GROUP_ID = "daybook", "daybook-group"
N_ARRIVALS = 4
SEEN_TTL = dt.timedelta(days=5)
REPLAY = StreamRun("replay", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return fixtures.load_events(spark, sf_dir)


def flat_events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Wire JSON of every event, parsed: ``event_id, batch``, the flat
    ``columns`` (default all 22), ``event_ts, dt``."""
    return parse_events(fixtures.wire_events(events(spark, sf_dir)), keep=["event_id", "batch"],
                        columns=columns)


PAGE, VISITOR = ["pageUrl"], ["unionid"]
IDENTITY = ["dataType", "unionid", "openid", "userid", "phoneNo"]


def day_text(df: DataFrame, col: str = "dt") -> DataFrame:
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd"))


# --- sources -----------------------------------------------------------------

def q_read_wire_text(spark, sf_dir):
    path = run_dir(spark, "wire_text")
    write_wire_text(fixtures.wire_events(events(spark, sf_dir)), path)
    rows = parse_events(read_wire_text(spark, path), columns=["dataType", "openid"])
    return rows.select("dataType", "reportTime", "openid")


def q_offset_ledger(spark, sf_dir):
    ledger = OffsetLedger(spark, run_dir(spark, "ledger"), MODULE, GROUP_ID)
    ledger.record(fixtures.kafka_events(events(spark, sf_dir)), REPLAY, batch="batch_id")
    return ledger.current()


def q_starting_offsets(spark, sf_dir):
    ledger = OffsetLedger(spark, run_dir(spark, "ledger"), MODULE, GROUP_ID)
    ledger.record(fixtures.kafka_events(events(spark, sf_dir)), REPLAY, batch="batch_id")
    return ledger.starting_offsets()


def q_offset_ledger_rollback(spark, sf_dir):
    """Checkpoint a takes the first third of the topic, b the second; then the
    group goes back to a, which goes on to the end.  The last run to write wins,
    though b began later and went further than a had before."""
    ledger = OffsetLedger(spark, run_dir(spark, "ledger"), MODULE, GROUP_ID)
    rows = fixtures.kafka_events(events(spark, sf_dir))
    end = (rows.agg(F.max("offset")).first()[0] or 0) + 1
    later = StreamRun("later", REPLAY.started + dt.timedelta(days=1))
    steps = [(REPLAY, 0, 0, end // 3), (later, 0, end // 3, 2 * end // 3), (REPLAY, 1, end // 3, end)]
    for hour, (run, batch_id, lo, hi) in enumerate(steps):
        ledger.record(rows.where((F.col("offset") >= lo) & (F.col("offset") < hi)), run, batch_id,
                      now=F.lit(REPLAY.started + dt.timedelta(hours=hour)))
    return ledger.current()


# --- parsing, encoding -------------------------------------------------------

def q_parse_events(spark, sf_dir):
    return flat_events(spark, sf_dir).select("event_id", *FLAT_COLUMNS)


def q_encode_line(spark, sf_dir):
    flat = flat_events(spark, sf_dir)
    return flat.select("event_id", encode_line(flat).alias("line"))


def q_decode_line(spark, sf_dir):
    flat = flat_events(spark, sf_dir)
    lines = flat.select("event_id", encode_line(flat).alias("line"))
    return lines.select("event_id", *decode_line(F.col("line")))


def q_quarantine(spark, sf_dir):
    raw = fixtures.wire_events(events(spark, sf_dir), corrupt=True)
    return day_text(quality.quarantine_counts(quality.parse_checked(raw, keep=["event_id"])))


def q_quarantine_rows(spark, sf_dir):
    raw = fixtures.wire_events(events(spark, sf_dir), corrupt=True)
    checked = quality.parse_checked(raw, keep=["event_id"])
    return checked.where(F.col("reason").isNotNull()).select("event_id", "reason")


# --- identity ----------------------------------------------------------------

_ID_COLS = ["event_id", "dataType", "unionid", "openid", "userid", "phoneNo"]


def q_identity_eligible(spark, sf_dir):
    return identity.identity_eligible(flat_events(spark, sf_dir, IDENTITY)).select(*_ID_COLS)


def q_identity_eligible_observed(spark, sf_dir):
    return identity.identity_eligible(flat_events(spark, sf_dir, IDENTITY), "observed").select(*_ID_COLS)


def q_identity_outbox(spark, sf_dir):
    return identity.identity_outbox(flat_events(spark, sf_dir, IDENTITY), keep=["event_id"])


def q_identity_outbox_observed(spark, sf_dir):
    return identity.identity_outbox(flat_events(spark, sf_dir, IDENTITY), "observed", keep=["event_id"])


def q_reply_audit(spark, sf_dir):
    outbox = identity.identity_outbox(flat_events(spark, sf_dir, IDENTITY), keep=["event_id"])
    return identity.reply_audit(fixtures.identity_replies(outbox))


# --- filters, metrics, de-duplication ----------------------------------------

def q_page_views(spark, sf_dir):
    return day_text(metrics.page_views(flat_events(spark, sf_dir, PAGE))
                    .select("event_id", "dt", "pageUrl"))


def q_visitor_rows(spark, sf_dir):
    return day_text(metrics.visitor_rows(flat_events(spark, sf_dir, VISITOR)))


def q_pv_daily(spark, sf_dir):
    return day_text(metrics.pv_daily(flat_events(spark, sf_dir, PAGE)))


def q_uv_daily(spark, sf_dir):
    return day_text(metrics.uv_daily(flat_events(spark, sf_dir, VISITOR)))


def q_uv_daily_observed(spark, sf_dir):
    return day_text(metrics.uv_daily_observed(flat_events(spark, sf_dir, VISITOR)))


def q_batch_dedup(spark, sf_dir):
    return day_text(metrics.batch_dedup(flat_events(spark, sf_dir, VISITOR)))


def q_new_visitors(spark, sf_dir):
    return day_text(metrics.new_visitors_in(flat_events(spark, sf_dir, VISITOR), fixtures.N_BATCHES - 1))


def q_filter_counts(spark, sf_dir):
    return metrics.filter_counts(flat_events(spark, sf_dir, VISITOR))


def _staged(spark, sf_dir, base: str, rows_of, columns: list[str]) -> DataFrame:
    """Rows parsed once into a table partitioned by batch; each batch then
    reads only its own partition."""
    flat = flat_events(spark, sf_dir, columns)
    rows_of(flat).write.partitionBy("batch").parquet(f"{base}/input")
    return spark.read.parquet(f"{base}/input")


def _page_view_days(flat: DataFrame) -> DataFrame:
    return metrics.page_views(flat).groupBy("batch", "dt").agg(F.count(F.lit(1)).alias("n"))


def _visitors(flat: DataFrame) -> DataFrame:
    return metrics.visitor_rows(flat, ["batch"])


def _replay_visitors(spark, staged: DataFrame, base: str) -> tuple[SeenVisitors, DailyIncrements]:
    """The batches in order through the seen-visitor store, counting the new
    ones per day, as the streaming job does."""
    seen, uv = SeenVisitors(spark, f"{base}/seen"), DailyIncrements(spark, f"{base}/uv")
    for b in range(fixtures.N_BATCHES):
        uv.write(seen.add(staged.where(F.col("batch") == b), REPLAY.id, b), REPLAY.id, b)
    return seen, uv


def q_seen_visitors(spark, sf_dir):
    base = run_dir(spark, "seen_visitors")
    seen, _ = _replay_visitors(spark, _staged(spark, sf_dir, base, _visitors, VISITOR), base)
    return day_text(seen.visitors())


def q_seen_bucketed(spark, sf_dir):
    """The same through the store bucketed by visitor, opened again for every batch."""
    base = run_dir(spark, "seen_bucketed")
    staged = _staged(spark, sf_dir, base, _visitors, VISITOR)
    uv = DailyIncrements(spark, f"{base}/uv")
    for b in range(fixtures.N_BATCHES):
        seen = BucketedVisitors(spark, f"{base}/seen", buckets=8)
        uv.write(seen.add(staged.where(F.col("batch") == b), REPLAY.id, b), REPLAY.id, b)
    return day_text(seen.counts().join(uv.amounts(), "dt", "full"))


def q_seen_expire_totals(spark, sf_dir):
    """The first day is dropped from the store; a visitor who comes late for
    it still adds one to the day's total."""
    base = run_dir(spark, "seen_expire")
    staged = _staged(spark, sf_dir, base, _visitors, VISITOR)
    seen, uv = _replay_visitors(spark, staged, base)
    first = staged.agg(F.min("dt").alias("dt")).withColumn("unionid", F.lit("comes-late"))
    day = first.first()["dt"]
    seen.compact(day + dt.timedelta(days=3))
    seen.expire(day + dt.timedelta(days=1))
    late = fixtures.N_BATCHES
    uv.write(seen.add(first, REPLAY.id, late), REPLAY.id, late)
    return day_text(uv.amounts())


def q_seen_ttl(spark, sf_dir):
    """Four arrivals in order of time, rows up to ten days late, each batch
    stored at the time of its last row: a day stays while visitors are added
    to it and goes when none was for ``SEEN_TTL``."""
    rows = fixtures.kafka_events(events(spark, sf_dir), late=True)
    base = run_dir(spark, "seen_ttl")
    _stage(rows, _in_time(rows), base)
    staged = spark.read.parquet(f"{base}/staged")
    clock = {r["arrival"]: r["now"] for r in staged.groupBy("arrival").agg(F.max("timestamp").alias("now")).collect()}
    seen = SeenVisitors(spark, f"{base}/seen", ttl=SEEN_TTL)
    for k in sorted(clock):
        flat = parse_events(kafka_rows(staged.where(F.col("arrival") == k)), columns=VISITOR)
        seen.add(metrics.visitor_rows(flat), REPLAY.id, k, now=F.lit(clock[k]))
    return day_text(seen.visitors())


# --- sinks -------------------------------------------------------------------

def q_pv_snapshot(spark, sf_dir):
    """Increments batch by batch; the running total of each day after every
    batch that touched it."""
    base = run_dir(spark, "pv_snapshot")
    staged = _staged(spark, sf_dir, base, _page_view_days, PAGE)
    pv = DailyIncrements(spark, f"{base}/pv")
    for b in range(fixtures.N_BATCHES):
        pv.write(staged.where(F.col("batch") == b), REPLAY.id, b)
    return day_text(pv.running(REPLAY.id))


def q_pv_times(spark, sf_dir):
    """Totals with their times, every batch an hour after the one before, the
    odd ones in a second run: a day is made by its first batch and renewed by
    its last."""
    base = run_dir(spark, "pv_times")
    staged = _staged(spark, sf_dir, base, _page_view_days, PAGE)
    pv = DailyIncrements(spark, f"{base}/pv")
    for b in range(fixtures.N_BATCHES):
        pv.write(staged.where(F.col("batch") == b), f"run-{b % 2}", b, now=F.lit(REPLAY.started + dt.timedelta(hours=b)))
    pv.fold("run-0")
    return day_text(pv.totals()).select("dt", "amount", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
                                                          for c in ("create_time", "update_time")])


def q_uv_snapshot(spark, sf_dir):
    base = run_dir(spark, "uv_snapshot")
    _, uv = _replay_visitors(spark, _staged(spark, sf_dir, base, _visitors, VISITOR), base)
    return day_text(uv.running(REPLAY.id))


def q_daily_archive(spark, sf_dir):
    raw = fixtures.wire_events(events(spark, sf_dir))
    flat = parse_events(raw, keep=["ingest_ts"], ingest_ts=None)
    path = run_dir(spark, "archive")
    write_archive(archive_lines(flat), path, REPLAY.id)
    return day_text(read_archive(spark, path).select("dt", F.col("value").alias("line")))


# --- streaming ---------------------------------------------------------------

def _in_time(rows: DataFrame):
    """Number of the arrival of each row: ``N_ARRIVALS`` equal spans of time."""
    micros = F.unix_micros("timestamp")
    lo, hi = rows.agg(F.min(micros), F.max(micros)).first()  # one row of bounds
    return F.floor((micros - F.lit(lo or 0)) / F.lit(((hi or 0) - (lo or 0)) // N_ARRIVALS + 1))


def _stage(rows: DataFrame, arrival, base: str) -> None:
    (rows.withColumn("arrival", F.coalesce(arrival, F.lit(0)).cast("int"))
     .write.partitionBy("arrival").parquet(f"{base}/staged"))


def _arrivals(spark, sf_dir, base: str, late: bool = False, shuffled: bool = False):
    """Yield after each of ``N_ARRIVALS`` drops of Kafka-shaped files into
    ``<base>/source``: in order of time, or ``shuffled`` (every fourth event),
    as with ``late``, when rows come up to ten days late and some report times
    in 2099.  The input is made once."""
    rows = fixtures.kafka_events(events(spark, sf_dir), late=late)
    _stage(rows, F.col("offset") % N_ARRIVALS if late or shuffled else _in_time(rows), base)
    staged = spark.read.parquet(f"{base}/staged")
    for k in range(N_ARRIVALS):
        (staged.where(F.col("arrival") == k).select(*KAFKA_SCHEMA.fieldNames())
         .write.mode("append").parquet(f"{base}/source"))
        yield k


def _pv_stream(late: bool):
    """After each drop the streaming query runs (``availableNow``) from its
    checkpoint and appends the batch's page views per day."""
    def q(spark, sf_dir):
        base = run_dir(spark, "pv_stream")
        pv = DailyIncrements(spark, f"{base}/pv")
        for _ in _arrivals(spark, sf_dir, base, late):
            stream.drain(stream.start_pv_query(stream.kafka_file_stream(spark, f"{base}/source"), pv,
                                               f"{base}/checkpoint", stream.NOW))
        return day_text(pv.amounts())
    return q


def _uv_stream(late: bool):
    """As the PV stream, with the seen-visitor store."""
    def q(spark, sf_dir):
        base = run_dir(spark, "uv_stream")
        seen, uv = SeenVisitors(spark, f"{base}/seen"), DailyIncrements(spark, f"{base}/uv")
        for _ in _arrivals(spark, sf_dir, base, late):
            stream.drain(stream.start_uv_query(stream.kafka_file_stream(spark, f"{base}/source"), seen, uv,
                                               f"{base}/checkpoint", stream.NOW))
        return day_text(uv.amounts())
    return q


def q_pv_state_stream(spark, sf_dir):
    """The count of every day as streaming state, over the late rows."""
    base = run_dir(spark, "pv_state")
    totals = DailyTotals(spark, f"{base}/pv")
    for _ in _arrivals(spark, sf_dir, base, late=True):
        stream.drain(state.start_pv_state_query(stream.kafka_file_stream(spark, f"{base}/source"), totals,
                                                f"{base}/checkpoint", stream.NOW))
    return day_text(totals.amounts())


def _uv_state(spark, sf_dir, base: str):
    seen, uv = SeenVisitors(spark, f"{base}/seen"), DailyIncrements(spark, f"{base}/uv")
    days = state.StateDays(spark, f"{base}/days")
    for _ in _arrivals(spark, sf_dir, base, late=True):
        stream.drain(state.start_uv_state_query(stream.kafka_file_stream(spark, f"{base}/source"), seen, uv, days,
                                                f"{base}/checkpoint", stream.NOW))
    return uv


def q_uv_state_stream(spark, sf_dir):
    """The visitors of every day as keys of the state store, over the late rows."""
    return day_text(_uv_state(spark, sf_dir, run_dir(spark, "uv_state")).amounts())


def q_state_audit(spark, sf_dir):
    """The visitors that the state store holds for each day, read back, beside
    the total that the stream stored."""
    base = run_dir(spark, "state_audit")
    uv = _uv_state(spark, sf_dir, base)
    held = state.uv_state(spark, f"{base}/checkpoint").withColumnRenamed("amount", "in_state")
    return day_text(uv.amounts().join(held, "dt", "full"))


def q_filter_counts_stream(spark, sf_dir):
    """Rows of each micro-batch before and after the lookup, observed in the
    job that stores the new visitors."""
    base = run_dir(spark, "filter_counts")
    seen, uv = SeenVisitors(spark, f"{base}/seen"), DailyIncrements(spark, f"{base}/uv")
    counts = FilterCounts(spark, f"{base}/counts")
    for _ in _arrivals(spark, sf_dir, base, shuffled=True):
        stream.drain(stream.start_uv_query(stream.kafka_file_stream(spark, f"{base}/source"), seen, uv,
                                           f"{base}/checkpoint", stream.NOW, counts))
    return counts.read().select(F.col("batch_id").alias("batch"), "before_n", "after_n")


def q_archive_stream(spark, sf_dir):
    """The archive by the streaming file sink, restarted after every arrival."""
    base = run_dir(spark, "archive_stream")
    for _ in _arrivals(spark, sf_dir, base):
        stream.drain(stream.start_archive_query(stream.kafka_file_stream(spark, f"{base}/source"), f"{base}/archive",
                                                f"{base}/checkpoint", stream.NOW, codec="gzip"))
    return day_text(read_archive(spark, f"{base}/archive").select("dt", F.col("value").alias("line")))


def q_resume_totals(spark, sf_dir):
    """Half of the topic through one checkpoint, then all of it offered to a
    new one that resumes from the ledger: every row counts once."""
    base = run_dir(spark, "resume")
    rows = fixtures.kafka_events(events(spark, sf_dir)).select(*KAFKA_SCHEMA.fieldNames())
    middle = rows.agg(F.max("offset")).first()[0] or 0
    out = stream.EventOutputs(spark, f"{base}/out", MODULE, GROUP_ID)
    for k, part in enumerate((F.col("offset") <= middle // 2, F.col("offset") > middle // 2)):
        rows.where(part).write.mode("append").parquet(f"{base}/topic")
        raw = resume_stream(spark, f"{base}/topic", fixtures.TOPIC, out.ledger, read=fixtures.read_file_topic)
        stream.drain(stream.start_event_job(raw, out, f"{base}/checkpoint-{k}", stream.NOW))

    def total(name: str, metric: DailyIncrements) -> DataFrame:
        return metric.amounts().select(F.lit(name).alias("kind"), F.date_format("dt", "yyyy-MM-dd").alias("key"), "amount")

    outbox = (spark.read.parquet(out.outbox).select(F.lit("outbox").alias("kind"), F.concat_ws(
        " ", F.col("offset").cast("string"), "body").alias("key"), F.lit(1).cast("long").alias("amount")))
    return total("pv", out.pv).unionByName(total("uv", out.uv)).unionByName(outbox)


def q_archive_merged(spark, sf_dir):
    """The archive of four batches, compressed, after its past days were merged."""
    base = run_dir(spark, "archive_merged")
    raw = fixtures.wire_events(events(spark, sf_dir))
    raw.write.partitionBy("batch").parquet(f"{base}/input")
    staged = spark.read.parquet(f"{base}/input")
    for b in range(fixtures.N_BATCHES):
        flat = parse_events(staged.where(F.col("batch") == b), keep=["ingest_ts"], ingest_ts=None)
        write_archive(archive_lines(flat), f"{base}/archive", REPLAY.id, b, codec="gzip")
    merge_days(spark, f"{base}/archive", "2999-01-01")
    return day_text(read_archive(spark, f"{base}/archive").select("dt", F.col("value").alias("line")))


def q_archive_lines(spark, sf_dir):
    """The event job over a topic with truncated documents: the archive holds
    the good rows and no other."""
    base = run_dir(spark, "archive_lines")
    raw = fixtures.wire_events(events(spark, sf_dir), corrupt=True)
    out = stream.EventOutputs(spark, f"{base}/out", MODULE, GROUP_ID)
    stream.event_batch(raw.select("value", "ingest_ts"), REPLAY, 0, out)
    return day_text(read_archive(spark, out.archive).select("dt", F.col("value").alias("line")))


# --- legacy ------------------------------------------------------------------

def _legacy(spark, sf_dir, kinds: list[str] | None = None) -> DataFrame:
    return legacy.legacy_records(fixtures.legacy_events(events(spark, sf_dir)), keep=["event_id"], kinds=kinds)


def q_legacy_guard(spark, sf_dir):
    raw = fixtures.legacy_events(events(spark, sf_dir))
    return (raw.groupBy(legacy.legacy_guard(F.col("value")).alias("passed"))
            .agg(F.count(F.lit(1)).alias("n")))


def _legacy_kind(kind: str):
    def q(spark, sf_dir):
        return legacy.legacy_lines(_legacy(spark, sf_dir, [kind]), kind).select("event_id", "line")
    return q


def q_legacy_status(spark, sf_dir):
    return (_legacy(spark, sf_dir).groupBy("label", "status")
            .agg(F.count(F.lit(1)).alias("n")))


def q_legacy_labels(spark, sf_dir):
    return legacy.label_counts(fixtures.legacy_events(events(spark, sf_dir)))


def q_legacy_batch_lines(spark, sf_dir):
    """The batch job over a text file: the same lines without the text guard."""
    base = run_dir(spark, "legacy_batch")
    write_wire_text(fixtures.legacy_events(events(spark, sf_dir)), f"{base}/text")
    write_legacy_lines(legacy.legacy_records(read_wire_text(spark, f"{base}/text"), guard=False), f"{base}/lines", REPLAY.id)
    return read_archive(spark, f"{base}/lines").select(F.col("value").alias("line"))


def q_legacy_stream_lines(spark, sf_dir):
    """The legacy streaming job over text files: all lines it wrote."""
    base = run_dir(spark, "legacy_stream")
    write_wire_text(fixtures.legacy_events(events(spark, sf_dir)), f"{base}/text")
    stream.drain(stream.start_legacy_job(stream_wire_text(spark, f"{base}/text"), f"{base}/out",
                                         f"{base}/checkpoint", stream.NOW))
    return read_archive(spark, f"{base}/out/lines").select(F.col("value").alias("line"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_wire_text": q_read_wire_text,
    "parse_events": q_parse_events,
    "encode_line": q_encode_line,
    "decode_line": q_decode_line,
    "quarantine": q_quarantine,
    "quarantine_rows": q_quarantine_rows,
    "identity_eligible": q_identity_eligible,
    "identity_eligible_observed": q_identity_eligible_observed,
    "identity_outbox": q_identity_outbox,
    "identity_outbox_observed": q_identity_outbox_observed,
    "reply_audit": q_reply_audit,
    "page_views": q_page_views,
    "visitor_rows": q_visitor_rows,
    "pv_daily": q_pv_daily,
    "uv_daily": q_uv_daily,
    "uv_daily_observed": q_uv_daily_observed,
    "batch_dedup": q_batch_dedup,
    "new_visitors": q_new_visitors,
    "seen_visitors": q_seen_visitors,
    "seen_bucketed": q_seen_bucketed,
    "seen_expire_totals": q_seen_expire_totals,
    "seen_ttl": q_seen_ttl,
    "filter_counts": q_filter_counts,
    "filter_counts_stream": q_filter_counts_stream,
    "pv_snapshot": q_pv_snapshot,
    "uv_snapshot": q_uv_snapshot,
    "pv_times": q_pv_times,
    "pv_daily_stream": _pv_stream(False),
    "uv_daily_stream": _uv_stream(False),
    "pv_daily_stream_late": _pv_stream(True),
    "uv_daily_stream_late": _uv_stream(True),
    "pv_state_stream": q_pv_state_stream,
    "uv_state_stream": q_uv_state_stream,
    "state_audit": q_state_audit,
    "resume_totals": q_resume_totals,
    "daily_archive": q_daily_archive,
    "archive_lines": q_archive_lines,
    "archive_stream": q_archive_stream,
    "archive_merged": q_archive_merged,
    "offset_ledger": q_offset_ledger,
    "offset_ledger_rollback": q_offset_ledger_rollback,
    "starting_offsets": q_starting_offsets,
    "legacy_guard": q_legacy_guard,
    "legacy_auth": _legacy_kind("auth"),
    "legacy_login": _legacy_kind("login"),
    "legacy_visit": _legacy_kind("visit"),
    "legacy_labels": q_legacy_labels,
    "legacy_status": q_legacy_status,
    "legacy_stream_lines": q_legacy_stream_lines,
    "legacy_batch_lines": q_legacy_batch_lines,
}
