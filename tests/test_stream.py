"""Streams: totals, late rows, wrong clocks, restarts, resumes, replays and crashes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from daybook.functions.codec import parse_events
from daybook.operators import metrics
from daybook.operators.identity import identity_eligible
from daybook.schema import KAFKA_SCHEMA
from daybook.session import remove_dir
from daybook.sinks.archive import read_archive
from daybook.sinks.daily import DailyIncrements
from daybook.sinks.visitors import SeenVisitors
from daybook.sources import fixtures
from daybook.sources.fixtures import read_file_topic
from daybook.sources.kafka import kafka_rows, resume_stream
from daybook.sources.ledger import OffsetLedger
from daybook.streaming import stream
from daybook.streaming.run import StreamRun

RUN_A = StreamRun("a", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
RUN_B = StreamRun("b", dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))


def kafka_batch(spark, docs, first=0):
    """Kafka-shaped rows from (arrival, unionid, pageUrl[, reported]) tuples."""
    rows = []
    for i, (ts, uid, page, *reported) in enumerate(docs):
        visit = ',"visitData":{"pageUrl":"%s"}' % page if page else ""
        doc = ('{"dataType":"visit","reportTime":"%s","data":{"wxInfo":{"unionid":"%s"}%s}}'
               % ((reported or [ts])[0].strftime("%Y-%m-%d %H:%M:%S"), uid, visit))
        rows.append((doc, "t", 0, first + i, ts))
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


def amounts(metric):
    return {r["dt"]: r["amount"] for r in metric.amounts().collect()}


class Job:
    """PV and UV queries over one source folder."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.pv, self.uv = DailyIncrements(spark, f"{base}/pv"), DailyIncrements(spark, f"{base}/uv")
        self.seen = SeenVisitors(spark, f"{base}/seen")

    def arrive(self, rows):
        rows.select(*KAFKA_SCHEMA.fieldNames()).write.mode("append").parquet(f"{self.base}/src")

    def run(self):
        raw = stream.kafka_file_stream(self.spark, f"{self.base}/src")
        return [stream.drain(stream.start_pv_query(raw, self.pv, f"{self.base}/ck_pv", stream.NOW)),
                stream.drain(stream.start_uv_query(raw, self.seen, self.uv, f"{self.base}/ck_uv", stream.NOW))]


def test_stream_equals_batch_and_compaction_changes_nothing(spark, events, workdir):
    job, rows, day = Job(spark, workdir), fixtures.kafka_events(events), F.dayofmonth("timestamp")
    for lo, hi in [(1, 15), (16, 31)]:
        job.arrive(rows.where((day >= lo) & (day <= hi)))
        job.run()
    flat = parse_events(fixtures.wire_events(events))
    want_pv = {r["dt"]: r["pv"] for r in metrics.pv_daily(flat).collect()}
    want_uv = {r["dt"]: r["uv"] for r in metrics.uv_daily(flat).collect()}
    assert amounts(job.pv) == want_pv and amounts(job.uv) == want_uv
    run = job.pv.read().first()["run"]
    times = {r["dt"]: r["create_time"] for r in job.pv.totals().collect()}
    job.pv.fold(run)
    job.pv.fold(run)
    assert amounts(job.pv) == want_pv and job.pv.read().count() == len(want_pv)
    assert {r["dt"]: r["create_time"] for r in job.pv.totals().collect()} == times
    job.seen.compact("2999-01-01")
    assert {r["dt"]: r["uv"] for r in job.seen.counts().collect()} == want_uv


def test_late_rows_and_wrong_clocks(spark, workdir):
    job, at = Job(spark, workdir), dt.datetime(2024, 1, 10, 8, 0)
    job.arrive(kafka_batch(spark, [(at, "a", "p"), (at, "b", "p"), (at, "x", "p", dt.datetime(2099, 1, 1))]))
    job.run()
    later = dt.datetime(2024, 1, 11, 9, 0)
    job.arrive(kafka_batch(spark, [(later, "a", "p"), (later, "c", "p", dt.datetime(2024, 1, 1, 7, 0)), (later, "b", "p", at)], 3))
    job.run()
    assert amounts(job.pv) == {dt.date(2024, 1, 10): 4, dt.date(2024, 1, 11): 1, dt.date(2024, 1, 1): 1}
    assert amounts(job.uv) == {dt.date(2024, 1, 10): 3, dt.date(2024, 1, 11): 1, dt.date(2024, 1, 1): 1}


def test_restart_on_the_same_checkpoint_counts_nothing_again(spark, workdir):
    job, at = Job(spark, workdir), dt.datetime(2024, 1, 10, 8, 0)
    job.arrive(kafka_batch(spark, [(at, "hot", "p")] * 60 + [(at, "b", None)]))
    job.run()
    job.run()
    job.arrive(kafka_batch(spark, [(at, "hot", "p")] * 30 + [(at, "c", None)], 61))
    progress = [q.recentProgress for q in job.run()]
    assert [[p["numInputRows"] for p in ps] for ps in progress] == [[31], [31]]
    assert amounts(job.pv) == {at.date(): 90} and amounts(job.uv) == {at.date(): 3}


@pytest.mark.parametrize("lost", ["increments", "visitors and increments", "nothing"])
def test_a_batch_that_crashed_is_replayed_without_loss(spark, workdir, lost):
    job, at = Job(spark, workdir), dt.datetime(2024, 1, 10, 8, 0)
    batches = [parse_events(kafka_rows(kafka_batch(spark, [(at, u, "p") for u in us]))) for us in ("ab", "bcd")]
    for i, b in enumerate(batches):
        stream.add_page_views(b, job.pv, RUN_A, i)
        stream.add_visitors(b, job.seen, job.uv, RUN_A, i)
    if lost != "nothing":  # the last batch died while it wrote
        remove_dir(spark, f"{workdir}/pv/batches/run=a/batch_id=1")
        remove_dir(spark, f"{workdir}/uv/batches/run=a/batch_id=1")
        assert amounts(job.pv) == {at.date(): 2}  # what was there stays
    if lost.startswith("visitors"):
        rows = job.seen.read().where("batch_id = 0")
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        remove_dir(spark, f"{workdir}/seen")
        rows.write.partitionBy("dt").parquet(f"{workdir}/seen")
    stream.add_page_views(batches[1], job.pv, RUN_A, 1)
    stream.add_visitors(batches[1], job.seen, job.uv, RUN_A, 1)
    assert amounts(job.pv) == {at.date(): 5} and amounts(job.uv) == {at.date(): 4}


def test_a_new_checkpoint_adds_to_the_totals(spark, workdir):
    job, at = Job(spark, workdir), dt.datetime(2024, 1, 10, 8, 0)
    for run, us in ((RUN_A, "abc"), (RUN_B, "cd")):
        b = parse_events(kafka_rows(kafka_batch(spark, [(at, u, "p") for u in us])))
        stream.add_page_views(b, job.pv, run, 0)
        stream.add_visitors(b, job.seen, job.uv, run, 0)
    assert amounts(job.pv) == {at.date(): 5} and amounts(job.uv) == {at.date(): 4}


def test_expired_days_keep_their_totals(spark, workdir):
    job, at = Job(spark, workdir), dt.datetime(2024, 1, 1, 8, 0)
    for i, us in enumerate(["abcde", "f"]):
        b = parse_events(kafka_rows(kafka_batch(spark, [(at, u, "p") for u in us])))
        stream.add_visitors(b, job.seen, job.uv, RUN_A, i)
        assert job.seen.expire("2024-01-02") == ["2024-01-01"]
    assert amounts(job.uv) == {at.date(): 6}


def test_event_batch_replays_and_bad_rows_go_nowhere_else(spark, events, workdir):
    rows = fixtures.kafka_events(events).select(*KAFKA_SCHEMA.fieldNames())
    at = dt.datetime(2024, 1, 1)
    bad = spark.createDataFrame([
        ("not json", "t", 9, 1, at),
        ('{"dataType":"visit","data":{"wxInfo":{"unionid":"u"},"addrInfo":{"latitude":"x"},"visitData":{"pageUrl":"p"}}}', "t", 9, 2, at)],
        KAFKA_SCHEMA)
    batch, out = kafka_rows(rows.unionByName(bad)), stream.EventOutputs(spark, workdir, "m", "g")
    for _ in range(2):
        stream.event_batch(batch, RUN_A, 0, out)
    stream.event_batch(batch.limit(0), RUN_B, 0, out)  # batch 0 of another run leaves the first alone
    flat = parse_events(fixtures.wire_events(events))
    assert sorted(r["reason"] for r in spark.read.parquet(out.quarantine).collect()) == ["bad_number", "malformed"]
    assert spark.read.parquet(out.outbox).count() == identity_eligible(flat).count()
    assert read_archive(spark, out.archive).count() == events.count()
    assert amounts(out.pv) == {r["dt"]: r["pv"] for r in metrics.pv_daily(flat).collect()}
    assert amounts(out.uv) == {r["dt"]: r["uv"] for r in metrics.uv_daily(flat).collect()}
    cur = {r["partition"]: r["until_offset"] for r in out.ledger.current().collect()}
    assert cur[9] == 3 and len(cur) == 5


def test_one_parse_feeds_every_output(spark, events, workdir, monkeypatch):
    plans, out = [], stream.EventOutputs(spark, workdir)
    real = stream.parse_checked

    def seen(*a, **k):
        df = real(*a, **k)
        plans.append(df._jdf.queryExecution().optimizedPlan().toString().count("from_json("))
        return df
    monkeypatch.setattr(stream, "parse_checked", seen)
    stream.event_batch(kafka_rows(fixtures.kafka_events(events)), RUN_A, 0, out)
    assert plans == [1]


def test_resume_goes_on_where_the_ledger_ends(spark, events, workdir):
    rows = fixtures.kafka_events(events).select(*KAFKA_SCHEMA.fieldNames())
    out = stream.EventOutputs(spark, f"{workdir}/out")
    for k, part in enumerate((F.col("offset") < 400, F.col("offset") >= 400)):
        rows.where(part).write.mode("append").parquet(f"{workdir}/topic")
        raw = resume_stream(spark, f"{workdir}/topic", fixtures.TOPIC, out.ledger, read=read_file_topic)
        stream.drain(stream.start_event_job(raw, out, f"{workdir}/ck{k}", stream.NOW))
    flat = parse_events(fixtures.wire_events(events))
    assert amounts(out.pv) == {r["dt"]: r["pv"] for r in metrics.pv_daily(flat).collect()}
    assert amounts(out.uv) == {r["dt"]: r["uv"] for r in metrics.uv_daily(flat).collect()}
    assert spark.read.parquet(out.outbox).count() == identity_eligible(flat).count()
    assert out.pv.read().select("run").distinct().count() == 2


def test_cold_start_and_another_group_begin_at_the_latest(spark, workdir):
    opened = []
    one = OffsetLedger(spark, f"{workdir}/ledger", "m", "one")
    two = OffsetLedger(spark, f"{workdir}/ledger", "m", "two")
    resume_stream(spark, "b:9092", "t", one, read=lambda s, o: opened.append(o))
    one.record(spark.createDataFrame([("t", 0, 9)], "topic string, partition int, offset long"), RUN_A, 3)
    resume_stream(spark, "b:9092", "t", two, read=lambda s, o: opened.append(o))
    resume_stream(spark, "b:9092", "t", one, {"t": 2}, read=lambda s, o: opened.append(o), max_offsets_per_trigger=5)
    assert [o["startingOffsets"] for o in opened[:2]] == ["latest", "latest"]
    assert json.loads(opened[2]["startingOffsets"]) == {"t": {"0": 10, "1": -1}} and opened[2]["maxOffsetsPerTrigger"] == "5"
    assert two.starting_offsets().collect() == []


def test_text_file_stream_source(spark, events, workdir):
    from daybook.sources.text import stream_wire_text, write_wire_text
    write_wire_text(fixtures.wire_events(events), f"{workdir}/text")
    pv = DailyIncrements(spark, f"{workdir}/pv")
    stream.drain(stream.start_pv_query(stream_wire_text(spark, f"{workdir}/text", max_files_per_trigger=2), pv,
                                       f"{workdir}/ck", stream.NOW))
    assert amounts(pv) == {r["dt"]: r["pv"] for r in metrics.pv_daily(parse_events(fixtures.wire_events(events))).collect()}


def test_legacy_job_writes_lines_and_quarantine_once(spark, events, workdir):
    from daybook.operators.legacy import legacy_records
    raw = fixtures.legacy_events(events).select("value", F.lit(dt.datetime(2024, 3, 4, 5, 6)).alias("ingest_ts"))
    for _ in range(2):
        stream.legacy_batch(raw, RUN_A, 0, workdir)
    status = {r["status"]: r["count"] for r in legacy_records(raw).groupBy("status").count().collect()}
    lines = read_archive(spark, f"{workdir}/lines")
    assert lines.count() == status["ok"] and lines.select("dt").distinct().first()["dt"] == dt.date(2024, 3, 4)
    got = {r["reason"]: r["count"] for r in spark.read.parquet(f"{workdir}/quarantine").groupBy("reason").count().collect()}
    assert got == {k: v for k, v in status.items() if k != "ok"}


def test_single_metric_queries_leave_out_what_the_event_job_quarantines(spark, workdir):
    good = {"dataType": "visit", "reportTime": "2024-01-01 10:00:00",
            "data": {"wxInfo": {"unionid": "u1"}, "visitData": {"pageUrl": "p"}}}
    far, flag = json.loads(json.dumps(good)), json.loads(json.dumps(good))
    far["data"]["wxInfo"]["unionid"], far["data"]["addrInfo"] = "u2", {"latitude": "x"}
    flag["data"]["wxInfo"]["unionid"], flag["data"]["loginData"] = "u3", {"succeed": "1"}
    job = Job(spark, workdir)
    rows = [(json.dumps(d), "t", 0, i, dt.datetime(2024, 1, 1, 11)) for i, d in enumerate((good, far, flag))]
    job.arrive(spark.createDataFrame(rows, KAFKA_SCHEMA))
    job.run()
    assert amounts(job.pv) == amounts(job.uv) == {dt.date(2024, 1, 1): 1}


def test_a_trigger_by_time_runs_batch_after_batch(spark, workdir):
    pv, at = DailyIncrements(spark, f"{workdir}/pv"), dt.datetime(2024, 1, 10, 8, 0)
    src = f"{workdir}/src"
    kafka_batch(spark, [(at, "a", "p")]).write.mode("append").parquet(src)
    query = stream.start_pv_query(stream.kafka_file_stream(spark, src), pv, f"{workdir}/ck", {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        assert amounts(pv) == {at.date(): 1} and query.isActive
        kafka_batch(spark, [(at, "b", "p"), (at, "c", None)], 1).write.mode("append").parquet(src)
        query.processAllAvailable()
        assert amounts(pv) == {at.date(): 2}
        assert sorted(r["batch_id"] for r in pv.read().collect()) == [0, 1]
    finally:
        query.stop()
