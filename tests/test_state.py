"""Metrics kept in the state store: restarts, late rows, forgotten keys, audit."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daybook.functions.codec import parse_events
from daybook.operators import metrics
from daybook.schema import KAFKA_SCHEMA
from daybook.session import list_files, remove_dir
from daybook.sinks.archive import read_archive
from daybook.sinks.counts import FilterCounts
from daybook.sinks.daily import DailyIncrements
from daybook.sinks.totals import DailyTotals
from daybook.sinks.visitors import SeenVisitors
from daybook.sources import fixtures
from daybook.sources.kafka import kafka_rows
from daybook.streaming import state, stream
from test_stream import amounts, kafka_batch

LONG_AGO, SOON = dt.timedelta(0), dt.timedelta(days=2)


class Job:
    def __init__(self, spark, base, hold=SOON, name="one"):
        self.spark, self.base, self.hold, self.name = spark, base, hold, name
        self.pv, self.uv = DailyTotals(spark, f"{base}/pv"), DailyIncrements(spark, f"{base}/uv")
        self.seen, self.days = SeenVisitors(spark, f"{base}/seen"), state.StateDays(spark, f"{base}/days")

    def arrive(self, rows):
        rows.select(*KAFKA_SCHEMA.fieldNames()).write.mode("append").parquet(f"{self.base}/src")

    def run_pv(self):
        raw = stream.kafka_file_stream(self.spark, f"{self.base}/src")
        return stream.drain(state.start_pv_state_query(raw, self.pv, f"{self.base}/ck_pv_{self.name}", stream.NOW))

    def run_uv(self):
        raw = stream.kafka_file_stream(self.spark, f"{self.base}/src")
        return stream.drain(state.start_uv_state_query(raw, self.seen, self.uv, self.days, f"{self.base}/ck_uv_{self.name}",
                                                       stream.NOW, self.hold))


AT = dt.datetime(2024, 1, 10, 8, 0)


def test_page_views_go_on_after_a_restart_and_emit_changed_days_only(spark, workdir):
    job, later = Job(spark, workdir), dt.datetime(2024, 1, 11, 9, 0)
    job.arrive(kafka_batch(spark, [(AT, "a", "p"), (AT, "b", "p"), (AT, "b", None), (AT, "x", "p", dt.datetime(2024, 1, 2))]))
    job.run_pv()
    job.arrive(kafka_batch(spark, [(later, "a", "p"), (later, "c", "p", dt.datetime(2024, 1, 2, 7, 0)), (later, "b", None, AT)], 4))
    job.run_pv()
    d2, d10, d11 = dt.date(2024, 1, 2), AT.date(), later.date()
    assert amounts(job.pv) == {d2: 2, d10: 2, d11: 1}
    emitted = sorted((r["batch_id"], r["dt"], r["amount"]) for r in job.pv.read().collect())
    assert emitted == [(0, d2, 1), (0, d10, 2), (1, d2, 2), (1, d11, 1)]  # the tenth did not change
    held = {r["dt"]: r["amount"] for r in state.pv_state(spark, f"{workdir}/ck_pv_one").collect()}
    assert held == amounts(job.pv)


@pytest.mark.parametrize("hold", [SOON, LONG_AGO])
def test_visitors_count_once_whether_the_state_remembers_or_not(spark, workdir, hold):
    job, later = Job(spark, workdir, hold), dt.datetime(2024, 1, 11, 9, 0)
    job.arrive(kafka_batch(spark, [(AT, "hot", "p")] * 200 + [(AT, "b", None)]))
    job.run_uv()
    job.arrive(kafka_batch(spark, [(later, "hot", "p", AT)] * 50 + [(later, "hot", None), (later, "c", "p", AT), (AT, "d", None, dt.datetime(2024, 1, 1))], 201))
    job.run_uv()
    job.run_uv()
    assert amounts(job.uv) == {AT.date(): 3, later.date(): 1, dt.date(2024, 1, 1): 1}
    assert {r["dt"]: r["uv"] for r in job.seen.counts().collect()} == amounts(job.uv)


def test_days_the_state_has_whole_are_not_looked_up(spark, workdir, monkeypatch):
    job, looked = Job(spark, workdir), []
    real = SeenVisitors.add

    def add(self, visitors, run, batch_id, unseen_days=None, **k):
        looked.append(sorted(str(r["dt"]) for r in visitors.where(~F.col("dt").isin(unseen_days or [])).select("dt").distinct().collect()))
        return real(self, visitors, run, batch_id, unseen_days=unseen_days, **k)
    monkeypatch.setattr(SeenVisitors, "add", add)
    job.arrive(kafka_batch(spark, [(AT, "a", None)]))
    job.run_uv()
    job.arrive(kafka_batch(spark, [(AT, "a", None), (AT, "b", None)], 1))
    job.run_uv()
    assert [x for x in looked if x] == []
    # another checkpoint knows nothing of the day, so it asks the store
    job.name = "two"
    job.run_uv()
    assert [x for x in looked if x] == [["2024-01-10"]] and amounts(job.uv) == {AT.date(): 2}


def test_the_store_has_one_small_file_a_day_whatever_the_number_of_state_partitions(spark, workdir):
    job, later = Job(spark, workdir), dt.datetime(2024, 1, 11, 9, 0)
    for k in range(2):
        job.arrive(kafka_batch(spark, [(at, f"v{k}-{i}", None) for i in range(60) for at in (AT, later)], 120 * k))
        job.run_uv()
        # 60 visitors a day lie in all of the four state partitions
        assert [len(list_files(spark, f"{workdir}/seen/dt={d.date()}")) for d in (AT, later)] == [k + 1, k + 1]
    assert amounts(job.uv) == {AT.date(): 120, later.date(): 120}


def test_only_batches_with_rows_are_run(spark, workdir):
    job = Job(spark, workdir)
    for k in range(2):
        job.arrive(kafka_batch(spark, [(AT, f"v{k}", None)], k))
        job.run_uv()
    assert sorted(f for f in os.listdir(f"{workdir}/ck_uv_one/commits") if f[0] != ".") == ["0", "1"]
    assert spark.conf.get(state.NO_DATA_BATCHES, None) is None and amounts(job.uv) == {AT.date(): 2}


def test_the_plan_without_a_lookup_reads_no_store(spark, workdir):
    seen = SeenVisitors(spark, f"{workdir}/seen")
    day = AT.date()
    batch = spark.createDataFrame([(day, "a")], "dt date, unionid string")
    seen.add(batch, "r", 0)
    plans = []
    real = SeenVisitors._of_days
    seen._of_days = lambda days: plans.append(days) or real(seen, days)
    assert [tuple(r) for r in seen.add(spark.createDataFrame([(day, "b")], "dt date, unionid string"), "r", 1, unseen_days=[day]).collect()] == [(day, 1)]
    assert plans == [[day]]  # once, to count what the batch brought


def test_a_batch_lost_after_the_store_was_written_is_replayed(spark, workdir):
    job, run = Job(spark, workdir), stream.StreamRun("r", None)
    batch = spark.createDataFrame([(AT.date(), "a"), (AT.date(), "b")], "dt date, unionid string")
    for lost in (True, False):
        state.add_unseen(batch, job.days, job.seen, job.uv, run, 0, SOON)
        if lost:
            remove_dir(spark, f"{workdir}/uv/batches/run=r/batch_id=0")
    assert amounts(job.uv) == {AT.date(): 2}


def test_state_equals_the_stored_totals_on_the_events(spark, events, workdir):
    job = Job(spark, workdir)
    for k in range(2):
        job.arrive(fixtures.kafka_events(events, late=True).where(F.col("offset") % 2 == k))
        job.run_pv()
        job.run_uv()
    held = {r["dt"]: r["amount"] for r in state.uv_state(spark, f"{workdir}/ck_uv_one").collect()}
    assert held == amounts(job.uv) == {r["dt"]: r["uv"] for r in job.seen.counts().collect()}
    assert {r["dt"]: r["amount"] for r in state.pv_state(spark, f"{workdir}/ck_pv_one").collect()} == amounts(job.pv)
    meta = spark.read.format("state-metadata").load(f"{workdir}/ck_uv_one").first()
    assert meta["operatorName"] == "dedupeWithinWatermark"


def test_repeats_shrink_before_the_shuffle(spark):
    rows = spark.range(0, 50000, 1, 2).select(F.lit(AT.date()).alias("dt"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("unionid"))
    out = state.thinned(rows)
    assert out.distinct().count() == rows.distinct().count() and out.where("unionid = 'hot'").count() < 20


def test_counts_around_the_lookup_cost_no_job(spark, events, workdir):
    flat = parse_events(fixtures.wire_events(events), keep=["batch"])
    seen, uv, counts = SeenVisitors(spark, f"{workdir}/seen"), DailyIncrements(spark, f"{workdir}/uv"), FilterCounts(spark, f"{workdir}/counts")
    assert counts.read().count() == 0
    for b in range(fixtures.N_BATCHES):
        stream.add_visitors(flat.where(F.col("batch") == b), seen, uv, stream.StreamRun("r", None), b, counts)
    stream.add_visitors(flat.limit(0), seen, uv, stream.StreamRun("r", None), 9, counts)
    got = {r["batch_id"]: (r["before_n"], r["after_n"]) for r in counts.read().collect()}
    assert got.pop(9) == (0, 0)
    assert got == {r["batch"]: (r["before_n"], r["after_n"]) for r in metrics.filter_counts(flat).collect()}
    assert amounts(uv) == {r["dt"]: r["uv"] for r in metrics.uv_daily(flat).collect()}


def test_the_archive_stream_goes_on_and_its_log_hides_failed_files(spark, workdir):
    src, out = f"{workdir}/src", f"{workdir}/archive"
    def run():
        stream.drain(stream.start_archive_query(stream.kafka_file_stream(spark, src), out, f"{workdir}/ck", stream.NOW))
    kafka_batch(spark, [(AT, "a", "p")]).write.mode("append").parquet(src)
    run()
    # a file that no finished batch has named
    spark.createDataFrame([("left over",)], "value string").write.mode("append").text(f"{out}/dt=2024-01-10")
    kafka_batch(spark, [(AT, "b", None), (dt.datetime(2024, 1, 11), "c", None)], 1).write.mode("append").parquet(src)
    bad = spark.createDataFrame([("not json", "t", 0, 9, AT)], KAFKA_SCHEMA)
    bad.write.mode("append").parquet(src)
    run()
    run()
    rows = read_archive(spark, out).collect()
    assert sorted((str(r["dt"]), r["value"].split(";")[10]) for r in rows) == [("2024-01-10", "a"), ("2024-01-10", "b"), ("2024-01-11", "c")]


def test_pruned_and_whole_checks_agree(spark):
    from daybook.operators.quality import parse_checked
    good = '{"dataType":"visit","reportTime":"2024-01-01 10:00:00","data":{"wxInfo":{"unionid":"u"},"visitData":{"pageUrl":"p"}}}'
    docs = [good, good[:-1], good[:40], "", None, "[]", "5", '{"data":5}', '{"data":{"wxInfo":"text"}}', '{"data":{"userInfo":[1]}}',
            '{"data":{"visitData":7}}', '{"data":{"loginData":"x"}}', '{"data":{"addrInfo":{"latitude":"x"}}}', '{"data":{"addrInfo":{"longitude":"1.5"}}}',
            '{"data":{"loginData":{"succeed":"1"}}}', '{"data":{"loginData":{"firstLogin":"TRUE"}}}', '{"data":{"wxInfo":{"openid":{"a":1}}}}',
            '{"data":{"visitData":{"modelId":3,"pageUrl":"q"}}}', '{"extra":[1,2],"data":null}', '{"data":{"userInfo":{"userid":true}}} trailing']
    raw = kafka_rows(spark.createDataFrame([(d, "t", 0, i, AT) for i, d in enumerate(docs)], KAFKA_SCHEMA))

    def rows(columns):
        return {r["offset"]: (r["reason"], r["dt"], r["unionid"], r["pageUrl"])
                for r in parse_checked(raw, keep=["offset"], columns=columns).collect()}
    assert rows(["unionid", "pageUrl"]) == rows(None)
    assert {r for r, *_ in rows(None).values()} == {None, "empty", "malformed", "bad_number", "bad_boolean"}
