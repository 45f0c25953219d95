"""Sinks and the offset ledger: idempotence, last-wins, read-back."""

import datetime as dt
import json

from pyspark.sql import functions as F

from daybook.functions.codec import parse_events
from daybook.sinks.archive import archive_lines, read_archive, write_archive
from daybook.sinks.daily import DailyIncrements
from daybook.sinks.visitors import SeenVisitors
from daybook.sources import fixtures
from daybook.sources.kafka import kafka_options
from daybook.sources.ledger import OffsetLedger
from daybook.streaming.run import StreamRun

RUN = StreamRun("r", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_increments_add_up_and_replace_their_own_batch(spark, workdir):
    pv = DailyIncrements(spark, f"{workdir}/pv")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)

    def deltas(*rows):
        return spark.createDataFrame(list(rows), "dt date, n long")
    assert pv.amounts().collect() == []
    pv.write(deltas((D1, 5), (D2, 7)), "a", 0, F.lit(t1))
    pv.write(deltas((D2, 2)), "a", 1, F.lit(t2))
    pv.write(deltas((D2, 2)), "a", 1, F.lit(t2))
    pv.write(deltas(), "a", 2)
    pv.write(deltas((D1, 1)), "b", 0, F.lit(t2))
    got = {r["dt"]: tuple(r)[1:] for r in pv.totals().collect()}
    assert got == {D1: (6, t1, t2), D2: (9, t1, t2)}
    assert sorted(tuple(r) for r in pv.running("a").collect()) == [(0, D1, 5), (0, D2, 7), (1, D2, 9)]


def test_seen_visitors_add_is_idempotent(spark, workdir):
    store = SeenVisitors(spark, f"{workdir}/seen")
    b1 = spark.createDataFrame([(D1, "a"), (D1, "a"), (D1, "b"), (D2, "a")], "dt date, unionid string")
    for _ in range(2):
        assert {r["dt"]: r["n"] for r in store.add(b1, "r", 0).collect()} == {D1: 2, D2: 1}
    b2 = spark.createDataFrame([(D1, "a"), (D1, "c"), (D2, None)], "dt date, unionid string")
    assert {r["dt"]: r["n"] for r in store.add(b2, "r", 1).collect()} == {D1: 1}
    assert store.compact(D2) == ["2024-01-01"]
    assert {r["dt"]: r["n"] for r in store.add(b2, "r", 1).collect()} == {D1: 1}  # replayed after a compaction
    assert sorted(tuple(r) for r in store.visitors().collect()) == \
        [(D1, "a"), (D1, "b"), (D1, "c"), (D2, "a")]
    assert {r["dt"]: r["uv"] for r in store.counts().collect()} == {D1: 3, D2: 1}


def test_many_days_take_the_unpruned_way(spark, workdir, monkeypatch):
    from daybook.sinks import visitors
    monkeypatch.setattr(visitors, "MAX_LISTED_DAYS", 1)
    store = SeenVisitors(spark, f"{workdir}/seen")
    b = spark.createDataFrame([(D1, "a"), (D2, "a"), (D2, "b")], "dt date, unionid string")
    assert {r["dt"]: r["n"] for r in store.add(b, "r", 0).collect()} == {D1: 1, D2: 2}
    assert store.add(b, "r", 1).collect() == []


def test_archive_roundtrip_and_partition_pruning(spark, events, workdir):
    raw = fixtures.wire_events(events)
    flat = parse_events(raw, keep=["ingest_ts"], ingest_ts=None)
    path = f"{workdir}/archive"
    write_archive(archive_lines(flat), path, "r")
    arch = read_archive(spark, path)
    assert arch.count() == events.count()
    one_day = arch.where(F.col("dt") == D1)
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert all(len(r["value"].split(";")) == 22 for r in one_day.collect())
    legacy = archive_lines(flat, legacy_suffix=True).first()["value"]
    assert legacy.endswith(", ")


def test_ledger_last_wins_and_starting_offsets(spark, workdir):
    ledger = OffsetLedger(spark, f"{workdir}/ledger", "m", "g")
    rows = spark.createDataFrame(
        [("t", 0, 5), ("t", 0, 9), ("t", 1, 3), ("u", 0, 1)], "topic string, partition int, offset long")
    ledger.record(rows, RUN, batch_id=1)
    ledger.record(spark.createDataFrame([("t", 0, 12)], "topic string, partition int, offset long"),
                  RUN, batch_id=2)
    ledger.record(spark.createDataFrame([], "topic string, partition int, offset long"), RUN, batch_id=3)
    cur = {(r["topic"], r["partition"]): r["until_offset"] for r in ledger.current().collect()}
    assert cur == {("t", 0): 13, ("t", 1): 4, ("u", 0): 2}
    js = json.loads(ledger.starting_offsets().first()["starting_offsets"])
    assert js == {"t": {"0": 13, "1": 4}, "u": {"0": 2}}
    # recording batch 2 again changes nothing
    ledger.record(spark.createDataFrame([("t", 0, 12)], "topic string, partition int, offset long"),
                  RUN, batch_id=2)
    assert ledger.current().where("topic = 't' and partition = 0").first()["until_offset"] == 13


def test_kafka_options():
    o = kafka_options("b:9092", ["a", "b"], max_offsets_per_trigger=1000)
    assert o["subscribe"] == "a,b" and o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "1000" and "kafka.bootstrap.servers" in o
    assert kafka_options("b", "a", starting_offsets='{"a":{"0":5}}')["startingOffsets"] == '{"a":{"0":5}}'


def test_legacy_lines_written_by_day(spark, events, workdir):
    from daybook.operators.legacy import legacy_records
    from daybook.sinks.archive import write_legacy_lines
    rec = legacy_records(fixtures.legacy_events(events))
    for _ in range(2):  # a rerun replaces its lines
        write_legacy_lines(rec, f"{workdir}/legacy", "r", day="2024-01-05")
    back = read_archive(spark, f"{workdir}/legacy")
    assert back.count() == rec.where("status = 'ok'").count()
    assert {r["dt"] for r in back.select("dt").distinct().collect()} == {dt.date(2024, 1, 5)}


def test_starting_offsets_fill_unseen_partitions(spark, workdir):
    ledger = OffsetLedger(spark, f"{workdir}/ledger", "m", "g")
    ledger.record(spark.createDataFrame([("t", 1, 7)], "topic string, partition int, offset long"),
                  RUN, batch_id=0)
    js = json.loads(ledger.starting_offsets({"t": 3, "v": 1}).first()["starting_offsets"])
    assert js == {"t": {"0": -1, "1": 8, "2": -1}, "v": {"0": -1}}


def test_seen_visitors_expire(spark, workdir):
    store = SeenVisitors(spark, f"{workdir}/seen")
    store.add(spark.createDataFrame([(D1, "a"), (D2, "b")], "dt date, unionid string"), "r", 0)
    assert store.expire(D2) == ["2024-01-01"]
    assert [tuple(r) for r in store.visitors().collect()] == [(D2, "b")]


def test_ledger_orders_by_run_then_batch_and_compacts(spark, workdir):
    schema = "topic string, partition int, offset long"
    ledger, other = OffsetLedger(spark, f"{workdir}/ledger", "m", "g"), OffsetLedger(spark, f"{workdir}/ledger", "m", "o")
    later = StreamRun("s", RUN.started + dt.timedelta(days=1))
    ledger.record(spark.createDataFrame([("t", 0, 100)], schema), RUN, batch_id=500)
    other.record(spark.createDataFrame([("t", 0, 7)], schema), RUN, batch_id=0)
    for b, offset in enumerate((200, 300)):  # a new checkpoint begins at batch 0
        ledger.record(spark.createDataFrame([("t", 0, offset)], schema), later, batch_id=b)
    for _ in range(2):
        assert ledger.current().first()["until_offset"] == 301 and other.current().first()["until_offset"] == 8
        ledger.compact()
    assert ledger.log().count() == 2


def test_cluster_sessions_need_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace
    import pytest
    from daybook import session
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(ValueError):
        session.shared_dir(fake)


def test_only_folders_of_finished_applications_are_swept(spark, workdir):
    from daybook import session
    for app in ("app-1", "app-2"):
        spark.range(1).write.parquet(f"{workdir}/q/{app}/one")
    spark.range(1).write.parquet(f"{workdir}/{session.RUNNING}/app-2")
    session.sweep(spark, workdir)
    assert session.path_exists(spark, f"{workdir}/q/app-1/one")  # finished, but young
    session.sweep(spark, workdir, hours=-1)
    assert not session.path_exists(spark, f"{workdir}/q/app-1")
    assert session.path_exists(spark, f"{workdir}/q/app-2/one") and session.path_exists(spark, f"{workdir}/{session.RUNNING}/app-2")


def test_an_application_is_marked_while_it_runs(spark):
    from daybook import session
    app = spark.sparkContext.applicationId
    at = session.run_dir(spark, "marked")
    base = f"{session.shared_dir(spark)}/daybook"
    assert at.startswith(f"{base}/marked/{app}/") and session.path_exists(spark, f"{base}/{session.RUNNING}/{app}")
    session.finish(spark)
    assert not session.path_exists(spark, f"{base}/{session.RUNNING}/{app}")
    session.run_dir(spark, "marked")
    assert session.path_exists(spark, f"{base}/{session.RUNNING}/{app}")


def test_a_fold_is_one_file(spark, workdir):
    pv = DailyIncrements(spark, f"{workdir}/pv")
    for b in range(3):
        pv.write(spark.createDataFrame([(D1, 1), (D2, 1)], "dt date, n long").repartition(4), "a", b)
    pv.fold("a")
    import glob
    assert len(glob.glob(f"{workdir}/pv/folded/run=a/*.parquet")) == 1
    assert {r["dt"]: r["amount"] for r in pv.amounts().collect()} == {D1: 3, D2: 3}


SCHEMA = "topic string, partition int, offset long"


def test_the_run_that_wrote_last_wins(spark, workdir):
    ledger = OffsetLedger(spark, f"{workdir}/ledger", "m", "g")
    b = StreamRun("b", RUN.started + dt.timedelta(days=9))
    hour = lambda h: F.lit(RUN.started + dt.timedelta(hours=h))

    def until():
        return ledger.current().first()["until_offset"]
    for h, (run, batch, offset) in enumerate([(RUN, 7, 100), (b, 0, 200), (RUN, 8, 300)]):
        ledger.record(spark.createDataFrame([("t", 0, offset)], SCHEMA), run, batch, now=hour(h))
        assert until() == offset + 1
    ledger.record(spark.createDataFrame([("t", 0, 100)], SCHEMA), RUN, 7, now=hour(4))  # an old batch told again
    assert until() == 301
    ledger.compact()
    assert until() == 301
    ledger.record(spark.createDataFrame([("t", 0, 250)], SCHEMA), b, 1, now=hour(5))
    assert until() == 251


def progress(batch, start, end, rows=5):
    """What a Kafka query reports, as its JSON has it."""
    return json.dumps({
        "id": "q1", "runId": "r1", "name": "events", "timestamp": "2024-01-01T00:00:00.000Z", "batchId": batch, "numInputRows": rows,
        "sources": [{"description": "KafkaV2[Subscribe[t]]", "startOffset": start, "endOffset": end, "latestOffset": end, "numInputRows": rows},
                    {"description": "FileStreamSource[file:/x]", "startOffset": {"logOffset": 0}, "endOffset": {"logOffset": 1}, "numInputRows": 0}],
        "sink": {"description": "ForeachBatchSink", "numOutputRows": -1}})


def test_offsets_from_progress_reach_past_the_last_row(spark, workdir):
    from daybook.sources.ledger import LedgerListener, progress_ranges
    ledger = OffsetLedger(spark, f"{workdir}/ledger", "m", "g")
    run = StreamRun("q1", RUN.started)
    assert progress_ranges(progress(0, None, {"t": {"0": 12, "1": 3}})) == [("t", 0, None, 12), ("t", 1, None, 3)]
    assert progress_ranges(progress(0, '{"t":{"0":2}}', '{"t":{"0":12}}')) == [("t", 0, 2, 12)]
    # the last rows of the range have been compacted away: offsets 9 to 11 hold none
    ledger.record(spark.createDataFrame([("t", 0, 8), ("t", 1, 2)], SCHEMA), run, 0)
    assert {r["partition"]: r["until_offset"] for r in ledger.current().collect()} == {0: 9, 1: 3}
    ledger.record_progress(progress(0, None, {"t": {"0": 12, "1": 3}}))
    assert {r["partition"]: r["until_offset"] for r in ledger.current().collect()} == {0: 12, 1: 3}
    ledger.record_progress(progress(1, {"t": {"0": 12, "1": 3}}, {"t": {"0": 12, "1": 3}}, rows=0))
    assert ledger.log().count() == 4
    from types import SimpleNamespace
    listener = LedgerListener(ledger, "q1")
    for query in ("q1", "other"):
        listener.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(id=query, json=progress(2, {"t": {"0": 12}}, {"t": {"0": 20, "2": 4}}))))
    assert {r["partition"]: r["until_offset"] for r in ledger.current().collect()} == {0: 20, 1: 3, 2: 4}
    assert ledger.log().count() == 6
    assert json.loads(ledger.starting_offsets().first()["starting_offsets"]) == {"t": {"0": 20, "1": 3, "2": 4}}


def test_compressed_archives_read_alike(spark, workdir):
    import glob
    lines = spark.createDataFrame([(D1, "a;b"), (D2, "c;d")], "dt date, value string")
    write_archive(lines, f"{workdir}/archive", "r", codec="gzip")
    assert glob.glob(f"{workdir}/archive/dt=2024-01-01/*/*/*.txt.gz")
    assert sorted((r["dt"], r["value"]) for r in read_archive(spark, f"{workdir}/archive").collect()) == [(D1, "a;b"), (D2, "c;d")]


def test_a_quiet_day_expires_and_an_active_one_stays(spark, workdir):
    store = SeenVisitors(spark, f"{workdir}/seen", ttl=dt.timedelta(days=2))
    day = lambda n: F.lit(dt.datetime(2024, 1, n, 12))

    def add(batch, now, *rows):
        got = {r["dt"]: r["n"] for r in store.add(spark.createDataFrame(list(rows), "dt date, unionid string"), "r", batch, now=now).collect()}
        return got, sorted({r["dt"] for r in store.visitors().collect()})
    assert add(0, day(1), (D1, "a"), (D2, "a")) == ({D1: 1, D2: 1}, [D1, D2])
    assert add(1, day(2), (D1, "b")) == ({D1: 1}, [D1, D2])
    # D2 is quiet since the first, D1 since the second; a known visitor is no addition
    assert add(2, day(4), (D1, "a"), (dt.date(2024, 1, 4), "a")) == ({dt.date(2024, 1, 4): 1}, [D1, dt.date(2024, 1, 4)])
    assert store.expire_quiet(day(5)) == ["2024-01-01"]
    assert add(3, day(5), (D1, "a")) == ({D1: 1}, [D1, dt.date(2024, 1, 4)])  # counts again, and opens the day anew
    assert store.expire_quiet(day(6)) == []


def test_daily_totals_overwrite_and_runs_add_up(spark, workdir):
    from daybook.sinks.totals import DailyTotals
    totals = DailyTotals(spark, f"{workdir}/pv")
    assert totals.amounts().collect() == []
    frame = lambda *rows: spark.createDataFrame(list(rows), "dt date, amount long")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3)
    totals.write(frame((D1, 5), (D2, 2)), "a", 0, F.lit(t1))
    totals.write(frame((D1, 9)), "a", 1, F.lit(t2))
    totals.write(frame((D1, 9)), "a", 1, F.lit(t2))  # replayed
    totals.write(frame((D2, 1)), "b", 0, F.lit(t2))
    assert {r["dt"]: tuple(r)[1:] for r in totals.totals().collect()} == {D1: (9, t2, t2), D2: (3, t2, t2)}
    assert totals.read().count() == 4


def test_the_bucketed_store_is_read_without_a_shuffle(spark, workdir):
    from daybook.sinks.bucketed import BucketedVisitors
    rows = lambda *r: spark.createDataFrame(list(r), "dt date, unionid string")
    store = BucketedVisitors(spark, f"{workdir}/seen", buckets=4)
    for _ in range(2):
        got = store.add(rows((D1, "a"), (D1, "a"), (D1, "b"), (D2, "a")), "r", 0).collect()
        assert {r["dt"]: r["n"] for r in got} == {D1: 2, D2: 1}
    assert {r["dt"]: r["n"] for r in store.add(rows((D1, "a"), (D1, "c"), (D2, None)), "r", 1).collect()} == {D1: 1}
    plan = store._not_stored(rows((D1, "z")).dropDuplicates(), [D1])._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    known = plan[plan.index("_known", join + 200):]
    right = plan[plan.rindex("Sort [_known"):]
    assert "Exchange" not in right and "Bucketed: true" in right and "PartitionFilters: [" in right and known
    spark.sql(f"DROP TABLE {store.table}")  # another session finds the days again
    again = BucketedVisitors(spark, f"{workdir}/seen", buckets=4)
    assert {r["dt"]: r["uv"] for r in again.counts().collect()} == {D1: 3, D2: 1}
    assert again.compact("2024-01-02") == ["2024-01-01"]
    assert again.add(rows((D1, "c"), (D2, "b")), "r", 2).collect() == [(D2, 1)]
    assert again.expire(D2) == ["2024-01-01"]
    assert {r["dt"]: r["uv"] for r in again.counts().collect()} == {D2: 2}
    assert again.add(rows((D1, "a")), "r", 3).collect() == [(D1, 1)]


def test_merged_days_and_runs_hold_the_same_rows(spark, workdir):
    import glob
    from daybook.sinks.daily import write_batch
    from daybook.sinks import merge
    path, out = f"{workdir}/archive", f"{workdir}/outbox"
    for b in range(3):
        write_archive(spark.createDataFrame([(D1, f"a{b}"), (D2, f"b{b}")], "dt date, value string").repartition(2), path, "r", b)
        write_batch(spark.createDataFrame([(b, "x")], "offset long, body string"), out, "r", b)
    lines = lambda: sorted((r["dt"], r["value"]) for r in read_archive(spark, path).collect())
    before = lines()
    assert merge.merge_days(spark, path, D2) == ["2024-01-01"] and lines() == before
    assert len(glob.glob(f"{path}/dt=2024-01-01/*/*/part-*")) == 1
    assert merge.merge_days(spark, path, D2) == []
    # a crash after the old files went: the merged ones are taken from beside
    spark.createDataFrame([(f"b{b}",) for b in range(3)], "value string").write.text(f"{path}/{merge.MERGING}/dt=2024-01-02")
    from daybook.session import remove_dir
    remove_dir(spark, f"{path}/dt=2024-01-02")
    assert merge.merge_days(spark, path, "2024-01-03") == ["2024-01-02"] and lines() == before
    # a crash while writing beside: no success mark, so it begins anew
    write_archive(spark.createDataFrame([(D1, "late")], "dt date, value string"), path, "s", 0)
    spark.createDataFrame([("half",)], "value string").write.text(f"{path}/{merge.MERGING}/dt=2024-01-01")
    remove_dir(spark, f"{path}/{merge.MERGING}/dt=2024-01-01/_SUCCESS")
    assert merge.merge_days(spark, path, D2) == ["2024-01-01"] and lines() == sorted([*before, (D1, "late")])
    assert merge.merge_run(spark, out, "r") and not merge.merge_run(spark, out, "r")
    assert sorted((r["offset"], r["run"]) for r in spark.read.parquet(out).collect()) == [(0, "r"), (1, "r"), (2, "r")]
