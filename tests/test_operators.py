"""Identity, metrics and legacy operators against brute force on sf0.001."""

import collections

from pyspark.sql import functions as F

from daybook.functions.codec import parse_events
from daybook.operators import identity, legacy, metrics
from daybook.sources import fixtures


def flat_rows(spark, events):
    flat = parse_events(fixtures.wire_events(events), keep=["event_id", "batch"])
    return flat, flat.collect()


def test_pv_uv_match_brute_force(spark, events):
    flat, rows = flat_rows(spark, events)
    pv = collections.Counter(r["dt"] for r in rows if r["pageUrl"] is not None)
    uv_sets = collections.defaultdict(set)
    obs = collections.defaultdict(set)
    for r in rows:
        if r["unionid"] is not None:
            uv_sets[r["dt"]].add(r["unionid"])
            obs[(r["dt"], r["batch"])].add(r["unionid"])
    uv = {d: len(s) for d, s in uv_sets.items()}
    observed = collections.Counter()
    for (d, _), s in obs.items():
        observed[d] += len(s)
    assert {r["dt"]: r["pv"] for r in metrics.pv_daily(flat).collect()} == dict(pv)
    assert {r["dt"]: r["uv"] for r in metrics.uv_daily(flat).collect()} == uv
    assert {r["dt"]: r["uv"] for r in metrics.uv_daily_observed(flat).collect()} == dict(observed)


def test_new_visitors_and_filter_counts(spark, events):
    flat, rows = flat_rows(spark, events)
    seen = collections.defaultdict(set)
    before, after, new3 = collections.Counter(), collections.Counter(), set()
    for b in range(4):
        batch = [r for r in rows if r["batch"] == b and r["unionid"] is not None]
        for r in batch:
            before[b] += 1
            if r["unionid"] not in seen[r["dt"]]:
                after[b] += 1
                if b == 3:
                    new3.add((r["dt"], r["unionid"]))
        for r in batch:
            seen[r["dt"]].add(r["unionid"])
    got = {(r["dt"], r["unionid"]) for r in metrics.new_visitors_in(flat, 3).collect()}
    assert got == new3
    fc = {r["batch"]: (r["before_n"], r["after_n"]) for r in metrics.filter_counts(flat).collect()}
    assert fc == {b: (before[b], after[b]) for b in range(4)}


def test_hot_visitor_does_not_change_results(spark):
    # one visitor holds most rows: results stay exact
    docs = [('{"dataType":"visit","reportTime":"2024-01-01 10:00:00","data":{"wxInfo":'
             '{"unionid":"hot"},"visitData":{"pageUrl":"p"}}}', i % 4) for i in range(300)]
    docs += [('{"dataType":"visit","reportTime":"2024-01-01 11:00:00","data":{"wxInfo":'
              '{"unionid":"u%d"}}}' % i, i % 4) for i in range(10)]
    flat = parse_events(spark.createDataFrame(docs, "value string, batch long"), keep=["batch"],
                        ingest_ts=None)
    assert metrics.uv_daily(flat).first()["uv"] == 11
    assert metrics.pv_daily(flat).first()["pv"] == 300
    assert metrics.uv_daily_observed(flat).first()["uv"] == 4 + 10


def test_identity_rules(spark):
    docs = [
        '{"dataType":"auth","data":{"wxInfo":{"unionid":"u","openid":"o"},'
        '"userInfo":{"userid":"i","phoneNo":"p"}}}',
        '{"dataType":"auth","data":{"wxInfo":{"openid":"o"}}}',
        '{"dataType":"login","data":{"wxInfo":{"unionid":"u","openid":"o"},'
        '"userInfo":{"userid":" ","phoneNo":"p"}}}',
        '{"dataType":"login","data":{"wxInfo":{"openid":"o"}}}',
        '{"dataType":"visit","data":{"wxInfo":{"unionid":"u"}}}',
    ]
    flat = parse_events(spark.createDataFrame([(i, d) for i, d in enumerate(docs)],
                                              "event_id long, value string"),
                        keep=["event_id"], ingest_ts=None)
    doc = {r["event_id"] for r in identity.identity_eligible(flat).collect()}
    obs = {r["event_id"] for r in identity.identity_eligible(flat, "observed").collect()}
    assert doc == {0}
    assert obs == {0, 1, 3}
    bodies = {r["event_id"]: r["body"] for r in
              identity.identity_outbox(flat, "observed", keep=["event_id"]).collect()}
    assert bodies[0] == '{"unionId":"u","openId":"o"}'
    assert bodies[1] == '{"unionId":"\\\\N","openId":"o"}'
    plain = flat.where("event_id = 1").select(identity.identity_body().alias("body")).first()["body"]
    assert plain == '{"openId":"o"}'


def test_reply_audit(spark):
    replies = spark.createDataFrame(
        [('{"code":200,"status":"ok","msg":"","data":{"a":1}}',), ('{"code":500}',), ("",),
         (None,), ("<html>",), ('{"code":200,"data":null}',)], "reply string")
    got = {r["code"]: r["n"] for r in identity.reply_audit(replies).collect()}
    assert got == {200: 2, 500: 1, None: 3}


def test_legacy_edges(spark):
    wx = ('"wxInfo":{"openid":"a","nickname":"b","gender":%s,"city":"","country":"c",'
          '"province":"p","language":"l","subscribeTime":"1","unionid":%s}')
    auth_tail = ',"addrInfo":{"latitude":"2.5","longitude":3},"userInfo":{"userid":"x","phoneNo":"y"}'
    docs = [
        '{"dataType":"授权","data":{' + wx % ('"1"', '"u"') + auth_tail + '}}',    # ok
        '{"dataType":"授权","data":{' + wx % ('1', '"u"') + auth_tail + '}}',      # numeric gender
        '{"dataType":"授权","data":{' + wx % ('"1"', 'null') + auth_tail + '}}',   # JSON null
        '{"dataType":"授权","data":{' + wx % ('"1"', '"u"') + '}}',               # missing block
        '{"dataType":"其他","data":{}}',                                            # unknown label
        '{"dataType":"授权","charset":"UTF-8"}',                                    # guard
        '{"data":{}}',                                                              # no label
        'not json',
    ]
    raw = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "event_id long, value string")
    got = {r["event_id"]: (r["status"], r["line"]) for r in
           legacy.legacy_records(raw, keep=["event_id"]).collect()}
    assert got[0] == ("ok", "a,b,1,,c,p,l,1,u,2.5,3.0,x,y")
    assert [got[i][0] for i in range(1, 8)] == ["bad", "bad", "bad", "unknown", "guard", "bad", "guard"]
    no_guard = {r["event_id"]: r["status"] for r in
                legacy.legacy_records(raw, keep=["event_id"], guard=False).collect()}
    assert no_guard[5] == "bad" and no_guard[7] == "bad"
    labels = {r["label"]: r["dataType"] for r in legacy.label_counts(raw).collect()}
    assert labels["授权"] == "auth" and labels["其他"] is None
