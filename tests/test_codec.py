"""Parsing, quarantine routing, encoding and decoding on edge rows."""

import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from daybook.functions.codec import decode_line, encode_line, parse_events, read_lines
from daybook.operators.quality import bad_rows, good_rows, parse_checked
from daybook.schema import FLAT_COLUMNS, FLAT_SCHEMA

INGEST = dt.datetime(2024, 2, 1, 12, 0, 0)

WX = ('"wxInfo":{"openid":"o1","nickname":"n","gender":1,"subscribeTime":1700000000000,'
      '"unionid":"u1"}')


def checked(spark, values):
    rows = [(i, v, INGEST) for i, v in enumerate(values)]
    raw = spark.createDataFrame(rows, "id long, value string, ingest_ts timestamp")
    return {r["id"]: r for r in parse_checked(raw, keep=["id"]).collect()}


def test_good_rows_and_coercion(spark):
    docs = [
        # 0 the invented example of the fixtures doc
        '{"dataType":"visit","reportTime":"2024-01-01 10:00:00","data":{' + WX +
        ',"visitData":{"pageUrl":"page/1","pageParam":"","pageType":"t"}}}',
        # 1 missing blocks, data null
        '{"dataType":"auth","data":null}',
        # 2 numeric text in a double, boolean text in a boolean
        '{"dataType":"login","data":{"addrInfo":{"latitude":"2.5","longitude":3},'
        '"loginData":{"succeed":"true","firstLogin":false}}}',
        # 3 unknown key ignored, duplicate key last wins, text after the object
        '{"dataType":"x","extra":1,"dataType":"visit","data":{}} trailing',
        # 4 wrong-case key: dataType NULL
        '{"datatype":"visit","data":{}}',
        # 5 whitespace-only string is kept, '' is NULL
        '{"dataType":"login","data":{"userInfo":{"userid":"  ","phoneNo":""}}}',
    ]
    out = checked(spark, docs)
    assert all(r["reason"] is None for r in out.values())
    r = out[0]
    assert (r["dataType"], r["openid"], r["gender"], r["subscribeTime"]) == \
        ("visit", "o1", "1", "1700000000000")
    assert r["pageUrl"] == "page/1" and r["pageParam"] is None and r["pageType"] == "t"
    assert r["dt"] == dt.date(2024, 1, 1)
    assert out[1]["dataType"] == "auth" and out[1]["openid"] is None
    assert out[2]["latitude"] == 2.5 and out[2]["longitude"] == 3.0
    assert out[2]["succeed"] is True and out[2]["firstLogin"] is False
    assert out[3]["dataType"] == "visit"
    assert out[4]["dataType"] is None
    assert out[5]["userid"] == "  " and out[5]["phoneNo"] is None
    # no reportTime: the day comes from the arrival time
    assert out[1]["dt"] == INGEST.date()


def test_bad_rows_are_quarantined(spark):
    docs = ["not json", "null", "[1]", '{"dataType":"a","data":"str"}', "", None,
            '{"dataType":"auth","data":{"addrInfo":{"latitude":"x"}}}',
            '{"dataType":"login","data":{"loginData":{"succeed":"maybe"}}}']
    out = checked(spark, docs)
    reasons = [out[i]["reason"] for i in range(len(docs))]
    assert reasons == ["malformed", "malformed", "malformed", "malformed", "empty", "empty",
                       "bad_number", "bad_boolean"]


def test_split_keeps_every_row(spark):
    raw = spark.createDataFrame([("{}", INGEST), ("nope", INGEST), ('{"data":{}}', INGEST)],
                                "value string, ingest_ts timestamp")
    c = parse_checked(raw)
    assert good_rows(c).count() + bad_rows(c).count() == 3
    assert bad_rows(c).columns == ["value", "reason", "ingest_ts"]


def test_encode_fixture_example(spark):
    doc = ('{"dataType":"visit","reportTime":"2024-01-01 10:00:00","data":{' + WX +
           ',"visitData":{"pageUrl":"page/1","pageParam":"","pageType":"t"}}}')
    flat = parse_events(spark.createDataFrame([(doc,)], "value string"), ingest_ts=None)
    line = flat.select(encode_line(flat).alias("l")).first()["l"]
    assert line == ("visit;2024-01-01 10:00:00;o1;n;1;\\N;\\N;\\N;\\N;1700000000000;u1;"
                    "\\N;\\N;\\N;\\N;\\N;\\N;page/1;\\N;t;\\N;\\N")
    assert len(line.split(";")) == 22


def test_encode_sanitizes_separators(spark):
    doc = '{"dataType":"visit","data":{"wxInfo":{"nickname":"a;b\\nc"}}}'
    flat = parse_events(spark.createDataFrame([(doc,)], "value string"), ingest_ts=None)
    clean = flat.select(encode_line(flat).alias("l")).first()["l"]
    raw = flat.select(encode_line(flat, clean=False).alias("l")).first()["l"]
    assert clean.split(";")[3] == "a b c" and len(clean.split(";")) == 22
    assert len(raw.split(";")) == 23


def test_double_text_matches_java(spark):
    df = spark.createDataFrame([(1.23456789e7, 1.0e-5)], "latitude double, longitude double")
    row = df.select(F.col("latitude").cast("string"), F.col("longitude").cast("string")).first()
    assert tuple(row) == ("1.23456789E7", "1.0E-5")


text = st.text(alphabet=st.characters(blacklist_characters=";\r\n\\",
                                      blacklist_categories=("Cs",)), min_size=1, max_size=8)
row_strategy = st.fixed_dictionaries({
    c: (st.none() | st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)
        if c in ("latitude", "longitude") else
        st.none() | st.booleans() if c in ("succeed", "firstLogin") else
        st.none() | text)
    for c in FLAT_COLUMNS})


@settings(max_examples=5, deadline=None)
@given(st.lists(row_strategy, min_size=1, max_size=40))
def test_decode_inverts_encode(spark, rows):
    df = spark.createDataFrame([tuple(r[c] for c in FLAT_COLUMNS) for r in rows], FLAT_SCHEMA)
    lines = df.select(F.monotonically_increasing_id().alias("k"), *FLAT_COLUMNS)
    enc = lines.select("k", encode_line(lines).alias("line"))
    back = enc.select("k", *decode_line(F.col("line")))
    before = sorted((tuple(r)[1:] for r in lines.collect()), key=repr)
    after = sorted((tuple(r)[1:] for r in back.collect()), key=repr)
    assert before == after


def test_read_lines_as_csv(spark, workdir):
    doc = ('{"dataType":"auth","reportTime":"2024-01-01 10:00:00","data":{' + WX +
           ',"addrInfo":{"latitude":30.25,"longitude":120.5}}}')
    flat = parse_events(spark.createDataFrame([(doc,)], "value string"), ingest_ts=None)
    flat.select(encode_line(flat)).write.text(f"{workdir}/lines")
    back = read_lines(spark, f"{workdir}/lines").first()
    assert back["dataType"] == "auth" and back["latitude"] == 30.25 and back["city"] is None


def test_day_source_arrival(spark):
    doc = '{"dataType":"visit","reportTime":"2024-01-01 10:00:00","data":{}}'
    raw = spark.createDataFrame([(doc, INGEST)], "value string, ingest_ts timestamp")
    assert parse_events(raw).first()["dt"] == dt.date(2024, 1, 1)
    assert parse_events(raw, day_source="arrival").first()["dt"] == INGEST.date()


def test_login_flags_are_booleans_or_true_false_text(spark):
    from daybook.operators.quality import parse_checked
    flags = ["true", '"true"', '"TRUE"', '"False"', '"yes"', '"1"', "1", '"2"', '"t"', '""', "null"]
    docs = [(i, '{"dataType":"login","data":{"loginData":{"succeed":%s}}}' % f, None) for i, f in enumerate(flags)]
    rows = parse_checked(spark.createDataFrame(docs, "i int, value string, ingest_ts timestamp"), keep=["i"]).collect()
    assert [r["succeed"] for r in rows] == [True, True, True, False] + [None] * 7
    assert [r["reason"] for r in rows] == [None] * 4 + ["bad_boolean"] * 5 + [None] * 2


def test_times_far_ahead_of_the_arrival_are_not_believed(spark):
    import datetime as dt
    at = dt.datetime(2024, 1, 10, 8, 0)
    docs = [(i, '{"reportTime":"%s"}' % t, a) for i, (t, a) in enumerate([
        ("2024-01-10 08:59:00", at), ("2024-01-10 09:01:00", at), ("2099-01-01 00:00:00", at), ("x", at),
        ("2023-12-31 00:00:00", at), ("2099-01-01 00:00:00", None)])]
    got = parse_events(spark.createDataFrame(docs, "i int, value string, ingest_ts timestamp"), keep=["i"]).collect()
    assert [r["event_ts"] for r in got] == [dt.datetime(2024, 1, 10, 8, 59), at, at, at, dt.datetime(2023, 12, 31), dt.datetime(2099, 1, 1)]
