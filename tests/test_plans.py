"""Plan shape: the properties the design relies on at scale."""

import re

from daybook.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_documents_parsed_once(spark):
    for key in ["pv_daily", "uv_daily", "identity_outbox", "legacy_auth", "quarantine"]:
        p = plan(QUERIES[key](spark, SF))
        assert p.count("from_json(") == 1, key


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["pv_daily"](spark, SF))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert "props" not in schema and "value" not in schema


def test_partial_aggregation_before_every_shuffle(spark):
    for key in ["uv_daily", "uv_daily_observed", "new_visitors", "filter_counts", "batch_dedup"]:
        p = plan(QUERIES[key](spark, SF))
        lines = p.splitlines()
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                below = lines[i + 1] if i + 1 < len(lines) else ""
                # every hash shuffle is fed by a (partial) aggregate, never by raw rows
                assert "HashAggregate" in below, (key, line, below)


def test_no_broadcast_hints_on_growing_sides(spark):
    # the seen set grows with the data: never hinted, AQE decides at runtime
    df = QUERIES["new_visitors"](spark, SF)
    assert "broadcast" not in df._jdf.queryExecution().logical().toString().lower()


def test_store_lookups_read_only_the_listed_days(spark, workdir):
    import datetime as dt
    from daybook.sinks.visitors import SeenVisitors
    store = SeenVisitors(spark, f"{workdir}/seen")
    store.add(spark.createDataFrame([(dt.date(2024, 1, 1), "a")], "dt date, unionid string"), "r", 0)
    p = plan(store._of_days([dt.date(2024, 1, 1)]))
    assert re.search(r"PartitionFilters: \[[^]]*dt", p) and "Exchange" not in p


def test_streams_and_labels_parse_only_what_they_read(spark):
    from daybook.sources import fixtures
    from daybook.sources.kafka import kafka_rows
    from daybook.streaming.stream import parse_batch
    batch = kafka_rows(fixtures.kafka_events(fixtures.load_events(spark, SF)))
    p = parse_batch(batch, ["pageUrl"])._jdf.queryExecution().optimizedPlan().toString()
    # what the metric reads, what can make a row bad, and one leaf of every other block
    assert _parsed(p) == [["reportTime", "data", "wxInfo", "openid", "addrInfo", "latitude", "longitude", "userInfo", "userid",
                           "loginData", "succeed", "firstLogin", "visitData", "pageUrl", "_corrupt_record"]]
    label = QUERIES["legacy_labels"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert _parsed(label) == [["dataType"]]
    auth = _parsed(QUERIES["legacy_auth"](spark, SF)._jdf.queryExecution().optimizedPlan().toString())
    assert len(auth) == 1 and "phoneNo" in auth[0] and "pageUrl" not in auth[0]


def _parsed(p: str) -> list[list[str]]:
    """Fields of the schema of each from_json in a plan."""
    out = []
    for at in (m.end() for m in re.finditer(r"from_json\(", p)):
        depth, end = 1, at
        while depth and not (depth == 1 and p[end:end + 2] == ", "):
            depth += {"(": 1, ")": -1}.get(p[end], 0)
            end += 1
        schema = p[at:end]
        while (m := re.match(r", StructField.*?", p[end:])):  # the next top-level field
            start = end
            depth, end = 1, end + 2
            while depth and not (depth == 1 and p[end:end + 2] == ", "):
                depth += {"(": 1, ")": -1}.get(p[end], 0)
                end += 1
            schema += p[start:end]
        out.append(re.findall(r"StructField\((\w+),", schema))
    return out
