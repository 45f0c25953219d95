"""Adapters from the driver's ``events`` table to the inputs the event job reads.

The reference consumes behaviour events as JSON text.  These adapters derive
such text (current and legacy shapes), Kafka-shaped rows and identity-service
replies from ``events`` with plain column expressions, so every input grows
with the table.  The same rules are mirrored in DuckDB by
:mod:`daybook.plans.oracle`.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from daybook.schema import KAFKA_SCHEMA
from daybook.sources.kafka import kafka_rows

# --- fixed values of the adapter (mirrored in plans/oracle.py) ---
TOPIC = "behavior-events"
N_BATCHES = 4            # batch id = event_id % 4, cuts across days
N_PARTITIONS = 4         # Kafka partition = user_id % 4
CORRUPT_EVERY = 97       # event_id % 97 = 0 -> document truncated
LATE_DAYS = 11           # late rows arrive event_id % 11 days after their event
WRONG_CLOCK = 1000       # event_id % 1000 = 7 -> reported in 2099
TYPE_OF = {"signup": "auth", "purchase": "login", "click": "visit", "view": "visit"}
LEGACY_TYPE_OF = {"signup": "授权", "purchase": "登录", "click": "访问", "view": "访问"}
# --- end of fixed values ---


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table."""
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _case(col: Column, mapping: dict[str, str]) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, v) if out is None else out.when(col == k, v))
    return out


def _cat(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _blocks(eid: Column, uid: Column, legacy: bool):
    """Struct columns of the ``data`` object for one event."""
    wx = F.struct(
        _cat("o", uid).alias("openid"),
        _cat("n", uid % 10).alias("nickname"),
        ((eid % 3).cast("string") if legacy else eid % 3).alias("gender"),
        F.when(uid % 9 == 0, F.lit("")).otherwise(_cat("y", uid % 6)).alias("city"),
        _cat("c", uid % 3).alias("country"),
        _cat("v", uid % 4).alias("province"),
        F.when(uid % 2 == 0, F.lit("zh_CN")).otherwise(F.lit("en")).alias("language"),
        ((F.lit(1700000000000) + uid * 1000).cast("string") if legacy
         else F.lit(1700000000000) + uid * 1000).alias("subscribeTime"),
        F.when(uid % 7 != 0, _cat("u", uid)).alias("unionid"),
    )
    addr = F.struct((F.lit(30.0) + (eid % 100) / 4.0).alias("latitude"),
                    (F.lit(120.0) + (eid % 64) / 8.0).alias("longitude"))
    user = F.struct(F.when(uid % 5 == 0, F.lit("")).otherwise(_cat("id", uid)).alias("userid"),
                    F.when(eid % 4 != 0, _cat("p", uid)).alias("phoneNo"))
    login = F.struct((eid % 2 == 0).alias("succeed"), (eid % 3 == 0).alias("firstLogin"))
    login_text = F.struct((eid % 2 == 0).cast("string").alias("succeed"),
                          (eid % 3 == 0).cast("string").alias("firstLogin"))
    visit = F.struct(
        F.when(eid % 11 == 0, F.lit("")).otherwise(_cat("page/", eid % 13)).alias("pageUrl"),
        F.lit("").alias("pageParam"),
        _cat("t", eid % 3).alias("pageType"),
        _cat("m", eid % 5).alias("modelId"),
        _cat("s", eid % 2).alias("seriesId"),
    )
    return wx, addr, user, login, login_text, visit


def wire_json(late: bool = False) -> Column:
    """The current wire document of an ``events`` row; with ``late`` some
    devices report a time in 2099."""
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    kind = _case(et, TYPE_OF)
    wx, addr, user, login, login_text, visit = _blocks(eid, uid, legacy=False)
    has_id = kind.isin("auth", "login")

    reported = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    if late:
        reported = F.when(eid % WRONG_CLOCK == 7, F.lit("2099-01-01 00:00:00")).otherwise(reported)

    def doc(login_block: Column) -> Column:
        data = F.struct(wx.alias("wxInfo"),
                        F.when(has_id, addr).alias("addrInfo"),
                        F.when(has_id, user).alias("userInfo"),
                        F.when(kind == "login", login_block).alias("loginData"),
                        F.when(kind == "visit", visit).alias("visitData"))
        return F.to_json(F.struct(kind.alias("dataType"),
                                  reported.alias("reportTime"),
                                  data.alias("data")))

    # login flags travel as JSON strings on every tenth event
    return F.when(eid % 10 == 0, doc(login_text)).otherwise(doc(login))


def arrival_ts(late: bool = False) -> Column:
    """Arrival time of the fixture rows: the event time itself, or with
    ``late`` up to ten days after it."""
    ts = F.col("ts").cast("timestamp")
    return ts + F.make_dt_interval((F.col("event_id") % LATE_DAYS).cast("int")) if late else ts


def wire_events(events: DataFrame, corrupt: bool = False) -> DataFrame:
    """``event_id, batch, ingest_ts, value`` with ``value`` the wire JSON.

    With ``corrupt`` every 97th document loses its closing brace.
    """
    out = events.select("event_id", (F.col("event_id") % N_BATCHES).alias("batch"),
                        arrival_ts().alias("ingest_ts"), wire_json().alias("value"))
    if corrupt:
        out = out.withColumn("value", F.when(
            F.col("event_id") % CORRUPT_EVERY == 0,
            F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value")))
    return out


def kafka_events(events: DataFrame, topic: str = TOPIC, late: bool = False) -> DataFrame:
    """Rows shaped like the Kafka source: partition ``user_id % 4``; one
    micro-batch per event day (``batch_id``, days since 1970-01-01).

    Offsets are the event ids: increasing within each partition, with gaps,
    as on a compacted or transactional topic.
    """
    return events.select(
        wire_json(late).alias("value"), F.lit(topic).alias("topic"),
        (F.col("user_id") % N_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), arrival_ts(late).alias("timestamp"),
        F.unix_date(F.to_date("ts")).cast("long").alias("batch_id"))


def legacy_json(events: DataFrame) -> Column:
    """The legacy wire document: Chinese labels, every field as a JSON string."""
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    kind = F.coalesce(_case(et, LEGACY_TYPE_OF), et)
    wx, addr, user, login, _, visit = _blocks(eid, uid, legacy=True)
    has_id = kind.isin("授权", "登录")
    data = F.struct(wx.alias("wxInfo"),
                    F.when(has_id, addr).alias("addrInfo"),
                    F.when(has_id, user).alias("userInfo"),
                    F.when(kind == "登录", login).alias("loginData"),
                    F.when(kind == "访问", visit).alias("visitData"))
    doc = F.to_json(F.struct(kind.alias("dataType"), data.alias("data"),
                             F.when(eid % 59 == 0, F.lit("UTF-8")).alias("charset")))
    # every 53rd document carries a trailing space (fails the text guard)
    return F.when(eid % 53 == 0, F.concat(doc, F.lit(" "))).otherwise(doc)


def legacy_events(events: DataFrame) -> DataFrame:
    return events.select("event_id", legacy_json(events).alias("value"))


def identity_replies(outbox: DataFrame) -> DataFrame:
    """Replies of the identity service to outbox rows, by ``event_id % 5``:
    success with data, server error, empty (failed call), not JSON, success
    with ``data: null``."""
    e = F.col("event_id") % 5
    ok = F.to_json(F.struct(F.lit(200).alias("code"), F.lit("success").alias("status"),
                            F.lit("ok").alias("msg"),
                            F.struct(_cat("one-", F.col("event_id")).alias("oneId")).alias("data")))
    err = F.to_json(F.struct(F.lit(500).alias("code"), F.lit("error").alias("status"),
                             F.lit("server busy").alias("msg")))
    reply = (F.when(e == 0, ok).when(e == 1, err).when(e == 2, F.lit(""))
             .when(e == 3, F.lit("gateway timeout"))
             .otherwise(F.lit('{"code":200,"status":"success","msg":"ok","data":null}')))
    return outbox.select("event_id", reply.alias("reply"))


def read_file_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """As ``read_kafka_stream``, over a topic kept as Kafka-shaped parquet
    files in the folder named as the server: rows before ``startingOffsets``
    are left out.  A folder keeps no end of a topic, so ``latest`` reads it
    all."""
    rows = spark.readStream.schema(KAFKA_SCHEMA).parquet(options["kafka.bootstrap.servers"])
    start = options["startingOffsets"]
    if start == "latest":
        return kafka_rows(rows)
    wanted = F.lit(False)
    for topic, offsets in json.loads(start).items():  # one entry per partition of the topic
        for partition, offset in offsets.items():
            wanted = wanted | ((F.col("topic") == topic) & (F.col("partition") == int(partition))
                               & (F.col("offset") >= max(0, offset)))
    return kafka_rows(rows.where(wanted))
