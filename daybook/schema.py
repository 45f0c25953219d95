"""Fixed schemas of the behaviour-event data model.

Every wire leaf is declared ``string``: ``from_json`` then keeps JSON numbers
as their text (``1``, ``1700000000000``), and typed columns are derived with
``try_cast`` afterwards, which also accepts numeric / boolean *strings*.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: wire field names and the order of the 22-field flat row ---
WX_FIELDS = ["openid", "nickname", "gender", "city", "country", "province",
             "language", "subscribeTime", "unionid"]
ADDR_FIELDS = ["latitude", "longitude"]
USER_FIELDS = ["userid", "phoneNo"]
LOGIN_FIELDS = ["succeed", "firstLogin"]
VISIT_FIELDS = ["pageUrl", "pageParam", "pageType", "modelId", "seriesId"]
FLAT_COLUMNS = (["dataType", "reportTime"] + WX_FIELDS + ADDR_FIELDS
                + USER_FIELDS + LOGIN_FIELDS + VISIT_FIELDS)
DOUBLE_COLUMNS = set(ADDR_FIELDS)
BOOLEAN_COLUMNS = set(LOGIN_FIELDS)
NULL_TEXT = "\\N"          # Hive text NULL, the two characters backslash + N
LINE_SEP = ";"
LEGACY_SEP = ","
# legacy event labels and the current labels they stand for
LEGACY_LABELS = {"授权": "auth", "登录": "login", "访问": "visit"}
# legacy text guard: starts with, ends with, must not contain
LEGACY_GUARD = ("{", "}", "UTF-8")
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# what the reference's key/value text writer leaves after each archived line
ARCHIVE_LEGACY_SUFFIX = ", "
# --- end of fixed values ---

BLOCKS = {"wxInfo": WX_FIELDS, "addrInfo": ADDR_FIELDS, "userInfo": USER_FIELDS,
          "loginData": LOGIN_FIELDS, "visitData": VISIT_FIELDS}
BLOCK_OF = {f: b for b, fs in BLOCKS.items() for f in fs}


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


DATA_SCHEMA = T.StructType([T.StructField(b, _strings(fs)) for b, fs in BLOCKS.items()])

WIRE_SCHEMA = T.StructType([
    T.StructField("dataType", T.StringType()),
    T.StructField("reportTime", T.StringType()),
    T.StructField("data", DATA_SCHEMA),
])

CORRUPT_COLUMN = "_corrupt_record"
WIRE_SCHEMA_WITH_CORRUPT = T.StructType(
    WIRE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])


def flat_type(name: str) -> T.DataType:
    if name in DOUBLE_COLUMNS:
        return T.DoubleType()
    if name in BOOLEAN_COLUMNS:
        return T.BooleanType()
    return T.StringType()


FLAT_SCHEMA = T.StructType([T.StructField(c, flat_type(c)) for c in FLAT_COLUMNS])

# Kafka-shaped rows, as the Kafka source yields them after CAST(value AS STRING)
KAFKA_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

DAILY_METRIC_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("amount", T.LongType()),
    T.StructField("create_time", T.TimestampType()),
    T.StructField("update_time", T.TimestampType()),
    # set by increment writes: the batch that wrote the row and the amount
    # before it, so a replayed batch recomputes instead of adding twice
    T.StructField("batch_id", T.LongType()),
    T.StructField("base_amount", T.LongType()),
])

REPLY_SCHEMA = T.StructType([
    T.StructField("code", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("data", T.StringType()),
])

# legacy records: the fields each label requires, in output order
LEGACY_FIELDS = {
    "auth": WX_FIELDS + ADDR_FIELDS + USER_FIELDS,
    "login": WX_FIELDS + ADDR_FIELDS + USER_FIELDS + LOGIN_FIELDS,
    "visit": WX_FIELDS + VISIT_FIELDS,
}
