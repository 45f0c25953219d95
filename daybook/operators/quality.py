"""Malformed-row routing: parse once, split good rows from quarantined ones.

Reasons, in the order tested:
``empty``      - NULL or empty text (``from_json`` gives a NULL struct);
``malformed``  - not a JSON object of the wire shape (corrupt text is kept);
``bad_number`` - a latitude/longitude text that is not a number;
``bad_boolean``- a login flag text that is not a boolean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from daybook.functions.codec import boolean_text, checked_schema_for, event_time, flat_columns, parse_once
from daybook.schema import ADDR_FIELDS, CORRUPT_COLUMN, FLAT_COLUMNS, LOGIN_FIELDS

PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def _unreadable(j: Column, block: str, fields: list[str], read) -> Column:
    bad = F.lit(False)
    for f in fields:
        text = F.nullif(j["data"][block][f], F.lit(""))
        bad = bad | (text.isNotNull() & read(text).isNull())
    return bad


def reason_of(value: Column, j: Column) -> Column:
    """Quarantine reason of one parsed row, NULL when the row is good."""
    return (F.when(value.isNull() | (value == "") | j.isNull(), "empty")
            .when(j[CORRUPT_COLUMN].isNotNull(), "malformed")
            .when(_unreadable(j, "addrInfo", ADDR_FIELDS, lambda t: t.try_cast("double")), "bad_number")
            .when(_unreadable(j, "loginData", LOGIN_FIELDS, boolean_text), "bad_boolean"))


def parse_checked(raw: DataFrame, value: str = "value", keep: list[str] | None = None,
                  ingest_ts: str = "ingest_ts", columns: list[str] | None = None) -> DataFrame:
    """``keep``, ``ingest_ts``, ``raw_value``, the flat ``columns`` (default:
    all 22) and ``reportTime``, ``reason`` (NULL = good), ``event_ts``, ``dt``.

    With ``columns`` only their leaves and those that the checks need are
    parsed; the reason of a row is the same.  The parsed struct is its own
    column so the parse is not repeated per field.
    """
    keep = list(keep or [])
    if columns is not None:
        columns = [c for c in FLAT_COLUMNS if c in set(columns) | {"reportTime"}]
    schema = T.StructType([*checked_schema_for(columns).fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    j = F.from_json(F.col(value), schema, PARSE_OPTIONS)
    parsed = parse_once(raw, keep + [F.col(ingest_ts).alias("ingest_ts"),
                                     F.col(value).alias("raw_value")], j)
    out = parsed.select(*keep, "ingest_ts", "raw_value", *flat_columns(F.col("_j"), columns),
                        reason_of(F.col("raw_value"), F.col("_j")).alias("reason"))
    return (out.withColumn("event_ts", event_time(F.col("reportTime"), F.col("ingest_ts")))
               .withColumn("dt", F.to_date("event_ts")))


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).drop("reason", "raw_value")


def bad_rows(checked: DataFrame) -> DataFrame:
    """Quarantine rows: ``value, reason, ingest_ts``."""
    return (checked.where(F.col("reason").isNotNull())
            .select(F.col("raw_value").alias("value"), "reason", "ingest_ts"))


def quarantine_counts(checked: DataFrame) -> DataFrame:
    """``dt, status, n`` with ``dt`` the arrival day and status good/bad."""
    status = F.when(F.col("reason").isNull(), "good").otherwise("bad")
    return (checked.groupBy(F.to_date("ingest_ts").alias("dt"), status.alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))

