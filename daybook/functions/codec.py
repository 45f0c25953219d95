"""Parse, flatten, encode and decode behaviour events (all JVM-side).

* :func:`parse_events` - wire JSON text -> the 22 typed flat columns.
* :func:`encode_line` - flat columns -> one ``;``-separated line, NULL as ``\\N``.
* :func:`decode_line` / :func:`read_lines` - the line back to typed columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook.functions.text import (empty_to_null, from_marker, null_marker,
                                    sanitize)
from daybook.schema import (BLOCK_OF, BLOCKS, BOOLEAN_COLUMNS, DOUBLE_COLUMNS,
                            FLAT_COLUMNS, FLAT_SCHEMA, LINE_SEP, NULL_TEXT,
                            REPORT_TIME_FORMAT, WIRE_SCHEMA, flat_type)

# how far a device's clock may run ahead of the arrival time
MAX_AHEAD = "INTERVAL 1 HOUR"


def wire_struct(value: Column) -> Column:
    """Parse the JSON text; field access on it is pruned to what is used."""
    return F.from_json(value, WIRE_SCHEMA)


def parse_once(df: DataFrame, cols: list, parsed: Column, name: str = "_j") -> DataFrame:
    """``cols`` plus ``parsed`` as column ``name``, evaluated exactly once per row.

    The value goes through a one-element ``inline`` (a Generate node).
    Predicates on fields of the parsed struct cannot be pushed below a
    Generate, so a later filter does not re-run the parse inside the filter
    condition (a filter pushed through a plain projection would inline and
    repeat it).
    """
    return df.select(*cols, F.inline(F.array(F.struct(parsed.alias(name)))))


def _leaf(j: Column, name: str) -> Column:
    if name in ("dataType", "reportTime"):
        return j[name]
    return j["data"][BLOCK_OF[name]][name]


def typed_leaf(text: Column, name: str) -> Column:
    """String leaf -> flat column: '' is NULL, numbers by try_cast, booleans
    by :func:`boolean_text`."""
    t = empty_to_null(text)
    if name in BOOLEAN_COLUMNS:
        return boolean_text(t)
    return t.try_cast(flat_type(name)) if name in DOUBLE_COLUMNS else t


def boolean_text(text: Column) -> Column:
    """A boolean, or the text ``true`` / ``false`` in any case; else NULL."""
    low = F.lower(text)
    return F.when(low.isin("true", "false"), low == "true")


def flat_columns(j: Column, columns: list[str] | None = None) -> list[Column]:
    return [typed_leaf(_leaf(j, c), c).alias(c) for c in (columns or FLAT_COLUMNS)]


def wire_schema_for(columns: list[str] | None) -> T.StructType:
    """The wire schema cut down to the leaves of ``columns`` (all if None)."""
    if columns is None:
        return WIRE_SCHEMA
    want = set(columns)
    top = [T.StructField(c, T.StringType()) for c in ("dataType", "reportTime") if c in want]
    blocks = []
    for b, fs in BLOCKS.items():
        keep = [T.StructField(f, T.StringType()) for f in fs if f in want]
        if keep:
            blocks.append(T.StructField(b, T.StructType(keep)))
    return T.StructType(top + ([T.StructField("data", T.StructType(blocks))] if blocks else []))


def checked_schema_for(columns: list[str] | None) -> T.StructType:
    """The wire schema cut down to what ``columns`` and the row checks read:
    the wanted leaves, the reported time, the coordinates and login flags, and
    one leaf of every other block, so that a block of the wrong type still
    makes the document malformed."""
    if columns is None:
        return WIRE_SCHEMA
    want = set(columns) | {"reportTime"} | DOUBLE_COLUMNS | BOOLEAN_COLUMNS
    want |= {fs[0] for fs in BLOCKS.values() if not want & set(fs)}
    return wire_schema_for([c for c in FLAT_COLUMNS if c in want])


def event_time(report_time: Column, ingest_ts: Column | None = None) -> Column:
    """Event time: the reported time, else the arrival time.  A reported time
    more than ``MAX_AHEAD`` after the arrival comes from a wrong clock and
    counts as unreadable."""
    parsed = F.try_to_timestamp(report_time, F.lit(REPORT_TIME_FORMAT))
    if ingest_ts is None:
        return parsed
    return F.when(parsed <= ingest_ts + F.expr(MAX_AHEAD), parsed).otherwise(F.coalesce(ingest_ts, parsed))


def parse_events(raw: DataFrame, value: str = "value",
                 keep: list[str] | None = None,
                 ingest_ts: str | None = "ingest_ts",
                 columns: list[str] | None = None,
                 day_source: str = "event") -> DataFrame:
    """Wire JSON -> ``keep`` columns + flat columns + ``event_ts`` + ``dt``.

    ``columns`` names the flat columns a query reads (default: all 22); the
    JSON is parsed against a schema of just those leaves (plus
    ``reportTime`` for the event day), which halves the parse cost of a
    metrics query.  ``day_source="arrival"`` files every event under the day
    it arrived (the reference's processing-day counting) instead of its
    event day.  Rows whose JSON does not parse come out with all flat
    columns NULL; route them with :mod:`daybook.operators.quality` where that
    matters.
    """
    keep = list(keep or [])
    if columns is not None:
        columns = [c for c in FLAT_COLUMNS if c in set(columns) | {"reportTime"}]
    ing = F.col(ingest_ts) if ingest_ts and ingest_ts in raw.columns else None
    parsed = parse_once(raw, keep + ([ing.alias("_ingest")] if ing is not None else []),
                        F.from_json(F.col(value), wire_schema_for(columns)))
    flat = parsed.select(*keep, *flat_columns(F.col("_j"), columns),
                         *(["_ingest"] if ing is not None else []))
    ts = event_time(F.col("reportTime"), F.col("_ingest") if ing is not None else None)
    if day_source == "arrival":
        if ing is None:
            raise ValueError("day_source='arrival' needs an arrival-time column")
        ts = F.col("_ingest")
    elif day_source != "event":
        raise ValueError(f"unknown day_source {day_source!r}")
    out = flat.withColumn("event_ts", ts).withColumn("dt", F.to_date("event_ts"))
    return out.drop("_ingest") if ing is not None else out


def encode_line(df: DataFrame, clean: bool = True, sep: str = LINE_SEP) -> Column:
    """The 22 flat columns as one line; NULL and '' become ``\\N``.

    ``clean`` replaces ``sep``, CR and LF inside values by spaces so the line
    always splits back into 22 fields.
    """
    parts = []
    for c in FLAT_COLUMNS:
        col = F.col(c)
        if c not in DOUBLE_COLUMNS and c not in BOOLEAN_COLUMNS and clean:
            col = sanitize(col, sep)
        parts.append(null_marker(col))
    return F.concat_ws(sep, *parts)


def decode_line(line: Column, sep: str = LINE_SEP) -> list[Column]:
    """Split a line back into the 22 typed columns (``\\N`` -> NULL)."""
    fields = F.split(line, re.escape(sep), -1)
    out = []
    for i, c in enumerate(FLAT_COLUMNS):
        v = from_marker(fields.getItem(i))
        if c in BOOLEAN_COLUMNS:
            v = boolean_text(v)
        elif c in DOUBLE_COLUMNS:
            v = v.try_cast(flat_type(c))
        out.append(v.alias(c))
    return out


def read_lines(spark: SparkSession, path: str, sep: str = LINE_SEP) -> DataFrame:
    """Read archived lines as CSV with the flat schema (no inference)."""
    return (spark.read.schema(FLAT_SCHEMA)
            .option("sep", sep).option("nullValue", NULL_TEXT)
            .option("quote", "\u0000").option("escape", "\u0000")
            .option("mode", "PERMISSIVE").csv(path))
