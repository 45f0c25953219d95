"""The two older jobs: per-label comma-separated lines from the legacy JSON.

Legacy documents are strict: every field of the label is required, a string
field must hold a JSON string (a number is an error), coordinates must be
numbers or numeric text, login flags booleans or ``"true"``/``"false"``.
The document is parsed once into a struct of VARIANT leaves so these JSON
types can be checked; failures are quarantined instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from daybook.functions.codec import parse_once
from daybook.schema import (BLOCK_OF, BLOCKS, BOOLEAN_COLUMNS, DOUBLE_COLUMNS,
                            LEGACY_FIELDS, LEGACY_GUARD, LEGACY_LABELS, LEGACY_SEP)


def legacy_guard(value: Column) -> Column:
    """The text guard of the legacy streaming job."""
    head, tail, banned = LEGACY_GUARD
    return (F.coalesce(value.startswith(head) & value.endswith(tail)
                       & ~value.contains(banned), F.lit(False)))


def normalise_label(label: Column) -> Column:
    """Legacy label -> current event type; unknown labels give NULL."""
    out = None
    for k, v in LEGACY_LABELS.items():
        out = F.when(label == k, v) if out is None else out.when(label == k, v)
    return out


def _variant_struct(names) -> T.StructType:
    # every leaf a VARIANT, so the JSON type of each value stays visible
    return T.StructType([T.StructField(n, T.VariantType()) for n in names])


def _field(node: Column, field: str) -> tuple[Column, Column]:
    """(text of the field as written in a line, field is valid)."""
    kind = F.schema_of_variant(node)
    if field in DOUBLE_COLUMNS:
        x = node.try_cast("double")          # a number or numeric text
        return x.cast("string"), x.isNotNull()
    if field in BOOLEAN_COLUMNS:
        text = F.lower(node.cast("string"))
        x = (F.when(kind == "BOOLEAN", node.cast("boolean"))
             .when((kind == "STRING") & text.isin("true", "false"), text == "true"))
        return x.cast("string"), x.isNotNull()
    return node.cast("string"), kind == "STRING"


def legacy_schema_for(fields: list[str]) -> T.StructType:
    """The legacy schema cut down to the label and ``fields``."""
    blocks = {b: [f for f in fs if f in fields] for b, fs in BLOCKS.items()}
    data = [T.StructField(b, _variant_struct(fs)) for b, fs in blocks.items() if fs]
    return T.StructType([T.StructField("dataType", T.VariantType())]
                        + ([T.StructField("data", T.StructType(data))] if data else []))


def _label(node: Column) -> Column:
    return F.when(F.schema_of_variant(node) == "STRING", node.cast("string"))


def legacy_records(raw: DataFrame, value: str = "value", keep: list[str] | None = None,
                   guard: bool = True, kinds: list[str] | None = None) -> DataFrame:
    """``keep..., label, kind, line, status``.

    ``status``: ``ok``; ``guard`` (rejected by the text guard); ``bad`` (not
    JSON or a required field missing, null or of the wrong type);
    ``unknown`` (label is none of the three, dropped and counted).

    With ``kinds`` only rows of these kinds come out, and only their fields
    are parsed.

    Three projections: parse once; read each field once (text + valid);
    assemble the line of the row's label.
    """
    keep = list(keep or [])
    wanted = {k: fs for k, fs in LEGACY_FIELDS.items() if kinds is None or k in kinds}
    fields = list(dict.fromkeys(f for fs in wanted.values() for f in fs))
    parsed = parse_once(raw, keep + [F.col(value).alias("_text")],
                        F.from_json(F.col(value), legacy_schema_for(fields)))
    j = F.col("_j")
    label_node = j["dataType"]
    label = _label(label_node)
    cols = []
    for f in fields:
        t, good = _field(j["data"][BLOCK_OF[f]][f], f)
        cols += [t.alias(f"t_{f}"), F.coalesce(good, F.lit(False)).alias(f"ok_{f}")]
    read = parsed.select(*keep, "_text", j.isNull().alias("_unparsed"),
                         label_node.isNull().alias("_nolabel"),
                         label.alias("label"), normalise_label(label).alias("kind"), *cols)
    kind = F.col("kind")
    line, ok = None, None
    for k, fs in wanted.items():
        text = F.concat_ws(LEGACY_SEP, *[F.col(f"t_{f}") for f in fs])
        valid = F.lit(True)
        for f in fs:
            valid = valid & F.col(f"ok_{f}")
        line = F.when(kind == k, text) if line is None else line.when(kind == k, text)
        ok = F.when(kind == k, valid) if ok is None else ok.when(kind == k, valid)
    status = (F.when(F.lit(guard) & ~legacy_guard(F.col("_text")), "guard")
              .when(F.col("_unparsed") | F.col("_nolabel"), "bad")
              .when(kind.isNull(), "unknown")
              .when(ok, "ok").otherwise("bad"))
    if kinds is not None:
        read = read.where(kind.isin(list(wanted)))
    return read.select(*keep, "label", "kind", F.when(status == "ok", line).alias("line"),
                       status.alias("status"))


def legacy_lines(records: DataFrame, kind: str) -> DataFrame:
    """Good lines of one kind (``auth``, ``login`` or ``visit``)."""
    return records.where((F.col("status") == "ok") & (F.col("kind") == kind))


def label_counts(raw: DataFrame, value: str = "value") -> DataFrame:
    """``label, dataType, n``: legacy labels with their current names; only
    the label is parsed."""
    parsed = parse_once(raw, [], F.from_json(F.col(value), legacy_schema_for([])))
    label = _label(F.col("_j")["dataType"])
    return (parsed.groupBy(label.alias("label"), normalise_label(label).alias("dataType"))
            .agg(F.count(F.lit(1)).alias("n")))
