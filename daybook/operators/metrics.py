"""Page views, unique visitors and visitor de-duplication (batch form).

All operators pre-aggregate before they shuffle: one visitor (or one day)
holding a third of the rows costs one hash-table entry per task, not one
task holding a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def page_views(flat: DataFrame) -> DataFrame:
    """Rows that count as a page view: a page is set; any event type."""
    return flat.where(F.col("pageUrl").isNotNull())


def visitor_rows(flat: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """``(extra..., dt, unionid)`` for rows that name a visitor."""
    return flat.where(F.col("unionid").isNotNull()).select(*(extra or []), "dt", "unionid")


def pv_daily(flat: DataFrame) -> DataFrame:
    """``dt, pv``: page views per event day."""
    return page_views(flat).groupBy("dt").agg(F.count(F.lit(1)).alias("pv"))


def uv_daily(flat: DataFrame) -> DataFrame:
    """``dt, uv``: distinct visitors per event day (distinct, then count)."""
    return (visitor_rows(flat).dropDuplicates(["dt", "unionid"])
            .groupBy("dt").agg(F.count(F.lit(1)).alias("uv")))


def batch_dedup(flat: DataFrame, batch: str = "batch") -> DataFrame:
    """One row per visitor, day and batch."""
    return visitor_rows(flat, [batch]).dropDuplicates([batch, "dt", "unionid"])


def uv_daily_observed(flat: DataFrame, batch: str = "batch") -> DataFrame:
    """``dt, uv`` as the reference computes it: its seen-set lookup never
    matches, so each batch adds its own distinct visitors again."""
    return batch_dedup(flat, batch).groupBy("dt").agg(F.count(F.lit(1)).alias("uv"))


def new_visitors(batch_rows: DataFrame, seen: DataFrame) -> DataFrame:
    """``dt, unionid`` of a batch not yet seen that day (anti-join).

    Both sides are reduced to distinct keys first.  No broadcast hint: the
    seen set grows with the data, so AQE picks a broadcast only when the
    measured side is under ``autoBroadcastJoinThreshold``.
    """
    fresh = batch_rows.select("dt", "unionid").dropDuplicates()
    known = seen.select("dt", "unionid").dropDuplicates()
    return fresh.join(known, ["dt", "unionid"], "left_anti")


def new_visitors_in(flat: DataFrame, batch_id: int, batch: str = "batch") -> DataFrame:
    """Visitors of batch ``batch_id`` absent from the earlier batches of their day."""
    rows = visitor_rows(flat, [batch])
    return new_visitors(rows.where(F.col(batch) == batch_id),
                        rows.where(F.col(batch) < batch_id))


def filter_counts(flat: DataFrame, batch: str = "batch") -> DataFrame:
    """``batch, before_n, after_n``: visitor rows of each batch before and after
    dropping visitors already seen that day in an earlier batch."""
    per = (visitor_rows(flat, [batch]).groupBy("dt", "unionid", batch)
           .agg(F.count(F.lit(1)).alias("n")))
    first = (per.groupBy("dt", "unionid")
             .agg(F.min(batch).alias(batch), F.min_by("n", batch).alias("kept")))
    both = (per.select(batch, "n", F.lit(0).cast("long").alias("kept"))
            .unionByName(first.select(batch, F.lit(0).cast("long").alias("n"), "kept")))
    return both.groupBy(batch).agg(F.sum("n").alias("before_n"), F.sum("kept").alias("after_n"))
