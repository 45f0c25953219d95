"""Seen-visitor store: the visitors of each day, in one folder per day.

A micro-batch appends the visitors its days do not have yet, marked with its
run and batch.  Adding a batch again appends only what an earlier attempt did
not store, and how many visitors a batch brought is counted from its mark, so
a replay gives the same numbers.  Rows written twice change nothing, which is
what makes compaction safe at any point.

With a time to live, a day goes once nothing was added to it for that long, as
the reference's per-day sets do: every batch that adds to a day renews it.  The
times of adding are a small table of their own, one row a batch and day.

Daily totals live in :class:`daybook.sinks.daily.DailyIncrements`, not here,
so dropping old days never lowers a total.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from daybook.session import delete_partition, list_files, list_partitions, path_exists, remove_dir

SEEN_SCHEMA = T.StructType([
    T.StructField("unionid", T.StringType()), T.StructField("dt", T.DateType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
ADDED_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()), T.StructField("added_at", T.TimestampType())])
MAX_LISTED_DAYS = 4096


def touched_days(df: DataFrame) -> list | None:
    """Distinct days of ``df`` when there are at most MAX_LISTED_DAYS, else None
    (days come from the clients, so garbage may name very many)."""
    days = [r["dt"] for r in df.select("dt").distinct().limit(MAX_LISTED_DAYS + 1).collect()]
    return days if len(days) <= MAX_LISTED_DAYS else None


class SeenVisitors:
    def __init__(self, spark: SparkSession, path: str, ttl: dt.timedelta | None = None):
        """``ttl``: how long a day stays after the last visitor was added to it
        (for good without one)."""
        self.spark, self.path, self.ttl = spark, path, ttl
        self._added = f"{path}/_added"  # not a day's folder: readers of the store skip it

    def read(self) -> DataFrame:
        """``unionid, dt, run, batch_id``."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SEEN_SCHEMA)
        return self.spark.read.schema(SEEN_SCHEMA).parquet(self.path)

    def _of_days(self, days: list | None) -> DataFrame:
        """Stored rows of the listed days (their folders only), or all."""
        rows = self.read()
        if days is None:
            return rows
        return rows.where(F.col("dt").isin(days)) if days else rows.limit(0)

    def has_day(self, day) -> bool:
        return path_exists(self.spark, f"{self.path}/dt={day}")

    def add(self, visitors: DataFrame, run: str, batch_id: int, unseen_days: list | None = None,
            counts: tuple[Observation, Observation] | None = None, now: Column | None = None) -> DataFrame:
        """Store the new visitors of a batch (``dt, unionid``); returns
        ``dt, n``, how many the batch brought to each day.

        ``unseen_days``: days whose visitors in the batch are known not to be
        stored yet; they are appended without a lookup.  ``counts`` observes
        the rows before and after the lookup (``visitors`` then has ``n``, the
        rows of each visitor and day) in the job that writes the new ones.
        ``now`` is the time of adding, for the time to live.

        A bounded list of days prunes the store's folders; with more days the
        anti-join reads the whole store.  Nothing is broadcast by hint.
        Appending to the folder the anti-join reads is safe: new files are
        committed after the job has read the old ones.
        """
        fresh = visitors.where(F.col("unionid").isNotNull())
        days = touched_days(fresh)
        if counts:  # one row a visitor and day, with the number of its rows
            fresh = fresh.observe(counts[0], F.sum("n").alias("n"))
            new = self._not_stored(fresh, days).observe(counts[1], F.sum("n").alias("n")).select("dt", "unionid")
        elif unseen_days:
            known = F.col("dt").isin(unseen_days)
            new = fresh.where(known).select("dt", "unionid").dropDuplicates()
            looked_up = None if days is None else [d for d in days if d not in set(unseen_days)]
            if looked_up is None or looked_up:
                rest = fresh.where(~known).select("dt", "unionid").dropDuplicates()
                new = new.unionByName(self._not_stored(rest, looked_up))
        else:
            new = self._not_stored(fresh.select("dt", "unionid").dropDuplicates(), days)
        new = new.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
        self._append(new)
        own = self._of_days(days).where((F.col("run") == run) & (F.col("batch_id") == batch_id))
        brought = own.dropDuplicates(["dt", "unionid"]).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
        if self.ttl is not None:
            at = (now if now is not None else F.current_timestamp()).cast("timestamp")
            # one row a day that the batch added to
            brought.select("dt", at.alias("added_at")).coalesce(1).write.mode("append").parquet(self._added)
            self.expire_quiet(now)
        return brought

    def _not_stored(self, visitors: DataFrame, days: list | None) -> DataFrame:
        """The rows of ``visitors`` (distinct by ``dt, unionid``) that the
        store does not have; ``days`` are all their days, if listed."""
        return visitors.join(self._of_days(days).select("dt", "unionid").dropDuplicates(), ["dt", "unionid"], "left_anti")

    def _append(self, rows: DataFrame) -> None:
        # files per day follow the size of the day, not the number of tasks
        rows.hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(self.path)

    def _drop_day(self, day: str) -> None:
        delete_partition(self.spark, self.path, "dt", day)

    def last_added(self) -> DataFrame:
        """``dt, added_at``: when a visitor was last added to each day."""
        if not path_exists(self.spark, self._added):
            return self.spark.createDataFrame([], ADDED_SCHEMA)
        rows = self.spark.read.schema(ADDED_SCHEMA).parquet(self._added)
        return rows.groupBy("dt").agg(F.max("added_at").alias("added_at"))

    def expire_quiet(self, now: Column | None = None) -> list[str]:
        """Drop the days to which nothing was added for the time to live; every
        ``add`` does so.  A visitor of a dropped day who comes again counts
        again, as after the reference's TTL, and opens the day anew."""
        at = (now if now is not None else F.current_timestamp()).cast("timestamp")
        quiet = self.last_added().where(F.col("added_at") < at - F.make_dt_interval(secs=F.lit(self.ttl.total_seconds())))
        stored = set(list_partitions(self.spark, self.path, "dt"))
        gone = sorted({str(r["dt"]) for r in quiet.select("dt").collect()} & stored)  # days, never rows
        for d in gone:
            self._drop_day(d)
        return gone

    def expire(self, before) -> list[str]:
        """Drop the days older than ``before`` (a date or ``yyyy-MM-dd``),
        the store's retention in place of the reference's per-day TTL.  Totals
        stay; a visitor of a dropped day who comes again counts again.  Lists
        day folders, never rows."""
        cutoff = str(before)
        gone = sorted(d for d in list_partitions(self.spark, self.path, "dt") if d < cutoff)
        for d in gone:
            self._drop_day(d)
        return gone

    def compact(self, before) -> list[str]:
        """Rewrite each day older than ``before`` that has several files into
        few.  The new files are committed before the old ones go, and rows
        written twice change nothing, so a crash in between costs only space."""
        done = []
        for d in sorted(x for x in list_partitions(self.spark, self.path, "dt") if x < str(before)):
            files = list_files(self.spark, f"{self.path}/dt={d}")
            if len(files) < 2:
                continue
            self._append(self._of_days([d]).dropDuplicates(["dt", "unionid", "run", "batch_id"]))
            for f in files:
                remove_dir(self.spark, f)
            done.append(d)
        return done

    def visitors(self) -> DataFrame:
        return self.read().select("dt", "unionid").dropDuplicates()

    def counts(self) -> DataFrame:
        """``dt, uv`` from the store."""
        return self.visitors().groupBy("dt").agg(F.count(F.lit(1)).alias("uv"))
