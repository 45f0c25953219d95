"""The running metrics kept in Spark's state store instead of looked up.

* :func:`start_pv_state_query` - the count of every day is streaming state,
  and each micro-batch emits the new totals of the days it changed.  There is
  no watermark, so no row is late: the state is one number a calendar day.
* :func:`start_uv_state_query` - the visitors of a day are keys of the state
  store, so a micro-batch does not read the days it touches again.

The visitor state must not grow for ever.  Its clock is the time of processing,
which no row can be behind, so the operator drops none: a key is held for
``hold`` after it was first met (as the reference's sets have a time to live).
As long as a day was opened less than ``hold`` ago, a visitor that the state
lets through is new.  For any other day - opened longer ago, or known to the
store from another checkpoint - the state may have forgotten, and the few rows
that it lets through are looked up in the seen-visitor store.  A small table
of days and when each was opened tells the two apart.

State lives in RocksDB, on the executors' disks.  Before the shuffle by
visitor, a hot visitor's rows shrink to one a (JVM to Arrow) batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from daybook.operators.metrics import page_views, visitor_rows
from daybook.session import path_exists
from daybook.sinks.daily import DailyIncrements, write_batch
from daybook.sinks.totals import DailyTotals
from daybook.sinks.visitors import SeenVisitors, touched_days
from daybook.streaming.run import StreamRun, run_of
from daybook.streaming.stream import parse_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ADAPTIVE = "spark.sql.adaptive.enabled"
HOLD = dt.timedelta(days=2)
DAY_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()), T.StructField("opened_at", T.TimestampType()), T.StructField("alone", T.BooleanType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])


@contextmanager
def conf_set(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a checkpoint
    remembers its provider.  A batch without rows would only let expired keys
    go, at the price of a commit of every state partition; the next batch with
    rows does that too."""
    return conf_set(spark, {PROVIDER: ROCKSDB, NO_DATA_BATCHES: "false"})


def adaptive(spark: SparkSession):
    """Spark turns adaptive execution off in the session of a stateful query.
    What is done inside with a finished batch has it: without it the hint that
    sizes the store's files is ignored, and every state partition would write a
    file a day."""
    return conf_set(spark, {ADAPTIVE: "true"})


def _start(rows: DataFrame, step, checkpoint: str, trigger: dict | None, mode: str, name: str):
    def each(batch: DataFrame, batch_id: int) -> None:
        step(batch, run_of(batch.sparkSession, checkpoint), batch_id)

    w = rows.writeStream.foreachBatch(each).outputMode(mode).queryName(name).option("checkpointLocation", checkpoint)
    with rocksdb(rows.sparkSession):
        return (w.trigger(**trigger) if trigger else w).start()


# --- page views --------------------------------------------------------------

def start_pv_state_query(raw: DataFrame, totals: DailyTotals, checkpoint: str, trigger: dict | None = None):
    """Running daily page views of source rows (``value, ingest_ts``)."""
    counted = page_views(parse_batch(raw, ["pageUrl"])).groupBy("dt").agg(F.count(F.lit(1)).alias("amount"))
    return _start(counted, lambda b, run, i: totals.write(b, run.id, i), checkpoint, trigger, "update", "pv_state")


# --- visitors ----------------------------------------------------------------

def thinned(visitors: DataFrame) -> DataFrame:
    """``dt, unionid`` without repeats inside an Arrow batch."""
    def distinct(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            yield from pa.Table.from_batches([batch]).group_by(["dt", "unionid"]).aggregate([]).to_batches()
    return visitors.select("dt", "unionid").mapInArrow(distinct, "dt date, unionid string")


class StateDays:
    """When each day was opened in a run, and whether the store had none of
    its visitors then (``alone``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], DAY_SCHEMA)
        return self.spark.read.schema(DAY_SCHEMA).parquet(self.path)

    def covered(self, days: list, seen: SeenVisitors, run: StreamRun, batch_id: int, hold: dt.timedelta) -> list:
        """Those of ``days`` of which the state of ``run`` has all visitors;
        days met for the first time are opened."""
        # at least the time that the query's clock has for this batch
        now = self.spark.sql("SELECT current_timestamp()").first()[0].timestamp()
        mine = self.read().where((F.col("run") == run.id) & F.col("dt").isin(days))
        opened = {r["dt"]: r for r in mine.groupBy("dt").agg(F.min("opened_at").alias("at"), F.min("alone").alias("alone")).collect()}
        new = [(d, not seen.has_day(d)) for d in days if d not in opened]
        if new:
            rows = self.spark.createDataFrame(new, "dt date, alone boolean").withColumn("opened_at", F.lit(now).cast("timestamp"))
            write_batch(rows.select("dt", "opened_at", "alone").coalesce(1), self.path, run.id, batch_id)
        old = [d for d, r in opened.items() if r["alone"] and now - r["at"].timestamp() < hold.total_seconds()]
        return old + [d for d, alone in new if alone]


def add_unseen(visitors: DataFrame, days: StateDays, seen: SeenVisitors, uv: DailyIncrements, run: StreamRun, batch_id: int,
               hold: dt.timedelta) -> None:
    """What the state lets through: days it has all visitors of are appended
    as they are, the others looked up.  Very many days are all looked up.  A
    batch without new visitors writes nothing."""
    rows = visitors.select("dt", "unionid").persist()
    try:
        with adaptive(visitors.sparkSession):
            touched = touched_days(rows)
            if touched == []:
                return
            known = days.covered(touched, seen, run, batch_id, hold) if touched else []
            uv.write(seen.add(rows, run.id, batch_id, unseen_days=known), run.id, batch_id)
    finally:
        rows.unpersist()


def start_uv_state_query(raw: DataFrame, seen: SeenVisitors, uv: DailyIncrements, days: StateDays, checkpoint: str,
                         trigger: dict | None = None, hold: dt.timedelta = HOLD):
    """Running daily visitors of source rows (``value, ingest_ts``)."""
    seconds = f"{max(1, int(hold.total_seconds()))} seconds"
    fresh = (thinned(visitor_rows(parse_batch(raw, ["unionid"]))).withColumn("_at", F.current_timestamp())
             .withWatermark("_at", seconds).dropDuplicatesWithinWatermark(["dt", "unionid"]))
    return _start(fresh, lambda b, run, i: add_unseen(b, days, seen, uv, run, i, hold), checkpoint, trigger, "append", "uv_state")


# --- audit -------------------------------------------------------------------

def pv_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``dt, amount`` as the state of the page-view query holds them."""
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.select("key.dt", F.col("value.count").alias("amount"))


def uv_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``dt, amount``: how many visitors of each day the state holds."""
    rows = spark.read.format("statestore").load(checkpoint)
    return rows.groupBy("key.dt").agg(F.count(F.lit(1)).alias("amount"))
