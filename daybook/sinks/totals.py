"""Daily totals as a stream emits them: the newest total of a day overwrites.

Each micro-batch writes the totals of the days it changed under its own
``run, batch_id``, so writing it again replaces what it wrote.  A day's total in
a run is that of the last batch that emitted it (``REPLACE INTO`` by reading);
runs, which begin to count anew, add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daybook.session import path_exists
from daybook.sinks.daily import write_batch

TOTAL_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()), T.StructField("amount", T.LongType()),
    T.StructField("create_time", T.TimestampType()), T.StructField("update_time", T.TimestampType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])


class DailyTotals:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, totals: DataFrame, run: str, batch_id: int, now: Column | None = None) -> None:
        """``totals``: ``dt, amount``; both times are set to the same."""
        now = now if now is not None else F.current_timestamp()
        rows = totals.select("dt", F.col("amount").cast("long").alias("amount"), now.alias("create_time"), now.alias("update_time"))
        write_batch(rows.coalesce(1), self.path, run, batch_id)  # one row a changed day

    def read(self) -> DataFrame:
        """Everything emitted: ``dt, amount, create_time, update_time, run, batch_id``."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], TOTAL_SCHEMA)
        return self.spark.read.schema(TOTAL_SCHEMA).parquet(self.path)

    def totals(self) -> DataFrame:
        """``dt, amount, create_time, update_time``."""
        last = F.max(F.struct("batch_id", "amount", "create_time", "update_time")).alias("x")
        return (self.read().groupBy("run", "dt").agg(last)
                .groupBy("dt").agg(F.sum("x.amount").alias("amount"), F.max("x.create_time").alias("create_time"),
                                   F.max("x.update_time").alias("update_time")))

    def amounts(self) -> DataFrame:
        return self.totals().select("dt", "amount")
