"""Row counts around the seen-visitor lookup, one row a micro-batch.

The counts are observed in the job that writes the new visitors, so they cost
no job of their own.  Counting a batch again replaces its row; the second time
its own visitors are stored already and count as seen, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from daybook.session import path_exists
from daybook.sinks.daily import write_batch

COUNT_SCHEMA = T.StructType([
    T.StructField("before_n", T.LongType()), T.StructField("after_n", T.LongType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])


class FilterCounts:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def start(self) -> tuple[Observation, Observation]:
        return Observation(), Observation()

    def record(self, around: tuple[Observation, Observation], run: str, batch_id: int) -> None:
        """The observed sums, once the job has run; no rows count 0."""
        before, after = (o.get["n"] or 0 for o in around)
        write_batch(self.spark.range(1).select(F.lit(before).cast("long").alias("before_n"), F.lit(after).cast("long").alias("after_n")),
                    self.path, run, batch_id)

    def read(self) -> DataFrame:
        """``before_n, after_n, run, batch_id``."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], COUNT_SCHEMA)
        return self.spark.read.schema(COUNT_SCHEMA).parquet(self.path)
