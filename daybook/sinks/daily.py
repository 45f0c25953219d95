"""Daily metrics as an append-only table of increments.

Each micro-batch appends ``dt, n`` under its own ``run, batch_id`` folder and
a day's amount is the sum of its increments.  Writing a batch again replaces
that folder only, so a replay after a crash changes nothing and no crash can
touch what earlier batches wrote; a new checkpoint is a new run and adds to
the totals.  There is no read-modify-write, hence no lookup, no watermark and
no state: a row counts for its day however late it comes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql import Window

from daybook.session import list_partitions, path_exists, remove_dir

INCREMENT_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()), T.StructField("n", T.LongType()),
    T.StructField("create_time", T.TimestampType()), T.StructField("update_time", T.TimestampType()),
    T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType()),
])


def write_batch(rows: DataFrame, path: str, run: str, batch_id: int, by: list[str] | None = None,
                fmt: str = "parquet", codec: str | None = None) -> None:
    """Write the rows of one micro-batch under ``[by...,] run, batch_id``;
    writing it again replaces what it wrote before."""
    w = (rows.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*(by or []), "run", "batch_id").format(fmt))
    (w.option("compression", codec) if codec else w).save(path)


class DailyIncrements:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._batches, self._folded = f"{path}/batches", f"{path}/folded"

    def write(self, deltas: DataFrame, run: str, batch_id: int, now: Column | None = None) -> None:
        """``deltas``: ``dt, n``, one row per day the batch touched."""
        now = now if now is not None else F.current_timestamp()
        write_batch(deltas.select("dt", F.col("n").cast("long").alias("n"), now.alias("create_time"),
                                  now.alias("update_time")), self._batches, run, batch_id)

    def read(self) -> DataFrame:
        """``dt, n, create_time, update_time, run, batch_id`` (batch NULL: a
        folded run)."""
        empty = self.spark.createDataFrame([], INCREMENT_SCHEMA)
        folded = list_partitions(self.spark, self._folded, "run")
        out = empty
        if path_exists(self.spark, self._batches):
            out = self.spark.read.schema(INCREMENT_SCHEMA).parquet(self._batches)
            if folded:  # one name per finished run
                out = out.where(~F.col("run").isin(folded))
        if folded:
            out = out.unionByName(self.spark.read.schema(INCREMENT_SCHEMA).parquet(self._folded))
        return out

    def totals(self) -> DataFrame:
        """``dt, amount, create_time, update_time``."""
        return self.read().groupBy("dt").agg(
            F.sum("n").alias("amount"), F.min("create_time").alias("create_time"),
            F.max("update_time").alias("update_time"))

    def amounts(self) -> DataFrame:
        return self.totals().select("dt", "amount")

    def running(self, run: str) -> DataFrame:
        """``batch_id, dt, amount``: totals after each batch of a run that
        touched the day (a days x batches table)."""
        w = Window.partitionBy("dt").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
        return (self.read().where(F.col("run") == run)
                .select("batch_id", "dt", F.sum("n").over(w).alias("amount")))

    def fold(self, run: str) -> None:
        """Replace the many small files of a finished run by one row per day.

        From the commit of the folded rows on, the run's own folders are not
        read any more, so a crash before they are removed changes nothing.
        """
        if run not in list_partitions(self.spark, self._folded, "run"):
            rows = (self.read().where(F.col("run") == run).groupBy("dt", "run")
                    .agg(F.sum("n").alias("n"), F.min("create_time").alias("create_time"),
                         F.max("update_time").alias("update_time"))
                    .withColumn("batch_id", F.lit(None).cast("long")))
            # one row a day in one file, which its commit moves into place whole
            (rows.coalesce(1).write.mode("append").partitionBy("run").parquet(self._folded))
        remove_dir(self.spark, f"{self._batches}/run={run}")
