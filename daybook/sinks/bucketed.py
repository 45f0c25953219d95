"""The seen-visitor store as a table bucketed by visitor.

Inside a day the visitors lie in a fixed number of buckets by hash, and a
lookup joins on that hash: the batch is shuffled to the buckets, the store is
read bucket by bucket and never shuffled, however large a day is.  The table is
external, so the files outlive the session's catalog, and opening the store in
another session finds its days again.  The number of buckets is fixed by the
first writer; choose it so that a bucket of a large day fits in a task.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.session import list_partitions
from daybook.sinks.visitors import SeenVisitors

BUCKETS = 64


class BucketedVisitors(SeenVisitors):
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, ttl: dt.timedelta | None = None):
        super().__init__(spark, path, ttl)
        self.buckets = buckets
        self.table = f"seen_visitors_{hashlib.md5(path.encode()).hexdigest()[:12]}"

    def _open(self) -> None:
        if self.spark.catalog.tableExists(self.table):
            return
        self.spark.sql(f"CREATE TABLE {self.table} (unionid STRING, run STRING, batch_id BIGINT, dt DATE) USING parquet "
                       f"PARTITIONED BY (dt) CLUSTERED BY (unionid) SORTED BY (unionid) INTO {self.buckets} BUCKETS "
                       f"LOCATION '{self.path}'")
        if list_partitions(self.spark, self.path, "dt"):
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")

    def read(self) -> DataFrame:
        self._open()
        return self.spark.table(self.table).select("unionid", "dt", "run", "batch_id")

    def _not_stored(self, visitors: DataFrame, days: list | None) -> DataFrame:
        # the day is compared beside the join key, which is the bucketed one alone
        known = self._of_days(days).select(F.col("unionid").alias("_known"), F.col("dt").alias("_day"))
        same_day = F.datediff("dt", "_day") == 0
        return visitors.join(known, (F.col("unionid") == F.col("_known")) & same_day, "left_anti")

    def _append(self, rows: DataFrame) -> None:
        self._open()
        rows = rows.select("unionid", "run", "batch_id", "dt").repartition(self.buckets, "unionid")
        rows.sortWithinPartitions("dt", "unionid").write.insertInto(self.table)

    def _drop_day(self, day: str) -> None:
        self._open()
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (dt = DATE'{day}')")
        super()._drop_day(day)
        self.spark.catalog.refreshTable(self.table)

    def compact(self, before) -> list[str]:
        done = super().compact(before)
        if done:
            self.spark.catalog.refreshTable(self.table)
        return done
