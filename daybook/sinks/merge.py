"""Merging the many small files of finished days or runs.

A streaming job leaves a folder a batch.  Once nothing writes to a folder any
more - a past day of the archive, a finished run of the outbox - its files are
rewritten into few, sized by the adaptive planner:

1. the merged files are written beside, under a hidden folder, and marked done
   by the writer's success file;
2. the old folders go;
3. the merged folder is moved into their place.

A call after a crash in between takes up the step that was reached, so no row is
lost or doubled; a reader that runs at the same time may miss the folder
between the last two steps.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from daybook.session import list_partitions, path_exists, remove_dir

MERGING = "_merging"


def _merge(spark: SparkSession, path: str, folder: str, inside: str, fmt: str) -> None:
    beside = f"{path}/{MERGING}/{folder}"
    if not path_exists(spark, f"{beside}/_SUCCESS"):
        rows = spark.read.format(fmt).load(f"{path}/{folder}").drop("run", "batch_id")
        rows.hint("rebalance").write.mode("overwrite").format(fmt).save(beside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, new, target = hadoop(f"{path}/{folder}"), hadoop(beside), hadoop(f"{path}/{folder}/{inside}")
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.mkdirs(target.getParent())
    fs.delete(hadoop(f"{beside}/_SUCCESS"), False)
    if not fs.rename(new, target):
        raise OSError(f"cannot move {beside} to {path}/{folder}/{inside}")


def _unfinished(spark: SparkSession, path: str, column: str) -> list[str]:
    return list_partitions(spark, f"{path}/{MERGING}", column)


def merge_days(spark: SparkSession, path: str, before, fmt: str = "text") -> list[str]:
    """Merge each day older than ``before`` of a table under ``dt, run,
    batch_id`` that more than one batch has written."""
    done = []
    for d in sorted({*list_partitions(spark, path, "dt"), *_unfinished(spark, path, "dt")}):
        runs = list_partitions(spark, f"{path}/dt={d}", "run")
        batches = sum(len(list_partitions(spark, f"{path}/dt={d}/run={r}", "batch_id")) for r in runs)
        if d < str(before) and (batches > 1 or d in _unfinished(spark, path, "dt")):
            _merge(spark, path, f"dt={d}", "run=merged/batch_id=0", fmt)
            done.append(d)
    return done


def merge_run(spark: SparkSession, path: str, run: str, fmt: str = "parquet") -> bool:
    """Merge the batches of a finished run of a table under ``run, batch_id``."""
    batches = list_partitions(spark, f"{path}/run={run}", "batch_id")
    if len(batches) < 2 and run not in _unfinished(spark, path, "run"):
        return False
    _merge(spark, path, f"run={run}", "batch_id=0", fmt)
    return True


def drop_leftovers(spark: SparkSession, path: str) -> None:
    """Remove what unfinished merges have written beside; they begin anew."""
    remove_dir(spark, f"{path}/{MERGING}")
