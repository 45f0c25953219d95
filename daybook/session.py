"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
import time
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Days are calendar days in UTC; every entry point runs its session in UTC.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast on an estimate: AQE turns a join into a broadcast join only
    # when the measured size of a side (after its shuffle) is under its bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # checkpointed intermediate results go when nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "daybook") -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Day boundaries are UTC days; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    A folder of our own is created only where the setting is unset and the
    master is local, as in tests; a cluster has to name shared storage.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="daybook-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


KEEP_HOURS = 24
RUNNING = "_running"  # one marker for each application that may still use its folders
_marked: set[tuple[str, str]] = set()


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder for one run of ``name``, owned by
    this application.  The first call of an application marks it as running and
    sweeps folders of finished ones."""
    base, app = f"{shared_dir(spark)}/daybook", spark.sparkContext.applicationId
    if (base, app) not in _marked:
        _marked.add((base, app))
        marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{RUNNING}/{app}")
        _file_system(spark, marker).mkdirs(marker)
        atexit.register(finish, spark)
        sweep(spark, base)
    return f"{base}/{name}/{app}/{uuid.uuid4().hex}"


def finish(spark: SparkSession) -> None:
    """Say that this application no longer uses its folders; done at exit
    where the session still runs then.  An application that died keeps its
    marker, and so its folders, until somebody removes the marker."""
    sc = spark.sparkContext
    try:
        if sc._jsc is None or sc._jsc.sc().isStopped():
            return
    except (Py4JError, OSError):  # at exit the JVM may be gone
        return
    for base, app in [m for m in _marked if m[1] == sc.applicationId]:
        remove_dir(spark, f"{base}/{RUNNING}/{app}")
        _marked.discard((base, app))


def sweep(spark: SparkSession, base: str, hours: float = KEEP_HOURS) -> None:
    """Remove the folders under ``base`` of applications that are known to have
    finished, ``hours`` after their folder last changed.  Age alone removes
    nothing: a stage may read its input for days."""
    if not path_exists(spark, base):
        return
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs, before = _file_system(spark, root), (time.time() - 3600 * hours) * 1000
    for name in fs.listStatus(root):
        if not name.isDirectory() or name.getPath().getName() == RUNNING:
            continue
        for app in fs.listStatus(name.getPath()):
            if app.getModificationTime() < before and not path_exists(spark, f"{base}/{RUNNING}/{app.getPath().getName()}"):
                fs.delete(app.getPath(), True)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder and all in it."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the Hadoop file system that serves it."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=<value>`` folders directly under ``path``."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = f"{column}="
    return [st.getPath().getName()[len(prefix):] for st in fs.listStatus(hpath)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files directly under ``path``."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(st.getPath()) for st in fs.listStatus(hpath)
            if st.isFile() and not st.getPath().getName().startswith(("_", "."))]


def delete_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
