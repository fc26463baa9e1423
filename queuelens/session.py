"""SparkSession construction and shared-folder handling."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every queuelens job relies on.  Timestamps in the data are wall
# clock without a zone (TIMESTAMP_NTZ); parsing goes through the session zone,
# so it is pinned to UTC to make the round trip exact.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "queuelens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the queuelens defaults.

    On a cluster ``master`` stays None so spark-submit decides; locally the
    caller passes ``local[N]``.  The web UI is off: jobs here are batch runs.
    """
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_timezone(spark)
    return spark


def ensure_timezone(spark: SparkSession) -> None:
    """Pin the session zone to UTC (runtime-settable SQL conf)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


READ_BYTES = 16 << 20   # of a file that a task reads: star tables pack millions of rows into a default split
TASK_ROWS = 250_000     # rows, about, that a task of a shuffle gets before small ones are put together


def bounded_tasks(spark: SparkSession, rows: int) -> None:
    """Size the session's tasks for inputs of ``rows`` rows, so that their sorts stay in memory at any input size.

    Scans are split at READ_BYTES at most; shuffles start with a partition for
    TASK_ROWS rows, which adaptive execution merges up to its advisory size.
    """
    conf = spark._jsparkSession.sessionState().conf()
    if conf.filesMaxPartitionBytes() > READ_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(READ_BYTES))
    first = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))


def first_partitions(spark: SparkSession) -> int:
    """Partitions with which a shuffle starts, before adaptive execution merges them."""
    return spark._jsparkSession.sessionState().conf().numShufflePartitions()


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """A write of a table inside drops its shuffle files when it ends.

    Otherwise they stay on the executors' disks until the driver happens to
    collect its garbage, and those of several steps pile up.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set -- a local test run -- a private folder is created
    and registered as the checkpoint dir.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        ctx_dir = spark.sparkContext.getCheckpointDir()
        if ctx_dir:
            d = ctx_dir
    master = spark.sparkContext.master
    if not d and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="queuelens-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused); see :func:`drop_scratch`."""
    return "/".join([shared_dir(spark), "queuelens", spark.sparkContext.applicationId, *parts, uuid.uuid4().hex])


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put the folder ``staged`` in the place of ``path``: two renames on their file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    fs = dst.getFileSystem(conf)
    had = fs.exists(dst)
    if had and not fs.rename(dst, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(src, dst):
        if had:
            fs.rename(old, dst)
        raise OSError(f"cannot publish {staged} as {path}")
    if had:
        fs.delete(old, True)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete the folder ``path``, if it is there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table that :func:`scratch_path` handed out to this application."""
    drop_folder(spark, f"{shared_dir(spark)}/queuelens/{spark.sparkContext.applicationId}")
