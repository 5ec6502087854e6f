"""Session helpers: building a session for tests / bench, and the shared
staging area used to cut lineage.

Staging lives under ``spark.checkpoint.dir`` - the shared folder a cluster
names for reliable checkpoints. We read it from the session and only pick our
own folder when it is unset (local tests).
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STAGE_SUBDIR = "partweave-stage"


def build_session(
    master: str | None = "local[*]",
    app_name: str = "partweave",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session configured the way the library expects.

    * AQE on, with skew-join splitting and partition coalescing.
    * Static, estimate-based broadcast joins off: an estimate from file sizes is
      not a size bound. Broadcasts happen either where the code has checked the
      size (``checked_broadcast``) or at runtime by AQE, from measured shuffle
      sizes (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    * ``shuffle_partitions`` only when given: the cluster's own setting stands.
      ``master=None`` takes what ``spark-submit`` provides.
    * UTC session time zone, so ``year()`` of a timestamp is machine independent.
    """
    b = (
        (SparkSession.builder.master(master) if master else SparkSession.builder)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    stage_root(spark)
    return spark


class NoSharedFolder(RuntimeError):
    """A cluster session names no ``spark.checkpoint.dir``."""


def stage_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session (tests) that names none gets a fresh local
    folder; on a cluster a machine-local folder would vanish with its
    executor, so the setting is required there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise NoSharedFolder("set spark.checkpoint.dir to a shared folder (HDFS / object store) for staged tables")
        root = tempfile.mkdtemp(prefix="partweave-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


# Paths staged inside the running ``stage_alone`` calls, the innermost last.
_OPEN: list[list[str]] = []


def new_stage_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused path under the staging root."""
    path = f"{stage_root(spark)}/{_STAGE_SUBDIR}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def stage_alone(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> DataFrame:
    """``stage(make(), tag)``, after which the tables that ``make`` and its frame's plan staged are
    deleted: nothing reads them once the frame is written. What was staged before stays. Calls may nest;
    other threads must not stage meanwhile."""
    inner: list[str] = []
    _OPEN.append(inner)
    try:
        df = make()
        _OPEN.append([])
        try:
            return stage(df, tag)
        finally:
            kept = _OPEN.pop()
            if len(_OPEN) > 1:  # the enclosing call deletes it
                _OPEN[-2].extend(kept)
    finally:
        _OPEN.pop()
        for path in inner:
            delete_path(spark, path)


# Files a task has open at once when it writes folders of parts; with more parts the rest is sorted.
_OPEN_FILES_CONF, OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", 32
_UNSORTED: dict[str, list] = {}
_UNSORTED_LOCK = threading.Lock()


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Inside, ``partitionBy`` writes keep a file open for each folder, up to ``OPEN_FILES`` a task,
    instead of sorting a task's rows by folder first: a sort holds, or spills, all of them. The
    session's own setting, if it has one, stands. Threads may overlap; the last one out resets it."""
    app = spark.sparkContext.applicationId
    with _UNSORTED_LOCK:
        count = _UNSORTED.setdefault(app, [0, False])
        if count[0] == 0 and int(spark.conf.get(_OPEN_FILES_CONF, "0")) == 0:
            spark.conf.set(_OPEN_FILES_CONF, str(OPEN_FILES))
            count[1] = True
        count[0] += 1
    try:
        yield
    finally:
        with _UNSORTED_LOCK:
            count[0] -= 1
            if count[0] == 0 and count[1]:
                spark.conf.unset(_OPEN_FILES_CONF)
                count[1] = False


def delete_path(spark: SparkSession, path: str) -> None:
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    to.getFileSystem(spark._jsc.hadoopConfiguration()).delete(to, True)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet under the staging root and return the re-read
    DataFrame: a lineage cut that survives executor loss, with column pruning
    and filter pushdown on every later read (unlike an RDD checkpoint)."""
    return stage_counted(df, tag)[0]


def stage_counted(df: DataFrame, tag: str) -> tuple[DataFrame, int]:
    """``stage`` that also returns the row count, observed during the write
    itself (``DataFrame.observe``) - no second pass."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = new_stage_path(spark, tag)
    # Unique per write: stages run concurrently from several threads.
    obs = Observation(f"pw_{tag}_{uuid.uuid4().hex}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path), int(obs.get["rows"])


def drop_stages(spark: SparkSession) -> None:
    """Deletes the tables that this application staged. Call it once everything
    that reads them is written."""
    delete_path(spark, f"{stage_root(spark)}/{_STAGE_SUBDIR}/{spark.sparkContext.applicationId}")
