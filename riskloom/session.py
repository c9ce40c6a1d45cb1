"""Session helpers.

The library never creates a cluster session on its own; callers pass one in.
``local_session`` is for tests / bench only.  ``checkpoint_dir`` reads the
shared folder the cluster names in ``spark.checkpoint.dir`` and only sets one
when it is unset (local runs).
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "riskloom") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Feature blocks aggregate 100+ expressions in one HashAggregate; generated
        # methods above HotSpot's 8000-bytecode JIT limit would run interpreted,
        # so fall back to per-operator code for those stages instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Only a ``local`` master may go without: it gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


ROWS_TO_SPREAD = 20_000   #: a part of a scan that is dealt over the cores has this many rows at least
MOST_ROWS_A_PART = 500_000  #: ... and a part of a frame that fits run over has this many at most


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a scan, dealt by key over the cores where its own tasks are fewer and its rows are many.

    A scan has tasks by file size.  A compact table whose rows are worked on for long (features, model fits) would
    keep one or two cores busy.
    """
    parts = min(df.sparkSession.sparkContext.defaultParallelism, df.count() // ROWS_TO_SPREAD)
    return df.repartition(parts, *keys) if parts > df.rdd.getNumPartitions() else df


def level(df: DataFrame) -> DataFrame:
    """The rows of a scan, dealt over the cores by all their columns where its fullest part has over 1.5 times an even share.

    The parts of a scan hold whole row groups: of files with few and large ones, some parts are empty and others
    full.  Rows are sorted in their parts, so that what is drawn by place (bootstraps) is drawn alike in every run.
    """
    held = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("_part")).count().collect()]  # a row per part
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(cores, sum(held) // ROWS_TO_SPREAD)
    if parts < 2 or max(held) * parts <= 1.5 * sum(held):
        return df
    if sum(held) > cores * MOST_ROWS_A_PART:  # full rounds of all cores
        parts = cores * -(-sum(held) // (cores * MOST_ROWS_A_PART))
    return df.repartition(parts, *df.columns).sortWithinPartitions(*df.columns)


def fit_frame(df: DataFrame) -> DataFrame:
    """The frame checkpointed, in no more parts than cores unless a part would pass ``MOST_ROWS_A_PART``.

    A fit takes a hundred steps and each part sends a result to the driver in every step.
    """
    out = cut_lineage(df)
    return out.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-out.count() // MOST_ROWS_A_PART)))


def cache_bytes(spark: SparkSession) -> int:
    """Bytes that all executors together have for cached rows and running tasks (the driver's own in local mode alone)."""
    sc = spark.sparkContext._jsc.sc()
    held, each = {}, sc.getExecutorMemoryStatus().iterator()
    while each.hasNext():
        entry = each.next()
        held[entry._1()] = entry._2()._1()
    if len(held) > 1:
        driver = sc.env().blockManager().blockManagerId()
        held.pop(f"{driver.host()}:{driver.port()}", None)
    return sum(held.values())


_fits = threading.Condition()
_fit_bytes: list[float] = []  #: of the fits that run now


@contextmanager
def fit_room(spark: SparkSession, size: float):
    """Held by a fit that keeps ``size`` bytes cached while it runs.

    A fit caches a copy of its rows.  It waits as long as the copies of all that run, its own included, would pass half
    of what the executors have for cached rows and tasks; where none runs, it need not wait.
    """
    with _fits:
        _fits.wait_for(lambda: not _fit_bytes or sum(_fit_bytes) + size <= cache_bytes(spark) / 2)
        _fit_bytes.append(size)
    try:
        yield
    finally:
        with _fits:
            _fit_bytes.remove(size)
            _fits.notify_all()
