"""Session helpers.

Library operators never build a session; they take DataFrames. These helpers
are for tests, the bench and the driver entry point, plus the two session
lookups operators need (checkpoint folder, broadcast size limit).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  checkpoint_dir: str | None = None) -> SparkSession:
    """A local session configured the way tests and the bench run.

    A checkpoint folder is set only when none is configured: on a cluster the
    operator passes ``spark.checkpoint.dir`` (a shared folder) and it wins.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quarry")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """Return the session's checkpoint folder; set ``fallback`` only if unset.

    Local runs (tests, bench) pass no fallback and get a fresh scratch folder
    under /tmp; a cluster session always has ``spark.checkpoint.dir`` set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    target = conf or fallback
    if target is None and sc.master.startswith("local"):
        target = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    if target is None:
        return None
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a small intermediate once and keep it for reuse.

    With a checkpoint folder the result is written there (reliable, lineage cut,
    survives executor loss). Without one it is persisted memory-and-disk; lost
    blocks are then recomputed from lineage.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir():
        return df.checkpoint(eager=True)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


_SCOPES: list[list[DataFrame]] = []


def keep(df: DataFrame) -> DataFrame:
    """Persist a small intermediate (memory and disk) for reuse by later jobs.

    Lazy: the first action that needs it fills it. Lost blocks are recomputed
    from lineage, so this is for short lineages; loops use ``materialize``. Inside a
    ``kept_scope`` it is released at the scope's end.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _SCOPES:
        _SCOPES[-1].append(kept)
    return kept


@contextmanager
def kept_scope() -> Iterator[None]:
    """Release what ``keep`` persisted inside, for long-running applications.

    Results are lazy: use them (write, collect) before the scope ends.
    """
    own: list[DataFrame] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        _SCOPES.remove(own)
        for df in own:
            df.unpersist()


def broadcast_byte_limit(spark: SparkSession) -> int:
    """The session's ``spark.sql.autoBroadcastJoinThreshold`` in bytes (0: never)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20),
                      ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    return max(0, int(float(raw) * mult))
