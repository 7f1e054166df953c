"""Session defaults and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "arena", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on (AQE, UTC, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.files.minPartitionNum": "64",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="arena-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors, unlike a local one."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)


def stored_rows(df: DataFrame, name: str) -> DataFrame:
    """The rows written below the scratch root and read again: computed once, and safe when executors are lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_together(spark: SparkSession, **tables: Callable[[], DataFrame]) -> dict[str, DataFrame]:
    """Tables that do not need each other, written at the same time; each is planned in its own thread with the caller's job settings."""
    write = lambda name, build: stored_rows(build(), name)
    with ThreadPoolExecutor(len(tables)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(write), name.replace("_", "-"), build) for name, build in tables.items()}
        return {name: job.result() for name, job in running.items()}
