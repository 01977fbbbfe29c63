"""Session defaults and lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import SparkConf
from pyspark.sql import DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# What a cluster session should run with. Shuffle partitions start high and are coalesced by
# adaptive execution to the advisory size, so one setting serves megabytes and terabytes.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # Composing plans is a noticeable share of a small job; skip the call-site capture per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int = "*", app: str = "martloom", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench, with a shared folder of its own if none is set."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if not SparkConf().contains(CHECKPOINT_DIR):
        builder = builder.config(CHECKPOINT_DIR, os.path.join(tempfile.gettempdir(), f"{app}-{uuid.uuid4().hex}"))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return named.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/martloom/{spark.sparkContext.applicationId}"


_recorded: ContextVar[list[str] | None] = ContextVar("recorded", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    paths = _recorded.get()
    if paths is not None:
        paths.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The scratch paths made in this block, so that they can be dropped when what was built from them is stored."""
    paths: list[str] = []
    token = _recorded.set(paths)
    try:
        yield paths
    finally:
        _recorded.reset(token)


def drop_scratch(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Remove the given scratch paths, or all that this application stored in the shared folder.

    Call it when the frames that read them are done with. Shuffle files go when the driver's collector finds their frames
    unused, so it is asked to look.
    """
    for name in [_scratch_root(spark)] if paths is None else paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def materialize(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a frame is read several times: the rows are computed once, the lineage ends in
    replicated files instead of executor memory, and later readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(observation: Observation, *names: str) -> dict[str, int]:
    """The observed counts. A plan that the optimizer finds to be empty reports none: they are zero."""
    return observation.get if observation._jo.getRow().length() else dict.fromkeys(names, 0)
