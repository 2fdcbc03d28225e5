"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # SQL text may quote mixed-case columns as it does elsewhere: t."PULocationID".
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.adaptive.enabled": "true",
    # Keys that hold a large share of the rows are split at run time, at the price of a further shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "fareloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the package is written for.

    ``master`` stays unset under spark-submit, where the cluster names it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Paths handed out below the shared folder: by the innermost temporary() of this thread, or for sweep().
_HANDED_OUT: list[str] = []
_SCOPE: ContextVar[list[str]] = ContextVar("scratch", default=_HANDED_OUT)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session on one machine that does not name it, as in a trial, gets a folder of its own; on
    a cluster that is an error, since other executors could not reach it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="fareloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _SCOPE.get().append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """The path's Hadoop file system, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    system, place = file_system(spark, path)
    system.delete(place, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is written to the shared folder inside goes when the block ends."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            remove_path(spark, path)


def sweep(spark: SparkSession) -> None:
    """Remove all else written to the shared folder so far; frames that still read it end."""
    while _HANDED_OUT:
        remove_path(spark, _HANDED_OUT.pop())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system; a failure to reach it is raised."""
    system, place = file_system(spark, path)
    return system.exists(place)


_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """The shuffle files of every job inside go when the job ends.

    Else they stay until the driver's garbage collector finds them, so that those of all jobs of a load add up on the disks.
    """
    return setting(spark, _FILE_CLEANUP, "true")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives lost executors and gives the planner exact sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

