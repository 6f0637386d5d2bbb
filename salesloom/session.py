"""Spark session for local work, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "salesloom") -> SparkSession:
    """A session on this machine; clusters bring their own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # the limit is on compressed files, whose rows take far more room when broadcast
        .config("spark.sql.autoBroadcastJoinThreshold", "1MB")
        # join by hash instead of sorting once every partition is known to be small
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, gets a
    folder of its own when the setting is missing.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder, never used before."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes, when it ends, the folders that ``fresh_folder`` named meanwhile.

    For jobs that write their results elsewhere; a frame that reads such a
    folder cannot be used afterwards.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        settings = spark._jsc.hadoopConfiguration()
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(settings).delete(place, True)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Gives a setting another value for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def little_disk(spark: SparkSession) -> Iterator[None]:
    """For long jobs: shuffle files go when what wrote them has ended, and Parquet is packed closer.

    Else Spark keeps shuffle files until the driver happens to collect its
    garbage. A frame that is run again meanwhile makes its shuffles anew. A
    codec that the session names is left as it is.
    """
    codec = spark.conf.get("spark.sql.parquet.compression.codec", None) or "zstd"
    with (
        setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"),
        setting(spark, "spark.sql.parquet.compression.codec", codec),
    ):
        yield


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the written copy.

    Work that reads the result more than once then does it once, the copy
    outlives any executor, and its size is known: Spark broadcasts it in a
    later join only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return stored_together([frame], label)


def stored_together(frames: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of frames of one layout, written one frame after the other, as ``stored`` does one."""
    path = None
    for frame in frames:
        path = path or fresh_folder(frame.sparkSession, label)
        frame.write.mode("append").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_folder: str | None = None
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def _own_folder() -> str:
    global _folder
    if _folder is None or not os.path.isdir(_folder):
        _folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        atexit.register(shutil.rmtree, _folder, ignore_errors=True)
    return _folder
