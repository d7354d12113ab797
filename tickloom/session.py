"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", app: str = "tickloom", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    local = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "8",
    }
    for name, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the session names in `spark.checkpoint.dir`.

    Where none is named, a local session gets a temporary one; a cluster session is refused,
    because a folder on one machine would be invisible to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_open: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared one."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(folder)
    return folder


@contextmanager
def working_folders(spark: SparkSession) -> Iterator[None]:
    """Remove the folders that were made inside, at the end.

    For whoever writes the result inside: frames read from those folders are of no use afterwards.
    """
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open[:] = [other for other in _open if other is not made]
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for folder in made:
            path = hadoop(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
