"""The folder all executors share, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder in use, else that of ``spark.checkpoint.dir``; a temporary one
    in local mode only."""
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return _temporary_dir()


@cache
def _temporary_dir() -> str:
    return tempfile.mkdtemp(prefix="starledger-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a directory that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def new_folder(spark: SparkSession, prefix: str) -> str:
    """A fresh path under the shared folder. Nothing is created yet."""
    return f"{shared_dir(spark)}/{prefix}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as that file system takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, folder = file_system(spark, path)
    if fs.exists(folder):
        fs.delete(folder, True)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, size and time of change of the files that reading a path would read."""
    fs, pattern = file_system(spark, path)
    found = []
    for status in fs.globStatus(pattern) or ():
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            file = files.next()
            name = file.getPath().toString()
            if not any(part.startswith(("_", ".")) for part in name[len(status.getPath().toString()) :].split("/")):
                found.append((name, file.getLen(), file.getModificationTime()))
    return sorted(found)


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows, written once and read from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
