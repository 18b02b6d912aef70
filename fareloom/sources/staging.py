"""Shared scratch folder and staged tables.

A staged table is a small intermediate result written to the shared folder and read back. That
does two things: the optimizer sees its true size, so it broadcasts it only when it is within
`spark.sql.autoBroadcastJoinThreshold` and plans a skew-splitting sort-merge join otherwise; and
a lost executor never forces the work behind it to be done again.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Folder made for a local session that names none, per application.
_local_folders: dict[str, str] = {}

# Scratch folders handed out and not yet released.
_staged: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local master gets a temporary folder of its own when the setting is missing; on a
    cluster that folder would not be visible to the other machines.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="fareloom-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, until `release`."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Remove all scratch folders made so far; frames built on them are done with.

    Returns how many there were.
    """
    paths, _staged[:] = list(_staged), []
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on whatever file system they are."""
    files, target = _file_system(spark, pattern)
    return [str(f.getPath().toString()) for f in files.globStatus(target) or []]


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this package wrote, on whatever file system it is."""
    files, target = _file_system(spark, path)
    files.delete(target, True)
