"""Where derived tables and stream checkpoints go."""

from __future__ import annotations

import tempfile
import time
import uuid
from datetime import timedelta

from pyspark.sql import SparkSession


_local_root: list[str] = []


def workspace_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a ``local`` session without that setting may fall back to a temporary folder; on a cluster
    a folder of one machine is invisible to the others and dies with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not (spark.conf.get("spark.master", None) or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="tidecast-"))
    return _local_root[0]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the workspace; nothing is created yet."""
    return f"{workspace_root(spark)}/tidecast/{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    """A path of the shared store, and the store."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a derived folder from the shared store; only one that no plan still to run reads."""
    folder, store = _path(spark, path)
    store.delete(folder, True)


def make_folder(spark: SparkSession, path: str) -> None:
    folder, store = _path(spark, path)
    store.mkdirs(folder)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder to a place that is not taken."""
    folder, store = _path(spark, path)
    if not store.rename(folder, _path(spark, target)[0]):
        raise OSError(f"cannot move {path} to {target}")


def _listed(spark: SparkSession, path: str) -> list:
    folder, store = _path(spark, path)
    return list(store.listStatus(folder)) if store.exists(folder) else []


def has_files(spark: SparkSession, path: str, prefix: str = "") -> bool:
    """Whether a folder of the shared store has entries whose names begin so."""
    return any(status.getPath().getName().startswith(prefix) for status in _listed(spark, path))


def subfolders(spark: SparkSession, path: str, older_than: timedelta | None = None) -> list[str]:
    """Names of the folders in a folder; only those not written to for a time, if one is given.  No names if there is no such folder."""
    latest = time.time() - older_than.total_seconds() if older_than else None
    found = [s for s in _listed(spark, path) if s.isDirectory() and (latest is None or s.getModificationTime() / 1000 <= latest)]
    return sorted(s.getPath().getName() for s in found)
