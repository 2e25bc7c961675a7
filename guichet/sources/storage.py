"""Folders on the cluster's file system: publish, purge, and where exports may go."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

from guichet import fixed_values as fv

#: for the files, on file systems that take it per write
UMASK = "077"


class StorageError(ValueError):
    """A destination that may not be used."""


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; empty if there is no such folder."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def purge(spark: SparkSession, path: str) -> bool:
    """Remove an export with everything in it; True if there was one."""
    fs, target = _file_system(spark, path)
    return bool(fs.exists(target) and fs.delete(target, True))


def _aside(path: str) -> str:
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.old"


def settle(spark: SparkSession, target: str) -> None:
    """Finish a move that broke off: the old folder comes back if no new one is in its place."""
    fs, destination = _file_system(spark, target)
    old = _file_system(spark, _aside(target))[1]
    if fs.exists(old):
        if fs.exists(destination):
            fs.delete(old, True)
        elif not fs.rename(old, destination):
            raise StorageError("The folder from before could not be moved back")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder into place, replacing what is there.

    What was there stays beside it until the new folder is in place, and comes back if that
    fails; after a lost driver ``settle`` does so.
    """
    settle(spark, target)
    fs, destination = _file_system(spark, target)
    old = _file_system(spark, _aside(target))[1]
    fs.mkdirs(destination.getParent())
    if fs.exists(destination) and not fs.rename(destination, old):
        raise StorageError("The folder from before could not be moved aside")
    draft = _file_system(spark, source)[1]
    if not fs.exists(draft) or not fs.rename(draft, destination):
        settle(spark, target)
        raise StorageError("The finished folder could not be moved into place")
    fs.delete(old, True)


def private_folder(spark: SparkSession, path: str) -> None:
    """A new, empty folder that only its owner can enter; what is written into it is out of reach for others."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)
    fs.mkdirs(target)
    fs.setPermission(target, spark._jvm.org.apache.hadoop.fs.permission.FsPermission("700"))


@dataclass(frozen=True)
class ExportTarget:
    """A checked destination of an export."""

    path: str

    @property
    def staging(self) -> str:
        parent, _, name = self.path.rpartition("/")
        return f"{parent}/.{name}.tmp"


def check_export_path(path: str) -> ExportTarget:
    """The destination of an export: a Parquet folder that no Git work tree, this one included, can pick up.

    A path of another file system than the local one is in no work tree.
    """
    if not path.lower().endswith(fv.EXPORT_EXTENSION):
        raise StorageError(f"{fv.EXPORT_EXTENSION} is the only kind of export there is")
    place = urlsplit(path)
    if place.scheme not in ("", "file"):
        return ExportTarget(path)
    local = os.path.realpath(os.path.expanduser(place.path))
    above = local
    while (above := os.path.dirname(above)) != os.path.dirname(above):
        if os.path.lexists(os.path.join(above, ".git")):
            raise StorageError(f"Exports stay out of version control, and {above} is under it")
    return ExportTarget(local)


def write_guarded(df: DataFrame, target: ExportTarget, gate: Callable[[], None] = lambda: None) -> None:
    """Write a hidden folder with owner-only access, run the gate, then move it into place.

    A failed write or gate leaves nothing behind. Every task writes its own file; readers
    never see a folder that is not finished.
    """
    spark = df.sparkSession
    try:
        private_folder(spark, target.staging)
        df.write.mode("append").option("fs.permissions.umask-mode", UMASK).parquet(target.staging)
        gate()
        move(spark, target.staging, target.path)
    except Exception:
        purge(spark, target.staging)
        raise
