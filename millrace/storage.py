"""Where intermediate tables go, and the few file-system steps Spark has no writer for.

Everything goes through the Hadoop file system of the path, so it works wherever
Spark can read and write.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

_SCRATCH = "_millrace_scratch"
#: Schemes of stores that rename a directory by copying what is in it.
COPYING_SCHEMES = ("s3", "s3a", "s3n", "gs", "wasb", "wasbs", "oss", "cosn", "obs", "swift")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one in the warehouse, which is shared too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared.rstrip("/") if shared else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{_SCRATCH}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that no other call was given."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession, older_than_hours: float) -> int:
    """Remove scratch entries last changed that long ago, finished stages among them; returns how many.

    Choose an age beyond the longest run: an entry still in use is not known here.
    """
    root = _path(spark, scratch_root(spark))
    files, before = _files(spark, root), time.time() * 1000 - older_than_hours * 3_600_000
    if not files.exists(root):
        return 0
    old = [s.getPath() for s in files.listStatus(root) if s.getModificationTime() < before]
    for path in old:
        files.delete(path, True)
    return len(old)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    location = _path(spark, path)
    return _files(spark, location).exists(location)


def remove_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        location = _path(spark, path)
        _files(spark, location).delete(location, True)


def beside(path: str, label: str) -> str:
    """A fresh path in the same directory; readers of that directory skip it for its first dot."""
    return f"{path.rstrip('/').rpartition('/')[0]}/.{label}-{uuid.uuid4().hex}"


def rename_copies(spark: SparkSession, path: str) -> bool:
    """Whether the path's store renames a directory file by file, by copying."""
    return _files(spark, _path(spark, path)).getUri().getScheme() in COPYING_SCHEMES


def replace_directory(spark: SparkSession, new: str, path: str) -> None:
    """Put the directory ``new`` in the place of ``path``, which is removed only after that.

    One step on file systems that have a rename. On object stores it copies, and readers
    may find nothing in between; tables, partitioned paths and run dates do without.
    """
    if rename_copies(spark, path):
        log.warning("%s is on a store without a rename of its own: its files are copied, and readers may miss them meanwhile", path)
    source, target, old = (_path(spark, p) for p in (new, path, beside(path, "old")))
    files = _files(spark, target)
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"cannot move {path} aside; its content is unchanged, the new one is in {new}")
    if not files.rename(source, target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"cannot move {new} to {path}")
    if replaced:
        files.delete(old, True)


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns in the directory names below a path, outermost first; it lists one directory a level."""
    location = _path(spark, path)
    files, found = _files(spark, location), []
    while True:
        inner = (
            s.getPath()
            for s in (files.listStatus(location) if files.exists(location) else [])
            if s.isDirectory() and "=" in s.getPath().getName() and s.getPath().getName()[0] not in "._"
        )
        location = next(inner, None)
        if location is None:
            return found
        unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found.append(unescape(location.getName().split("=", 1)[0]))


def child_directories(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, time of last change) of the directories in a directory."""
    location = _path(spark, path)
    files = _files(spark, location)
    listed = files.listStatus(location) if files.exists(location) else []
    return [(s.getPath().toString(), s.getModificationTime()) for s in listed if s.isDirectory()]


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, location):
    return location.getFileSystem(spark._jsc.hadoopConfiguration())
