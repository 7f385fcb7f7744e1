"""Stored tables that are whole or absent.

A writer fills a new folder ``v-<time>-<id>`` below the table's path and never touches an older one.
A version counts once it holds ``_SUCCESS``, which is written last, and readers take the newest that
counts. A write that fails or is killed therefore leaves what was there before.
"""

import time
import uuid

from pyspark.sql import SparkSession

MARK = "_SUCCESS"


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def new(path: str) -> str:
    """Folder for a new version; later ones sort after earlier ones."""
    return f"{path.rstrip('/')}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def name_of(version: str) -> str:
    return version.rstrip("/").rsplit("/", 1)[1]


def is_complete(spark: SparkSession, path: str) -> bool:
    mark, fs = _path(spark, f"{path}/{MARK}")
    return fs.exists(mark)


def finish(spark: SparkSession, version: str) -> None:
    """Make a version of several tables count."""
    mark, fs = _path(spark, f"{version}/{MARK}")
    fs.create(mark, True).close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    folder, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def complete(spark: SparkSession, path: str) -> list[str]:
    """Versions that count, the newest first."""
    found = (f"{path.rstrip('/')}/{n}" for n in names_in(spark, path)[::-1] if n.startswith("v-"))
    return [v for v in found if is_complete(spark, v)]


def current(spark: SparkSession, path: str) -> str | None:
    """The newest version that counts, or the path itself if it is a finished table."""
    found = complete(spark, path)
    if found:
        return found[0]
    return path if is_complete(spark, path) else None


def _delete(spark: SparkSession, path: str) -> None:
    folder, fs = _path(spark, path)
    fs.delete(folder, True)


def prune_groups(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the newest ``keep`` folders of versions, each of which bears a version's name."""
    names = [n for n in names_in(spark, path)[::-1] if n.startswith("v-")]
    for name in names[keep:]:
        _delete(spark, f"{path.rstrip('/')}/{name}")


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete finished versions but the newest ``keep``, which readers may still hold, and unfinished
    ones older than the newest finished one: what they were to replace has been replaced."""
    found = complete(spark, path)
    for version in found[keep:]:
        _delete(spark, version)
    if found:
        for name in names_in(spark, path):
            version = f"{path.rstrip('/')}/{name}"
            if name.startswith("v-") and name < name_of(found[0]) and not is_complete(spark, version):
                _delete(spark, version)
