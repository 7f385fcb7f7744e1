"""Intermediate tables in the shared folder the session names for checkpoints.

A written table cuts lineage: what was computed once stays the same for every later reader, also
after executors are lost.
"""

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing_lock = threading.Lock()
_freeing: list[str | None] = []  # the setting before each block that is open now


def root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    It lies in the folder that ``spark.checkpoint.dir`` names, else in the warehouse, which all
    executors reach as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/salesloom/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet and return the frame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of every job in the block as soon as it ends.

    For jobs whose result is stored: nothing reads their shuffles again, but Spark keeps them until
    the driver happens to collect its garbage, so that all steps of a query lie on the disks at once.
    Blocks may overlap in threads; the setting from before returns when the last one ends.
    """
    with _freeing_lock:
        _freeing.append(_freeing[0] if _freeing else spark.conf.get(_FREE, None))
        spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            before = _freeing.pop()
            if not _freeing and before is None:
                spark.conf.unset(_FREE)
            elif not _freeing:
                spark.conf.set(_FREE, before)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop(table: DataFrame) -> None:
    """Delete one intermediate table, once no frame reads it any more."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        _delete(table.sparkSession, folder)


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no frame reads them any more."""
    _delete(spark, root(spark))
