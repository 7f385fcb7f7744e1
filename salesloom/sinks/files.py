"""Writers. Bronze, silver and a run's set of reports are new versions each time."""

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import scratch, versions


def write_bronze(df: DataFrame, path: str) -> str:
    """Raw lines as they arrive. Returns the version's folder."""
    version = versions.new(path)
    df.write.parquet(version)
    versions.prune(df.sparkSession, path)
    return version


def write_silver(df: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Enriched lines in one folder per order month, which period filters prune. Returns the
    version's folder.

    The rebalance keeps files near the advisory size: small months share a task, and a month that
    holds much of the data is split over many tasks. Row ids are sorted within each file. ``finish``
    adds columns line by line after the rebalance, so that they are not shuffled.
    """
    period = ["order_year", "order_month"]
    order = [*period, "row_id"] if "row_id" in df.columns else period
    balanced = df.hint("rebalance", *[F.col(c) for c in period]).sortWithinPartitions(*order)
    if finish is not None:
        balanced = finish(balanced)
    version = versions.new(path)
    with scratch.freeing(df.sparkSession):
        balanced.write.partitionBy(*period).parquet(version)
    versions.prune(df.sparkSession, path)
    return version


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` stored lines by row id.

    The ids alone are read to find the last one wanted. The filter on it then lets the reader skip
    row groups, so whole lines are read only near the start.
    """
    ids = df.select("row_id").where(F.col("row_id").isNotNull()).orderBy("row_id").limit(n)
    last = ids.agg(F.max("row_id")).first()[0]
    return df.where(F.col("row_id") <= F.lit(last).cast("bigint")).orderBy("row_id").limit(n)


def write_sample(df: DataFrame, path: str, n: int = 50) -> None:
    """The first ``n`` stored lines as CSV with a header."""
    first_rows(df, n).write.mode("overwrite").option("header", True).csv(path)


def write_summaries(summaries: dict[str, DataFrame], folder: str) -> None:
    for name, table in summaries.items():
        table.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def write_quality(report: DataFrame, path: str) -> None:
    """The quality report (at most nine rows) as one JSON object of check and verdict."""
    checks = F.map_from_entries(
        F.collect_list(F.struct(F.col("check_name"), F.col("passed")))
    )
    report.agg(F.to_json(checks).alias("value")).write.mode("overwrite").text(path)


MANIFEST = "manifest"


class AnotherWriter(RuntimeError):
    """A set of reports was finished while this one was being written."""


@contextmanager
def report_set(spark: SparkSession, path: str, made_of: dict[str, str]) -> Iterator[str]:
    """A folder for the small outputs of one run, which count together or not at all.

    The manifest is written when the block has ended without an error. It names the files of the run
    and what they were ``made_of``, and then the set counts. A run that finds another one finished
    since it began leaves that one in place and raises :class:`AnotherWriter`.
    """
    before = versions.current(spark, path)
    folder = versions.new(path)
    yield folder
    if versions.current(spark, path) != before:
        raise AnotherWriter(f"{path}: another run has finished since this one began")
    names = versions.names_in(spark, folder)
    line = json.dumps({"folder": folder, "files": names, **made_of})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{folder}/{MANIFEST}")
    versions.finish(spark, folder)
    versions.prune(spark, path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest of the newest finished set of reports, or None."""
    folder = versions.current(spark, path)
    if folder is None:
        return None
    return json.loads(spark.read.text(f"{folder}/{MANIFEST}").first()[0])
