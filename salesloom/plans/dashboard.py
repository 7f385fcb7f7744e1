"""The dashboard's data: the stored cubes of a version of the sales table, and panels over them."""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from salesloom import versions
from salesloom.operators import cubes
from salesloom.operators.panels import filter_period
from salesloom.sources.files import read_sales

COLUMNS = (
    "order_year",
    "order_month",
    "revenue",
    "quantity",
    "order_id",
    "customer_id",
    "customer_name",
    "product_id",
    "product_name",
    "segment",
    "category",
    "city",
    "region",
)


@dataclass(frozen=True)
class Dashboard:
    """Lazy panels of one selection, and its lines for questions of one's own."""

    selection: DataFrame
    panels: dict[str, DataFrame]

    def close(self) -> None:
        self.selection.unpersist()


def cube_folder(path: str, version: str) -> str:
    """Where the cubes of a version of stored sales lie, version by version themselves."""
    return f"{path.rstrip('/')}_cubes/{versions.name_of(version)}"


def stored_cubes(spark: SparkSession, path: str, rebuild: bool = False) -> str:
    """Folder of the finished cubes of the newest sales; they are built where there are none.

    Cubes of two earlier versions of the sales stay for those who read them. Two sessions that build
    at once make two sets, each whole.
    """
    version = versions.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"Missing {path}. Run the batch job first.")
    folder = cube_folder(path, version)
    # A table without versions can change under its name, so its cubes are not used again.
    found = None if rebuild or version == path else versions.current(spark, folder)
    if found is None:
        found = versions.new(folder)
        cubes.store(read_sales(spark, path).select(*COLUMNS), found)
        versions.finish(spark, found)
        versions.prune(spark, folder, keep=1)
        versions.prune_groups(spark, f"{path.rstrip('/')}_cubes", keep=3)
    return found


def open_dashboard(
    spark: SparkSession,
    path: str,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    keep: bool = False,
) -> Dashboard:
    """Panels over stored sales.

    The first opening of a version of the sales stores its cubes, which all later ones share, also
    those of other sessions and for other months: no panel reads the lines again. ``keep`` holds the
    lines of the selection on the executors for questions of one's own.
    """
    years, months = (None if x is None else list(x) for x in (years, months))
    folder = stored_cubes(spark, path)
    tables = {
        name: filter_period(spark.read.schema(schema).parquet(f"{folder}/{name}"), years, months)
        for name, schema in SCHEMAS.items()
    }
    selection = filter_period(read_sales(spark, path), years, months).select(*COLUMNS)
    if keep:
        selection = selection.persist(StorageLevel.MEMORY_AND_DISK)
    return Dashboard(selection, cubes.panels(tables))


_MONTH = "order_year int, order_month int"
_SUMS = f"cube_revenue {cubes.MONEY}, cube_quantity bigint, cube_orders bigint, cube_unknown boolean"
SCHEMAS = {
    "monthly": f"segment string, category string, region string, cube_revenue {cubes.MONEY}, "
    f"cube_orders bigint, cube_lines bigint, cube_quantity bigint, {_MONTH}",
    "members": f"kind string, bucket bigint, bits binary, {_MONTH}",
    "customers": f"customer_name string, cube_revenue {cubes.MONEY}, {_MONTH}",
    "city": f"city string, {_SUMS}, {_MONTH}",
    "city_returning": f"city string, order_id string, {_MONTH}",
    "item": f"category string, product_name string, {_SUMS}, {_MONTH}",
    "item_returning": f"category string, product_name string, order_id string, {_MONTH}",
}
