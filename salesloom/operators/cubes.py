"""Monthly tables that answer every dashboard question for any choice of months, exactly.

Sums add up over months. Distinct values do not, so they are kept in forms that merge: customers and
products as bitmaps over dense numbers, which are united by OR; orders as a count by month and a list
of the few that occur in several months, which are counted once.
"""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.functions import money_exact
from salesloom.operators.keys import with_surrogate_key
from salesloom.operators.panels import (
    CUBE_KEYS,
    best_first,
    category_by_month,
    filter_period,
    orders_by_month,
    revenue_by_month,
    revenue_by_region,
    segment_by_month,
)

MONTH = ("order_year", "order_month")
MEMBERS = {"customer": "customer_id", "product": "product_id"}
VOLUMES = {"city": ("city",), "item": ("category", "product_name")}
MONEY = "decimal(34,6)"


def _revenue(column: str = "revenue") -> Column:
    return money_exact(F.col(column)).cast(MONEY)


def monthly(lines: DataFrame) -> DataFrame:
    """Sums by month, segment, category and region."""
    return lines.groupBy(*CUBE_KEYS).agg(
        _revenue().alias("cube_revenue"),
        F.count("order_id").alias("cube_orders"),
        F.count("*").alias("cube_lines"),
        F.sum("quantity").alias("cube_quantity"),
    )


def members(lines: DataFrame) -> DataFrame:
    """``(order_year, order_month, kind, bucket, bits)``: who occurs in a month.

    Each id gets a dense number; a bitmap holds those of one bucket of numbers. Null is a value of
    its own, in a bucket that is null.
    """
    parts = None
    present = F.expr("filter(sequence(1, 12), m -> getbit(months, m) = 1)")
    for kind, column in MEMBERS.items():
        # Map-side combined: an id is one row a year, with a bit for each month, however many its lines.
        held = lines.groupBy("order_year", F.col(column).alias("id")).agg(
            F.expr("bit_or(shiftleft(1, order_month))").alias("months")
        )
        held = scratch.materialize(held, "held")
        ids = with_surrogate_key(held.where("id IS NOT NULL").select("id").distinct(), [F.asc("id")], "number")
        numbered = held.join(ids, "id", "left").select("order_year", "number", F.explode(present).alias("order_month"))
        bits = numbered.groupBy(*MONTH, F.expr("bitmap_bucket_number(number)").alias("bucket")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(number))").alias("bits")
        )
        part = bits.select(*MONTH, F.lit(kind).alias("kind"), "bucket", "bits")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def distinct_members(found: DataFrame) -> DataFrame:
    """``(kind, n)``: distinct values over all months of ``found``; null counts as one."""
    united = found.groupBy("kind", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    n = F.when(F.col("bucket").isNull(), 1).otherwise(F.expr("bitmap_count(bits)"))
    return united.groupBy("kind").agg(F.sum(n).alias("n"))


def customers(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*MONTH, "customer_name").agg(_revenue().alias("cube_revenue"))


def by_order(lines: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Sums by month, ``keys`` and order."""
    return lines.groupBy(*MONTH, *keys, "order_id").agg(
        _revenue().alias("cube_revenue"), F.sum("quantity").alias("cube_quantity")
    )


def volumes(orders: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Sums and number of orders by month and ``keys``."""
    return orders.groupBy(*MONTH, *keys).agg(
        F.sum("cube_revenue").cast(MONEY).alias("cube_revenue"),
        F.sum("cube_quantity").alias("cube_quantity"),
        F.count("order_id").alias("cube_orders"),
        F.max(F.col("order_id").isNull()).alias("cube_unknown"),
    )


def wandering(lines: DataFrame) -> DataFrame:
    """Ids of the orders that have lines in several months: most often few, or none."""
    month = F.col("order_year") * 12 + F.col("order_month")
    spans = lines.where("order_id IS NOT NULL").groupBy("order_id").agg(
        F.min(month).alias("first"), F.max(month).alias("last")
    )
    return spans.where("first < last").select("order_id")


def returning(orders: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Months of each order that has more than one month under the same ``keys``."""
    month = F.col("order_year") * 12 + F.col("order_month")
    spans = orders.where("order_id IS NOT NULL").groupBy(*keys, "order_id").agg(
        F.min(month).alias("first"), F.max(month).alias("last")
    )
    several = spans.where("first < last").drop("first", "last")
    same = F.col("o.order_id") == F.col("s.order_id")
    for key in keys:
        same = same & F.col(f"o.{key}").eqNullSafe(F.col(f"s.{key}"))
    return orders.alias("o").join(several.alias("s"), same, "left_semi").select(*MONTH, *keys, "order_id")


def store(lines: DataFrame, folder: str) -> None:
    """Write all tables, each sorted by month within its files, from the lines of all months.

    The tables do not depend on each other and are made side by side. Only lines of orders that have
    several months at all are searched for those that have them under the same keys.
    """
    lines = filter_period(lines)

    def write(table: DataFrame, name: str) -> None:
        table.sortWithinPartitions(*MONTH).write.parquet(f"{folder}/{name}")

    def write_returning() -> None:
        several = scratch.materialize(wandering(lines), "wandering")
        found = lines.join(several, "order_id", "left_semi")
        for name, keys in VOLUMES.items():
            write(returning(found.select(*MONTH, *keys, "order_id").distinct(), keys), f"{name}_returning")
        scratch.drop(several)

    steps = [
        lambda: write(monthly(lines), "monthly"),
        lambda: write(members(lines), "members"),
        lambda: write(customers(lines), "customers"),
        *[lambda name=name, keys=keys: write(volumes(by_order(lines, keys), keys), name) for name, keys in VOLUMES.items()],
        write_returning,
    ]
    with scratch.freeing(lines.sparkSession), ThreadPoolExecutor(len(steps)) as pool:
        # Each thread gets its own copy of the caller's job group, tags and other properties.
        jobs = [pool.submit(inheritable_thread_target(lines.sparkSession)(step)) for step in steps]
        for job in jobs:
            job.result()


def _volume_panel(tables: dict[str, DataFrame], name: str) -> DataFrame:
    keys = VOLUMES[name]
    again = tables[f"{name}_returning"].groupBy(*keys, "order_id").agg((F.count("*") - 1).alias("n"))
    again = again.groupBy(*keys).agg(F.sum("n").alias("again"))
    sums = tables[name].groupBy(*keys).agg(
        F.coalesce(F.sum("cube_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.sum("cube_orders").alias("orders"),
        F.max("cube_unknown").cast("int").alias("unknown"),
        F.coalesce(F.sum("cube_quantity"), F.lit(0)).alias("total_quantity"),
    )
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"s.{key}").eqNullSafe(F.col(f"a.{key}"))
    orders = F.col("orders") - F.coalesce("again", F.lit(0)) + F.col("unknown")
    joined = sums.alias("s").join(again.alias("a"), same, "left")
    return joined.select(*[F.col(f"s.{k}") for k in keys], "total_revenue", orders.alias("total_orders"), "total_quantity")


def kpis(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of key figures, also for an empty selection."""
    sums = tables["monthly"].agg(
        F.coalesce(F.sum("cube_revenue").cast("double"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("cube_lines"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("cube_quantity"), F.lit(0)).alias("total_quantity"),
    )
    unique = distinct_members(tables["members"]).agg(
        *[
            F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(f"unique_{kind}s")
            for kind in MEMBERS
        ]
    )
    # One row each.
    return sums.crossJoin(unique)


def panels(tables: dict[str, DataFrame], n: int = 10) -> dict[str, DataFrame]:
    """Every panel of a selection of months of the stored tables."""
    cube = tables["monthly"]
    names = tables["customers"].groupBy("customer_name").agg(
        F.coalesce(F.sum("cube_revenue").cast("double"), F.lit(0.0)).alias("total_revenue")
    )
    return {
        "kpis": kpis(tables),
        "top_customers": best_first(names, "customer_name").limit(n),
        "cities": best_first(_volume_panel(tables, "city"), "city"),
        "top_products": best_first(_volume_panel(tables, "item"), *VOLUMES["item"]).limit(n),
        "revenue_by_month": revenue_by_month(cube),
        "orders_by_month": orders_by_month(cube),
        "segment_by_month": segment_by_month(cube),
        "category_by_month": category_by_month(cube),
        "region": revenue_by_region(cube),
    }
