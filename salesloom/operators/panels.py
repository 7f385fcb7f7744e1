"""Dashboard questions over the enriched sales table. Null groups stay in the result."""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import (
    currency,
    money_exact,
    money_sum,
    month_name,
    n_unique,
    short_number,
    sum_or_zero,
    thousands,
    year_month,
)

MONTHS = range(1, 13)


def filter_period(
    df: DataFrame, years: Iterable[int] | None = None, months: Iterable[int] | None = None
) -> DataFrame:
    """Lines of the chosen years and months; None chooses all that exist, an empty list nothing."""
    for name, chosen in (("order_year", years), ("order_month", months)):
        if chosen is None:
            df = df.where(F.col(name).isNotNull())
        else:
            values = list(chosen)
            df = df.where(F.col(name).isin(values) if values else F.lit(False))
    return df


def period_bounds(
    years: Iterable[int] | None = None, months: Iterable[int] | None = None
) -> tuple[date, date] | None:
    """First day of a selection and the day after its last; None if it has no bounds.

    For readers that can skip stored rows by a range of days; :func:`filter_period` decides.
    """
    if years is None:
        return None
    chosen = sorted(set(years))
    wanted = sorted(set(MONTHS if months is None else months) & set(MONTHS))
    if not chosen or not wanted:
        return None
    (last_year, last_month) = chosen[-1], wanted[-1]
    behind = date(last_year + last_month // 12, last_month % 12 + 1, 1)
    return date(chosen[0], wanted[0], 1), behind


def filter_options(df: DataFrame) -> DataFrame:
    """Values to choose from: the years of the data, and the months with their names."""
    years = (
        df.where(F.col("order_year").isNotNull())
        .select(F.col("order_year").alias("value"))
        .distinct()
        .select(
            F.lit("year").alias("kind"), "value", F.col("value").cast("string").alias("label")
        )
    )
    month = F.col("id").cast("int")
    months = df.sparkSession.range(MONTHS.start, MONTHS.stop, numPartitions=1).select(
        F.lit("month").alias("kind"), month.alias("value"), month_name(month).alias("label")
    )
    return years.unionByName(months).orderBy(F.desc("kind"), "value")


def kpis(df: DataFrame) -> DataFrame:
    """One row of key figures, also for an empty selection."""
    return df.agg(
        money_sum(F.col("revenue")).alias("total_revenue"),
        F.count("*").alias("total_orders"),
        sum_or_zero(F.col("quantity")).alias("total_quantity"),
        n_unique(F.col("customer_id")).alias("unique_customers"),
        n_unique(F.col("product_id")).alias("unique_products"),
    )


def kpis_text(df: DataFrame) -> DataFrame:
    """Key figures as the dashboard prints them, and the sidebar's two."""
    figures = kpis(df)
    return figures.select(
        F.concat(F.lit("$"), short_number(F.col("total_revenue"))).alias("total_revenue"),
        *[short_number(F.col(c)).alias(c) for c in figures.columns[1:]],
        F.when(F.col("total_orders") > 0, thousands(F.col("total_orders"))).alias(
            "filtered_rows"
        ),
        F.when(F.col("total_orders") > 0, currency(F.col("total_revenue"))).alias(
            "filtered_revenue"
        ),
    )


CUBE_KEYS = ("order_year", "order_month", "segment", "category", "region")


def monthly_cube(df: DataFrame) -> DataFrame:
    """Revenue and order lines by month, segment, category and region.

    Five panels only add these up further, so with a stored cube they need not read the lines again.
    It has a few rows per month, and its sums are exact decimals, so adding them stays exact.
    """
    return df.groupBy(*CUBE_KEYS).agg(
        money_exact(F.col("revenue")).cast("decimal(34,6)").alias("cube_revenue"),
        F.count("order_id").alias("cube_orders"),
    )


def _revenue(df: DataFrame) -> Column:
    """Total revenue of lines, or of a cube."""
    if "cube_revenue" in df.columns:
        return F.coalesce(F.sum("cube_revenue").cast("double"), F.lit(0.0))
    return money_sum(F.col("revenue"))


def _by_month(df: DataFrame, *keys: str, **measures) -> DataFrame:
    period = ["order_year", "order_month", *keys]
    return (
        df.groupBy(*period)
        .agg(*[m.alias(name) for name, m in measures.items()])
        .orderBy(*[F.asc_nulls_first(c) for c in period])
        .withColumn("year_month", year_month(F.col("order_year"), F.col("order_month")))
    )


def revenue_by_month(df: DataFrame) -> DataFrame:
    return _by_month(df, total_revenue=_revenue(df))


def orders_by_month(df: DataFrame) -> DataFrame:
    """Lines with an order id; an order of three lines counts three times."""
    lines = F.sum("cube_orders") if "cube_orders" in df.columns else F.count("order_id")
    return _by_month(df, total_orders=lines)


def segment_by_month(df: DataFrame) -> DataFrame:
    return _by_month(df, "segment", total_revenue=_revenue(df))


def category_by_month(df: DataFrame) -> DataFrame:
    return _by_month(df, "category", total_revenue=_revenue(df))


def best_first(df: DataFrame, *keys: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_first("total_revenue"), *[F.asc_nulls_first(k) for k in keys])


def top_customers(df: DataFrame, n: int = 10) -> DataFrame:
    """By name, so customers who share a name count as one."""
    revenue = df.groupBy("customer_name").agg(
        money_sum(F.col("revenue")).alias("total_revenue")
    )
    return best_first(revenue, "customer_name").limit(n)


def _volumes(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        money_sum(F.col("revenue")).alias("total_revenue"),
        n_unique(F.col("order_id")).alias("total_orders"),
        sum_or_zero(F.col("quantity")).alias("total_quantity"),
    )


def cities(df: DataFrame) -> DataFrame:
    return best_first(_volumes(df, "city"), "city")


def revenue_by_region(df: DataFrame) -> DataFrame:
    revenue = df.groupBy("region").agg(_revenue(df).alias("total_revenue"))
    return best_first(revenue, "region")


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """Revenue alone decides which products are shown; orders are counted for those only.

    An order seldom holds a product twice, so counting the orders of every product would keep a group
    for nearly every line. Both passes read the same columns of the lines, so Spark can share the
    shuffles below ``df``; the second one is kept to the products shown before anything is grouped.
    """
    keys = ("category", "product_name")
    revenue = df.groupBy(*keys).agg(money_sum(F.col("revenue")).alias("total_revenue"))
    shown = best_first(revenue, *keys).limit(n)
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"line.{key}").eqNullSafe(F.col(f"shown.{key}"))
    lines = df.alias("line").join(shown.alias("shown"), same, "left_semi")
    return best_first(_volumes(lines, *keys), *keys).limit(n)


_HEADINGS = {
    "customer_name": "Customer",
    "city": "City",
    "category": "Category",
    "product_name": "Product",
    "total_revenue": "Revenue",
    "total_orders": "Orders",
    "total_quantity": "Quantity",
}


def display_table(panel: DataFrame) -> DataFrame:
    """A table panel with its headings and its numbers as text."""
    text = {"total_revenue": currency, "total_orders": thousands, "total_quantity": thousands}
    return panel.select(
        *[
            text.get(c, lambda column: column)(F.col(c)).alias(_HEADINGS.get(c, c))
            for c in panel.columns
        ]
    )


# Panels that a cube answers as well, and panels that need the lines.
CUBE_PANELS = {
    "revenue_by_month": revenue_by_month,
    "orders_by_month": orders_by_month,
    "segment_by_month": segment_by_month,
    "category_by_month": category_by_month,
    "region": revenue_by_region,
}
LINE_PANELS = {
    "kpis": kpis,
    "top_customers": top_customers,
    "cities": cities,
    "top_products": top_products,
}


def panels(selection: DataFrame, cube: DataFrame | None = None) -> dict[str, DataFrame]:
    """Key figures and all panels of one selection, each lazy; a stored cube serves five of them."""
    monthly = selection if cube is None else cube
    return {name: panel(selection) for name, panel in LINE_PANELS.items()} | {
        name: panel(monthly) for name, panel in CUBE_PANELS.items()
    }
