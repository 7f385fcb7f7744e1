"""Star schema: four dimensions, the sales fact and their validation.

No side of a join is broadcast by hint. Spark broadcasts a dimension when its written size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where AQE splits hot keys.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.functions import date_key, day_of, money_exact, month_name
from salesloom.operators.keys import duplicate_keys, key_report, with_surrogate_key

LOCATION_KEY = ("city", "state", "postal_code")


def _dimension(sales: DataFrame, required: str, columns: list, order: list[str], key: str):
    """Distinct attribute rows with a dense key. All attributes are part of the row's identity."""
    rows = sales.where(F.col(required).isNotNull()).select(*columns).distinct()
    ties = [c for c in rows.columns if c not in order]
    return with_surrogate_key(rows, [F.asc_nulls_last(c) for c in [*order, *ties]], key)


def dim_customer(sales: DataFrame) -> DataFrame:
    return _dimension(
        sales,
        "customer_id",
        ["customer_id", "customer_name", "segment"],
        ["customer_id"],
        "customer_key",
    )


def dim_product(sales: DataFrame) -> DataFrame:
    """A price change makes a new row; ``key_problems`` reports the ids it repeats."""
    return _dimension(
        sales,
        "product_id",
        [
            "product_id",
            "product_name",
            "category",
            "sub_category",
            F.col("price").alias("base_price"),
        ],
        ["product_id"],
        "product_key",
    )


def dim_location(sales: DataFrame) -> DataFrame:
    return _dimension(
        sales,
        "city",
        ["city", "state", "postal_code", "region"],
        ["region", "state", "city", "postal_code"],
        "location_key",
    )


def dim_date(sales: DataFrame) -> DataFrame:
    """Every day from the first to the last order date; no rows where no date exists."""
    day = day_of(sales, "order_date")
    bounds = sales.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("date")
    )
    return days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        month_name(F.month("date")).alias("month_name"),
    )


def with_date_keys(sales: DataFrame) -> DataFrame:
    """Keys of both dates and the days between them; this part of the fact needs no join."""
    ordered, shipped = day_of(sales, "order_date"), day_of(sales, "ship_date")
    return sales.withColumns(
        {
            "order_date_key": date_key(ordered),
            "ship_date_key": date_key(shipped),
            "ship_latency_days": F.date_diff(shipped, ordered),
        }
    )


def with_dimension_keys(
    sales: DataFrame, customers: DataFrame, products: DataFrame, locations: DataFrame
) -> DataFrame:
    """Surrogate keys by natural key; null where no dimension row matches.

    A customer buys at few places, so customers and places are matched pair by pair, not line by line,
    and the lines meet both in one join. That is the first one: it frees them of four texts.
    """
    natural = ["customer_id", *LOCATION_KEY]
    with scratch.freeing(sales.sparkSession):
        buyers = scratch.materialize(
            sales.select(*natural)
            .distinct()
            .join(customers.select("customer_id", "customer_key"), "customer_id", "left")
            .join(locations.select(*LOCATION_KEY, "location_key"), list(LOCATION_KEY), "left"),
            "buyers",
        )
    same = reduce(and_, [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in natural])
    keyed = sales.alias("s").join(buyers.alias("b"), same, "left")
    return keyed.select("s.*", "customer_key", "location_key").join(
        products.select("product_id", "product_key"), "product_id", "left"
    )


# Amounts of the fact, and their names in the lines.
FACT_AMOUNTS = {"sales_amount": "revenue", "discount_amount": "discount_amount", "gross_sales": "gross_sales"}
# Adds the amounts, line by line.
Finish = Callable[[DataFrame], DataFrame]


def fact_sales(
    sales: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    locations: DataFrame,
    finish: Finish | None = None,
) -> DataFrame:
    """One row per order line. ``finish`` adds the amounts after the joins, if ``sales`` has none, so
    that they are not shuffled."""
    keyed = with_date_keys(with_dimension_keys(sales, customers, products, locations))
    if finish is not None:
        keyed = finish(keyed)
    return keyed.select(
        F.col("row_id").cast("bigint").alias("sales_key"),
        "order_id",
        "customer_key",
        "product_key",
        "location_key",
        "order_date_key",
        "ship_date_key",
        "ship_mode",
        F.col("revenue").alias("sales_amount"),
        "quantity",
        "discount",
        "discount_amount",
        "gross_sales",
        F.col("price").alias("unit_price"),
        "ship_latency_days",
    )


@dataclass(frozen=True)
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_location: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    sales: DataFrame
    # What added the amounts to the lines, if that can be done again after a shuffle.
    finish: Finish | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {
            name: getattr(self, name)
            for name in ("dim_customer", "dim_date", "dim_product", "dim_location", "fact_sales")
        }


def dimensions(sales: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three numbered dimensions. Their jobs do not depend on each other and run side by side."""
    steps = (dim_customer, dim_product, dim_location)
    with scratch.freeing(sales.sparkSession), ThreadPoolExecutor(len(steps)) as pool:
        # Each thread gets its own copy of the caller's job group, tags and other properties.
        builds = [
            pool.submit(inheritable_thread_target(sales.sparkSession)(step), sales)
            for step in steps
        ]
        customers, products, locations = (build.result() for build in builds)
    return customers, products, locations


def build_star(sales: DataFrame, finish: Finish | None = None) -> Star:
    """All five tables from the enriched sales table, which should be a written one.

    ``finish`` adds the amounts to lines that have none, see :func:`fact_sales`.
    """
    customers, products, locations = dimensions(sales)
    return Star(
        dim_customer=customers,
        dim_product=products,
        dim_location=locations,
        dim_date=dim_date(sales),
        fact_sales=fact_sales(sales, customers, products, locations, finish),
        sales=sales if finish is None else finish(sales),
        finish=finish,
    )


def row_counts(star: Star) -> DataFrame:
    """One row with the size of each table and of the sales table it came from."""
    tables = {
        "fact_sales": star.fact_sales,
        "dim_customer": star.dim_customer,
        "dim_product": star.dim_product,
        "dim_location": star.dim_location,
        "dim_date": star.dim_date,
        "original_sales": star.sales,
    }
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
            for name, df in tables.items()
        ],
    )
    return counts.agg(*[F.max(F.when(F.col("name") == t, F.col("n"))).alias(t) for t in tables])


def foreign_key_coverage(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count("*").alias("total_rows"),
        F.count("customer_key").alias("has_customer"),
        F.count("product_key").alias("has_product"),
        F.count("location_key").alias("has_location"),
        F.count("order_date_key").alias("has_order_date"),
    )


def key_problems(star: Star) -> DataFrame:
    """Uniqueness of the primary keys, and of the natural keys the fact is joined by.

    A repeated natural key multiplies fact rows. The fact's own key is checked on the sales table:
    it repeats in the fact if it repeats there or if a natural key does.
    """
    return key_report(
        [
            ("dim_customer", star.dim_customer, ["customer_key"]),
            ("dim_customer", star.dim_customer, ["customer_id"]),
            ("dim_product", star.dim_product, ["product_key"]),
            ("dim_product", star.dim_product, ["product_id"]),
            ("dim_location", star.dim_location, ["location_key"]),
            ("dim_location", star.dim_location, list(LOCATION_KEY)),
            ("dim_date", star.dim_date, ["date_key"]),
            ("sales", star.sales, ["row_id"]),
        ]
    )


NATURAL_KEYS = {
    "dim_customer": ("customer_id",),
    "dim_product": ("product_id",),
    "dim_location": LOCATION_KEY,
}
VERDICT = (
    "table_name string, key_columns string, key_value string, row_count bigint, line_count bigint, "
    "first_row_id bigint, last_row_id bigint"
)


def repeated_natural_keys(star: Star) -> DataFrame:
    """Each natural key that several dimension rows hold, with the lines it would multiply.

    One row per key: the dimension rows that hold it, the number of its lines and the first and last
    of them. Lines are counted by key before they meet the few keys that repeat.
    """
    parts = []
    for table, keys in NATURAL_KEYS.items():
        repeated = duplicate_keys(getattr(star, table).dropna(subset=list(keys)), keys)
        lines = star.sales.groupBy(*keys).agg(
            F.count("*").alias("line_count"), F.min("row_id").alias("first_row_id"), F.max("row_id").alias("last_row_id")
        )
        parts.append(
            repeated.join(lines, list(keys)).select(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(keys)).alias("key_columns"),
                F.concat_ws("|", *keys).alias("key_value"),
                "row_count",
                "line_count",
                "first_row_id",
                "last_row_id",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def by_dates(sales: DataFrame) -> DataFrame:
    """Number of lines and exact revenue by order and ship date: all that calendar questions need."""
    return sales.groupBy("order_date", "ship_date").agg(
        F.count("*").alias("line_count"),
        money_exact(F.col("revenue")).cast("decimal(34,6)").alias("amount"),
    )


def ship_date_gap(
    fact: DataFrame, calendar: DataFrame, lines: Column | None = None
) -> DataFrame:
    """Lines per ship date that the calendar lacks. One row per date enters the join."""
    if lines is None:
        lines = F.count("*")
    return (
        fact.where(F.col("ship_date_key").isNotNull())
        .groupBy("ship_date_key")
        .agg(lines.alias("line_count"))
        .join(calendar, F.col("ship_date_key") == F.col("date_key"), "left_anti")
        .orderBy("ship_date_key")
    )


def revenue_by_month(
    fact: DataFrame, calendar: DataFrame, amount: Column | None = None
) -> DataFrame:
    """Revenue through the calendar. Lines are added up by date before the join."""
    if amount is None:
        amount = money_exact(F.col("sales_amount"))
    daily = fact.groupBy("order_date_key").agg(amount.cast("decimal(34,6)").alias("amount"))
    return (
        daily.join(calendar, F.col("order_date_key") == F.col("date_key"))
        .groupBy("year", "month", "month_name")
        .agg(F.sum("amount").cast("double").alias("revenue"))
        .orderBy("year", "month")
    )
