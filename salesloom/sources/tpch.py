"""Retail sales as a view over order, customer, place and part tables."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.operators.keys import with_surrogate_key

# The order in which lines are numbered. Lines equal in all of it are copies; _line, their place
# in the scan, spreads even a large group of copies over the range partitions.
LINE_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{base}/{table}.parquet")


# First day, and the day after the last.
Between = tuple[date, date] | None


def _orders(spark: SparkSession, base: str, between: Between) -> DataFrame:
    """Orders of a period; its bounds reach the statistics of the stored row groups."""
    orders = read(spark, base, "orders")
    if between is None:
        return orders
    first, behind = (F.expr(f"TIMESTAMP_NTZ'{day} 00:00:00'") for day in between)
    return orders.where((F.col("o_orderdate") >= first) & (F.col("o_orderdate") < behind))


def _joined(
    spark: SparkSession, base: str, lines: DataFrame | None = None, between: Between = None
) -> DataFrame:
    """Orders are widened first, so that the far longer line table is shuffled for two joins only.

    Lines and orders both grow with the business, so their join is a merge join at any size; AQE
    splits a partition that holds a hot order. The other sides are broadcast while they are small.

    Orders come last: lines of one order then lie side by side, and the next shuffle compresses what
    they share to almost nothing. Orders of a period come first, since few lines are left by them.
    """
    if lines is None:
        lines = read(spark, base, "lineitem")
    orders = (
        _orders(spark, base, between)
        .join(read(spark, base, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders, of_order = orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    parts, of_part = read(spark, base, "part"), F.col("l_partkey") == F.col("p_partkey")
    if between is None:
        return lines.join(parts, of_part).join(orders, of_order)
    return lines.join(orders, of_order).join(parts, of_part)


def _nine_digits(key: str) -> str:
    """Padded to nine digits; longer keys stay whole, where plain lpad would cut them."""
    return f"lpad(string({key}), greatest(9, length(string({key}))), '0')"


SALES_COLUMNS = {
    "order_id": f"concat('US-', year(o_orderdate), '-', {_nine_digits('o_orderkey')})",
    "order_date": "to_date(o_orderdate)",
    "ship_date": "to_date(l_shipdate)",
    "ship_mode": "o_orderpriority",
    "customer_id": f"concat('C-', {_nine_digits('c_custkey')})",
    "customer_name": "c_name",
    "segment": "c_mktsegment",
    "city": "concat('CITY_', c_custkey % 100)",
    "state": "n_name",
    "postal_code": "lpad(string(c_custkey % 100000), 5, '0')",
    "region": "r_name",
    "category": "p_type",
    "sub_category": "p_brand",
    "product_id": f"concat('P-', {_nine_digits('p_partkey')})",
    "product_name": "p_name",
    "price": "p_retailprice",
    "quantity": "int(l_quantity)",
    "discount": "l_discount",
}

# The same columns with planted faults, each by a fixed rule on the source keys.
DIRTY_COLUMNS = SALES_COLUMNS | {
    "price": "CASE WHEN l_partkey % 97 <> 0 THEN p_retailprice END",
    "quantity": "CASE WHEN l_linenumber <> 5 THEN int(l_quantity) END",
    "discount": "CASE l_linenumber WHEN 7 THEN l_discount * 20 WHEN 6 THEN -l_discount "
    "WHEN 4 THEN NULL ELSE l_discount END",
    "customer_id": f"CASE WHEN l_orderkey % 101 <> 0 THEN {SALES_COLUMNS['customer_id']} END",
    "region": "CASE WHEN l_orderkey % 103 <> 0 THEN r_name END",
    "order_date": "CASE WHEN l_orderkey % 107 = 0 THEN 'not-a-date' "
    "WHEN l_orderkey % 109 = 0 THEN date_format(o_orderdate, 'yyyyMMdd') "
    "WHEN l_orderkey % 113 = 0 THEN date_format(o_orderdate, 'yyyy/MM/dd') "
    "WHEN l_orderkey % 127 = 0 THEN date_format(o_orderdate, 'MM/dd/yyyy') "
    "WHEN l_orderkey % 131 = 0 THEN date_format(o_orderdate, 'MMM d yyyy') "
    "ELSE string(to_date(o_orderdate)) END",
}


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def sales(spark: SparkSession, base: str, between: Between = None) -> DataFrame:
    """Raw sales without row ids: what most questions need. ``between`` leaves out other days early."""
    return _joined(spark, base, between=between).selectExpr(*_named(SALES_COLUMNS))


def dirty_sales(spark: SparkSession, base: str) -> DataFrame:
    return _joined(spark, base).selectExpr(*_named(DIRTY_COLUMNS))


def _matched_lines(spark: SparkSession, base: str) -> DataFrame:
    """Lines that the joins keep, with their place in the scan; only keys of other tables are read."""
    orders = (
        read(spark, base, "orders")
        .select("o_orderkey", "o_custkey")
        .join(read(spark, base, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read(spark, base, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, base, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey")
    )
    lines = read(spark, base, "lineitem").withColumn("_line", F.monotonically_increasing_id())
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").join(
        read(spark, base, "part").select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi"
    )


def _line_order() -> list:
    return [F.asc_nulls_last(c) for c in (*LINE_ORDER, "_line")]


def _numbered(spark: SparkSession, base: str, columns: dict[str, str]) -> DataFrame:
    """Lines are joined once; the joined rows are sorted, numbered and written in one go.

    Texts made of numbers are made after the sort, so the numbers travel, and of two equal keys only
    that of the line, which the sort needs too.
    """
    columns = {
        name: expression.replace("o_orderkey", "l_orderkey").replace("p_partkey", "l_partkey")
        for name, expression in columns.items()
    }
    lines = read(spark, base, "lineitem").withColumn("_line", F.monotonically_increasing_id())
    with scratch.freeing(spark):
        return with_surrogate_key(
            _joined(spark, base, lines), _line_order(), "row_id", named=_named(columns)
        )


def numbered_sales(spark: SparkSession, base: str) -> DataFrame:
    """Raw sales with dense row ids, from a written table."""
    return _numbered(spark, base, SALES_COLUMNS)


def numbered_dirty_sales(spark: SparkSession, base: str) -> DataFrame:
    return _numbered(spark, base, DIRTY_COLUMNS)


def first_sales(spark: SparkSession, base: str, n: int) -> DataFrame:
    """The first ``n`` raw lines in row order with their ids, without numbering the others."""
    first = _matched_lines(spark, base).orderBy(*_line_order()).limit(n)
    # n rows at most, which the limit has gathered in one task already.
    row_id = F.row_number().over(Window.orderBy(*_line_order())).cast("bigint")
    lines = first.withColumn("row_id", row_id).drop("_line")
    return _joined(spark, base, lines).selectExpr("row_id", *_named(SALES_COLUMNS))
