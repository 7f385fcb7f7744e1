"""Tables of the analytics database.

All are external tables over folders, so a new session can attach what an earlier one stored.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import scratch, versions
from salesloom.operators.star import FACT_AMOUNTS, Finish, Star
from salesloom.schemas import SALES, STAR

DATABASE = "analytics"


def create_database(spark: SparkSession, name: str = DATABASE) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _typed(df: DataFrame, table: str) -> DataFrame:
    """Columns of the table's contract, in its order and types."""
    columns = [entry.strip().split(" ") for entry in STAR[table].split(",")]
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in columns])


def _register(spark: SparkSession, table: str, schema: T.StructType, path: str, parts=()) -> None:
    """Make a stored folder a table, without copying it."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    partitioned = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {partitioned} LOCATION '{path}'")
    if parts:
        spark.catalog.recoverPartitions(table)


def register_sales(spark: SparkSession, path: str, database: str = DATABASE) -> None:
    version = versions.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"Missing {path}. Run the batch job first.")
    _register(spark, f"{database}.sales", SALES, version, ("order_year", "order_month"))


def drop_star(spark: SparkSession, database: str = DATABASE) -> None:
    """Take the star tables out of the database; their files stay."""
    for name in STAR:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def attach_star(spark: SparkSession, version: str, database: str = DATABASE) -> None:
    """Register a stored star, all five tables or none if it was not finished."""
    drop_star(spark, database)
    if versions.is_complete(spark, version):
        for name, schema in STAR.items():
            kind = T.StructType.fromDDL(schema)
            _register(spark, f"{database}.{name}", kind, f"{version}/{name}")


def by_month(fact: DataFrame, finish: Finish | None = None) -> DataFrame:
    """The fact gathered by order month and sorted by date; ``finish`` makes its amounts behind that.

    The rebalance needs no sampling pass over the joins, and it splits a month with very many lines
    over as many tasks as its size asks for.
    """
    month = F.floor(F.col("order_date_key") / 100)
    gathered = (
        fact.withColumn("_month", month)
        .hint("rebalance", F.col("_month"))
        .sortWithinPartitions("order_date_key", "sales_key")
        .drop("_month")
    )
    if finish is None:
        return gathered
    lines = finish(gathered.drop(*FACT_AMOUNTS).withColumnRenamed("unit_price", "price"))
    named = lines.withColumnsRenamed({"price": "unit_price"} | {v: k for k, v in FACT_AMOUNTS.items()})
    return named.select(*fact.columns)


def save_star(star: Star, version: str, database: str = DATABASE) -> None:
    """Write all five tables into one new folder, then point the database to them.

    Dimensions as they are, in key order; the fact by month, so that date filters skip files and row
    groups.
    """
    spark = star.sales.sparkSession
    for name, df in star.tables().items():
        table = _typed(df, name)
        if name == "fact_sales":
            table = by_month(table, star.finish)
        with scratch.freeing(spark):
            table.write.parquet(f"{version}/{name}")
    versions.finish(spark, version)
    attach_star(spark, version, database)


def read_table(spark: SparkSession, name: str, database: str = DATABASE) -> DataFrame:
    return spark.table(f"{database}.{name}")


def read_star(spark: SparkSession, database: str = DATABASE) -> Star:
    return Star(**{name: read_table(spark, name, database) for name in [*STAR, "sales"]})


def list_tables(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Star tables present in the database, with their exact number of rows."""
    present = {table.name for table in spark.catalog.listTables(database)}
    counts = [
        read_table(spark, name, database)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in STAR
        if name in present
    ]
    if not counts:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    listing = counts[0]
    for count in counts[1:]:
        listing = listing.unionByName(count)
    return listing
