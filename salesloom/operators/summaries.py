"""Summary tables. Rows with a null group key are left out."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions import money_sum, round2


def _revenue_by(df: DataFrame, *keys: str) -> DataFrame:
    kept = df
    for key in keys:
        kept = kept.where(F.col(key).isNotNull())
    return kept.groupBy(*keys).agg(
        round2(money_sum(F.col("revenue"))).alias("total_revenue"),
        F.count("*").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def yearly(df: DataFrame) -> DataFrame:
    return (
        _revenue_by(df, "order_year")
        .select("order_year", "total_orders", "total_revenue", "unique_customers")
        .orderBy(F.col("order_year"))
    )


def regional_revenue(df: DataFrame) -> DataFrame:
    return _revenue_by(df, "region").orderBy(F.desc("total_revenue"), F.asc("region"))


def segment_yearly(df: DataFrame) -> DataFrame:
    return _revenue_by(df, "segment", "order_year").orderBy("segment", "order_year")


def top_products(df: DataFrame, per_category: int = 3) -> DataFrame:
    """Best products of each category; equal revenue goes by product name."""
    revenue = (
        df.where(F.col("category").isNotNull() & F.col("product_name").isNotNull())
        .groupBy("category", "product_name")
        .agg(round2(money_sum(F.col("revenue"))).alias("total_revenue"))
    )
    best_first = Window.partitionBy("category").orderBy(
        F.desc("total_revenue"), F.asc("product_name")
    )
    return (
        revenue.withColumn("_rank", F.row_number().over(best_first))
        .where(F.col("_rank") <= per_category)
        .orderBy("category", "_rank")
        .drop("_rank")
    )


def build_summaries(df: DataFrame) -> dict[str, DataFrame]:
    """The summaries whose input columns exist."""
    columns = set(df.columns)
    summaries = {}
    if {"order_year", "revenue"} <= columns:
        summaries["yearly"] = yearly(df)
    if {"region", "revenue"} <= columns:
        summaries["regional_revenue"] = regional_revenue(df)
    if {"category", "product_name", "revenue"} <= columns:
        summaries["top_products"] = top_products(df)
    return summaries
