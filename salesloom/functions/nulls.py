"""Null rules that differ from Spark's own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def clip(column: Column, low: float, high: float) -> Column:
    """Bound a value; null stays null, where ``greatest`` alone would skip it."""
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))


def n_unique(column: Column) -> Column:
    """Distinct values where null counts as one value."""
    has_null = F.coalesce(F.max(column.isNull().cast("int")), F.lit(0))
    return F.count_distinct(column) + has_null


def sum_or_zero(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))
