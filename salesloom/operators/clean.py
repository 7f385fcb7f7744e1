"""Cleaning and enrichment of raw order lines. Each step runs only if its columns exist."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions import clip, day_of, is_missing, line_amounts

NUMERIC = ("price", "quantity", "discount")


def clean(df: DataFrame) -> DataFrame:
    """Null (and NaN) price, quantity and discount become 0; discount is clipped to [0, 1]."""
    present = [c for c in NUMERIC if c in df.columns]
    if present:
        df = df.fillna(0, subset=present)
    if "discount" in df.columns:
        df = df.withColumn("discount", clip(F.col("discount"), 0, 1))
    return df


def null_profile(df: DataFrame) -> DataFrame:
    """One row: nulls filled per numeric column, and nulls that stay in all other columns."""
    filled = [c for c in NUMERIC if c in df.columns]
    nulls = {c: F.count_if(is_missing(df, c)) for c in df.columns}
    remaining = F.lit(0).cast("bigint")
    for name, count in nulls.items():
        if name not in filled:
            remaining = remaining + count
    return df.agg(
        *[nulls[c].alias(f"{c}_nulls") for c in filled], remaining.alias("remaining_nulls")
    )


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Optional step: keep one of several equal rows (equal in ``subset``, if given)."""
    return df.dropDuplicates(list(subset) if subset else None)


def with_order_period(df: DataFrame, keep_unread: bool = False) -> DataFrame:
    """``order_date`` as a date (null if unreadable), with its year and month.

    ``keep_unread`` keeps what could not be read as text in ``order_date_unread``.
    """
    if "order_date" not in df.columns:
        return df
    day = day_of(df, "order_date")
    if keep_unread:
        raw = F.col("order_date").cast("string")
        df = df.withColumn("order_date_unread", F.when(day.isNull(), raw))
    return df.withColumn("order_date", day).withColumns(
        {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    )


def unread_lines(df: DataFrame) -> DataFrame:
    """The lines whose day could not be read, from lines enriched with ``keep_unread``."""
    return df.where(F.col("order_date_unread").isNotNull())


def with_amounts(df: DataFrame) -> DataFrame:
    """Revenue, discount amount and gross sales of each line, in whole cents."""
    if not set(NUMERIC) <= set(df.columns):
        return df
    return df.withColumns(line_amounts(*[F.col(c) for c in NUMERIC]))


def transform(df: DataFrame, keep_unread: bool = False) -> DataFrame:
    return with_amounts(with_order_period(df, keep_unread))
