"""Date parsing, keys and names."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Ways to write a day, beside ISO, that are read; the first that fits counts.
DAY_FORMATS = ("yyyyMMdd", "yyyy/M/d", "M/d/yyyy", "MMM d yyyy", "MMM d, yyyy", "d MMM yyyy")


def to_day(column: Column, formats: Sequence[str] = DAY_FORMATS) -> Column:
    """Day of a string, date or timestamp; null where it cannot be read.

    Text is taken as ISO first and then by ``formats``, which cost nothing where ISO fits.
    """
    text = F.trim(column.cast("string"))
    others = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(column.try_cast("date"), *others)


def day_of(df: DataFrame, name: str) -> Column:
    """Day in a column of ``df``; formats are tried on text only."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return to_day(F.col(name))


def date_key(column: Column) -> Column:
    """yyyymmdd as integer."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def month_name(month: Column) -> Column:
    """Full English name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")
