"""Labels and display text as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_month(year: Column, month: Column) -> Column:
    """``YYYY-MM`` label."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def thousands(value: Column) -> Column:
    """``1,234``; rounds half to even."""
    return F.format_number(value, 0)


def currency(value: Column) -> Column:
    """``$1,234``."""
    return F.concat(F.lit("$"), thousands(value))


def short_number(value: Column) -> Column:
    """``1.2K``, ``3.4M``, ``5.6B``; no carry into the next unit, so 999,950 is ``1000.0K``."""
    number = value.cast("double")

    def scaled(unit: float, suffix: str) -> Column:
        # format_number rounds half to even on the binary value; format_string would not.
        return F.concat(
            F.call_function("format_number", number / unit, F.lit("0.0")), F.lit(suffix)
        )

    return (
        F.when(number >= 1e9, scaled(1e9, "B"))
        .when(number >= 1e6, scaled(1e6, "M"))
        .when(number >= 1e3, scaled(1e3, "K"))
        .otherwise(F.call_function("format_number", number, F.lit("0")))
    )


def customer_id(name: Column, number: Column) -> Column:
    """Initials of the first two words, a dash and a number: ``AL-12345``.

    One word gives its first letter and X, an empty name gives XX.
    """
    words = F.split(F.trim(name), r"\s+")
    first = F.substring(F.get(words, F.lit(0)), 1, 1)
    second = F.substring(F.get(words, F.lit(1)), 1, 1)
    initials = F.concat(
        F.when(first == "", "X").otherwise(F.coalesce(first, F.lit("X"))),
        F.coalesce(second, F.lit("X")),
    )
    return F.concat(F.upper(initials), F.lit("-"), number.cast("string"))
