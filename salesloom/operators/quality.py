"""Quality checks of the enriched sales table, all from one aggregation."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions import is_missing

REQUIRED = ("order_id", "customer_id", "price", "order_date")


def _failed(df: DataFrame) -> dict[str, Column]:
    """Failing rows per check. Range checks pass over missing values."""

    def outside(name: str, inside: Column) -> Column:
        return F.count_if(~is_missing(df, name) & ~inside)

    checks = {
        f"{c}_not_null": F.count_if(is_missing(df, c)) for c in REQUIRED if c in df.columns
    }
    if "order_date_unread" in df.columns:
        checks["order_date_readable"] = F.count("order_date_unread")
    if "price" in df.columns:
        checks["sales_positive"] = outside("price", F.col("price") > 0)
    if "discount" in df.columns:
        checks["discount_in_range"] = outside("discount", F.col("discount").between(0, 0.5))
    if "quantity" in df.columns:
        checks["quantity_in_range"] = outside("quantity", F.col("quantity").between(1, 100))
    return checks


def quality_report(df: DataFrame) -> DataFrame:
    """Rows ``(check_name, failed_rows, passed)`` with ``overall_success`` last.

    The year check compares the column with its own bounds, so it fails only where no year exists.
    ``failed_rows`` of the overall row is the number of failed checks. Lines that keep their unread
    days get one more check, from the same scan: days that were given but could not be read.
    """
    failed = _failed(df)
    measures = [count.alias(name) for name, count in failed.items()]
    verdicts = {name: F.col(name) == 0 for name in failed}
    counts = {name: F.col(name) for name in failed}
    if "order_year" in df.columns:
        name = "order_year_valid_range"
        measures.append(F.count("order_year").alias(name))
        verdicts[name] = F.col(name) > 0
        counts[name] = F.lit(0).cast("bigint")
    failures = sum(((~v).cast("bigint") for v in verdicts.values()), F.lit(0).cast("bigint"))
    counts["overall_success"] = failures
    verdicts["overall_success"] = failures == 0
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            counts[name].alias("failed_rows"),
            verdicts[name].alias("passed"),
        )
        for name in counts
    ]
    if not measures:
        measures = [F.count("*").alias("rows")]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def quality_results(report: DataFrame) -> dict[str, bool]:
    """The report (at most nine rows) as a dict."""
    return {row.check_name: row.passed for row in report.collect()}
