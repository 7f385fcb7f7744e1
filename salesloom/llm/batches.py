"""Batch size for Python stages over texts, and names for columns on the way."""

from pyspark.sql import DataFrame, SparkSession

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let a batch on its way to Python hold ``rows`` rows at most, for the rest of the session.

    Texts differ in length by orders of magnitude; Spark's default of 10,000 rows can be hundreds of
    megabytes on either side. A smaller setting stays.
    """
    set_to = int(spark.conf.get(ROWS))
    if set_to <= 0 or set_to > rows:
        spark.conf.set(ROWS, str(rows))


def unused_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
