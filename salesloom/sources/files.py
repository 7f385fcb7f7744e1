"""Readers of stored sales data."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesloom import versions
from salesloom.schemas import SALES


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_sales(spark: SparkSession, path: str, schema: T.StructType = SALES) -> DataFrame:
    """Newest finished version of stored sales Parquet; says how to make it if there is none."""
    version = versions.current(spark, path)
    if version is None:
        raise FileNotFoundError(f"Missing {path}. Run the batch job first.")
    stored = spark.read.schema(schema).parquet(version)
    # Folder columns come last when read.
    return stored.select(*schema.fieldNames())


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Stored summary CSV, or None if there is none."""
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as error:
        if _path_missing(error):
            return None
        raise
