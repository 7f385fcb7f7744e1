"""Nested product catalog: category -> sub-category -> list of products."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.schemas import CATALOG_JSON


def flatten_catalog(documents: DataFrame) -> DataFrame:
    """One row per product, from JSON documents in the column ``value``."""
    nested = documents.select(F.from_json("value", CATALOG_JSON).alias("catalog"))
    categories = nested.select(F.explode("catalog").alias("category", "sub_categories"))
    groups = categories.select("category", F.explode("sub_categories").alias("sub_category", "items"))
    return groups.select("category", "sub_category", F.inline("items")).select(
        "category", "sub_category", F.col("name").alias("product_name"), "price", "product_id"
    )


def nest_catalog(products: DataFrame, document: Column) -> DataFrame:
    """The flat columns as JSON documents again, one for each value of ``document``, in ``value``.

    A document holds as many products as share its value, so that should bound them.
    """
    item = F.struct(F.col("product_name").alias("name"), "price", "product_id")
    groups = products.withColumn("_document", document).groupBy("_document", "category", "sub_category")
    groups = groups.agg(F.array_sort(F.collect_list(item)).alias("items"))
    inner = F.map_from_entries(F.array_sort(F.collect_list(F.struct("sub_category", "items"))))
    outer = F.map_from_entries(F.collect_list(F.struct("category", "sub_categories")))
    nested = groups.groupBy("_document", "category").agg(inner.alias("sub_categories"))
    return nested.groupBy("_document").agg(F.to_json(outer).alias("value")).select("value")


def read_catalog(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Products of the catalog file (or of each file in a folder).

    A file is one document, which one task parses. With ``lines`` every line is a document, so that
    files of any size are split over tasks and read document by document.
    """
    return flatten_catalog(spark.read.text(path, wholetext=not lines))
