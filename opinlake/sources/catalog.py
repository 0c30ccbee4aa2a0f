"""The product catalog as a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinlake import schemas


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATALOG).parquet(path)


def list_products(catalog: DataFrame) -> DataFrame:
    """All products in the order of their ids."""
    return catalog.orderBy("product_id")
