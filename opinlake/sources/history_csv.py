"""Historical reviews as CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opinlake import schemas
from opinlake.functions import text as tx
from opinlake.functions.review import enrich
from opinlake.functions.times import from_epoch_seconds
from opinlake.sources.split_csv import read_split_csv

# Fixed value: the source label of sample rows.
SAMPLE_SOURCE = "sample_csv"

_COMPRESSED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst)$"


def _csv_reader(spark: SparkSession, schema: StructType, multi_line: bool):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
    )


def _has_large_file(spark: SparkSession, path: str) -> bool:
    """Whether a file is larger than what a task should read, and not compressed: those have no ranges
    to be read from. Only names and sizes are looked at."""
    files = spark.read.format("binaryFile").load(path).where(~F.col("path").rlike(_COMPRESSED))
    sizes = files.agg(F.max("length")).first()
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)
    return (sizes[0] or 0) > most


def read_history_csv(
    spark: SparkSession, path: str, multi_line: bool = True, split: bool | None = None
) -> DataFrame:
    """Raw rows, every column as text.

    With `multi_line` quoted fields may hold line breaks. Files larger than a task's share are then
    read in parts (see `split_csv`), others and compressed ones by one task each; `split` settles it by
    hand. Files
    without such fields can be read with `multi_line=False` and split freely.
    """
    if multi_line and (_has_large_file(spark, path) if split is None else split):
        return read_split_csv(spark, path, schemas.HISTORY_CSV)
    return _csv_reader(spark, schemas.HISTORY_CSV, multi_line).csv(path)


def read_sample_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Opinion rows of a trusted sample. One bad row fails the whole read."""
    rows = (
        _csv_reader(spark, schemas.SAMPLE_CSV, multi_line)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(path)
    )
    required = {
        name: F.when(
            F.col(name).isNull(), F.raise_error(F.lit(f"{name} is missing")).cast(kind)
        ).otherwise(F.col(name))
        for name, kind in (("Score", "int"), ("Time", "bigint"))
    }
    reviews = rows.withColumns(required).select(
        F.col("ProductId").alias("product_id"),
        F.col("UserId").alias("user_id"),
        F.col("Score").alias("score"),
        tx.text_or_empty(F.col("Text")).alias("text"),
        F.lit(SAMPLE_SOURCE).alias("source"),
        F.col("Id").alias("review_id"),
        from_epoch_seconds(F.col("Time")).alias("created_at"),
    )
    return enrich(reviews, tx.word_count_strict).select(*schemas.OPINION_COLUMNS)
