"""The bounded sample of labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.session import materialize

MAX_LABELLED = 10_000


def fold(doc_id: Column) -> Column:
    """0, 1 or 2; rows of fold 1 are held out from all fitting."""
    return (F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3).cast("int")


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, limit: int = MAX_LABELLED) -> DataFrame:
    """doc_id, text, label and fold of at most `limit` labelled rows outside fold 1, written.

    The sample is the same on every run: the rows with the smallest hashes of their ids. Of
    repeated labels of an id the smallest counts. The ids are few by construction, which is the
    size bound of the broadcast.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
    known = known.withColumn("_fold", fold(F.col("_id"))).where("_fold != 1")
    known = known.groupBy("_id", "_fold").agg(F.min("_label").alias("_label"))
    few = known.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = slim.join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"),
        F.col("_label").alias("label"), F.col("_fold").alias("fold"),
    )
    return materialize(found, "labelled")
