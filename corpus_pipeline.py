"""The training-corpus pipeline: five operators, each on all that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinlake.llm import bpe, decontaminate, exact_dedup, near_copies, toxicity
from opinlake.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_repeats(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return near_copies.drop_near_copies(docs, words=5, similarity=0.8)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of what is left."""
    return bpe.round_trip(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_copies),
    ("near-dedup", remove_near_copies),
    ("decontamination", remove_contaminated),
    ("bpe encoding", encode),
]

# A fitted classifier and the near copies cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs, f"stage_{number}")
    return docs
