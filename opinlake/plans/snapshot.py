"""Dashboard snapshots as gold tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinlake.layout import LakeLayout
from opinlake.plans.dashboard import (
    DASHBOARD_REPORTS,
    dashboard,
    newest_opinions,
    report_cube,
)
from opinlake.session import delete_path

T = TypeVar("T")

MANIFEST = "snapshot_id string, generated_at timestamp"

# What a reader is told about the snapshot it gets.
FRESH, CACHED = "fresh", "cached"
CACHED_WARNING = "Showing the last successful analytics snapshot."

# The columns each relation must have, the name column of the catalog apart.
REQUIRED_COLUMNS = {
    "summary": {"total_reviews", "average_score", "first_review_at", "last_review_at"},
    "sentiment": {"sentiment", "review_count"},
    "score_distribution": {"score", "review_count"},
    "top_products": {"product_id", "review_count", "average_score"},
    "worst_products": {"product_id", "review_count", "average_score"},
    "negative_products": {
        "product_id", "negative_review_count", "review_count", "average_score",
    },
    "recent_reviews": {"product_id", "text", "created_at"},
    "sources": {"source", "review_count"},
    "opinions": {"product_id", "text", "created_at"},
    "negative_keywords": {"keyword_type", "matching_reviews"},
    "positive_keywords": {"keyword_type", "matching_reviews"},
}
ONE_ROW = ("summary", "negative_keywords", "positive_keywords")


class IncompleteSnapshot(ValueError):
    """A snapshot lacks a relation, or one has the wrong shape."""


def _manifest_path(layout: LakeLayout) -> str:
    return f"{layout.gold}/manifest"


def _snapshot_path(layout: LakeLayout, snapshot_id: str) -> str:
    return f"{layout.gold}/snapshot_id={snapshot_id}"


def publish_snapshot(
    spark: SparkSession,
    layout: LakeLayout,
    silver: DataFrame,
    catalog: DataFrame | None = None,
    keep: int | None = None,
) -> dict:
    """Compute, check and publish a snapshot; returns its envelope.

    With `keep`, the relations of all but the newest `keep` snapshots are removed afterwards.

    Every snapshot has a folder of its own and readers find it through the manifest, whose
    row is written last: a job that dies half way leaves no visible snapshot, and readers
    keep the one before.
    """
    snapshot_id = uuid.uuid4().hex
    folder = _snapshot_path(layout, snapshot_id)
    cube = report_cube(silver)
    cube.write.parquet(f"{folder}/cube")
    stored_cube = spark.read.schema(cube.schema).parquet(f"{folder}/cube")
    newest = newest_opinions(silver, catalog)
    newest.write.parquet(f"{folder}/recent_reviews")
    stored_newest = spark.read.schema(newest.schema).parquet(f"{folder}/recent_reviews")
    relations = dashboard(stored_cube, stored_newest, catalog)
    del relations["recent_reviews"]
    _overlapping(lambda name: relations[name].write.parquet(f"{folder}/{name}"), relations)
    problems = [
        row.report
        for row in completeness(spark, layout, snapshot_id).where(~F.col("complete")).collect()
    ]
    delete_path(spark, f"{folder}/cube")
    if problems:
        raise IncompleteSnapshot(f"incomplete relations: {', '.join(sorted(problems))}")
    generated_at = datetime.now(timezone.utc)
    entry = spark.createDataFrame([(snapshot_id, generated_at)], MANIFEST)
    entry.coalesce(1).write.mode("append").parquet(_manifest_path(layout))
    if keep is not None:
        remove_old_snapshots(spark, layout, keep)
    return {
        "snapshot_id": snapshot_id,
        "generated_at": generated_at,
        "status": FRESH,
        "stale": False,
    }


def remove_old_snapshots(spark: SparkSession, layout: LakeLayout, keep: int) -> None:
    """Remove the relations of all but the newest `keep` published snapshots. The manifest keeps
    its rows; readers look for the newest one."""
    if keep < 1:
        raise ValueError("at least one snapshot has to stay")
    manifest = spark.read.schema(MANIFEST).parquet(_manifest_path(layout))
    newest_first = manifest.orderBy(F.desc("generated_at"), "snapshot_id")
    for row in newest_first.offset(keep).toLocalIterator():
        delete_path(spark, _snapshot_path(layout, row["snapshot_id"]))


def _absent(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def completeness(spark: SparkSession, layout: LakeLayout, snapshot_id: str) -> DataFrame:
    """One row per relation: is it there, has it its columns, how many rows."""
    folder = _snapshot_path(layout, snapshot_id)

    def check(name: str) -> tuple[str, bool, int]:
        try:
            relation = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as error:
            if not _absent(error):
                raise
            return name, False, 0
        rows = relation.count()
        shaped = REQUIRED_COLUMNS[name] <= set(relation.columns)
        return name, shaped and (rows == 1 or name not in ONE_ROW), rows

    checks = _overlapping(check, DASHBOARD_REPORTS)
    return spark.createDataFrame(checks, "report string, complete boolean, rows bigint")


def _overlapping(job: Callable[[str], T], names: Iterable[str]) -> list[T]:
    """Run small jobs at the same time: on a cluster they mostly wait."""
    names = list(names)
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(job, names))


def latest_snapshot(spark: SparkSession, layout: LakeLayout) -> DataFrame | None:
    """The envelope of the newest published snapshot, or nothing when there is none."""
    try:
        manifest = spark.read.schema(MANIFEST).parquet(_manifest_path(layout))
    except AnalysisException as error:
        if not _absent(error):
            raise
        return None
    newest = manifest.orderBy(F.desc("generated_at"), "snapshot_id").limit(1)
    return newest.select(
        "snapshot_id",
        "generated_at",
        F.lit(CACHED).alias("status"),
        F.lit(True).alias("stale"),
        F.lit(CACHED_WARNING).alias("warning"),
    )


def read_snapshot(
    spark: SparkSession, layout: LakeLayout, snapshot_id: str
) -> dict[str, DataFrame]:
    folder = _snapshot_path(layout, snapshot_id)
    relations = _overlapping(
        lambda name: spark.read.parquet(f"{folder}/{name}"), DASHBOARD_REPORTS
    )
    return dict(zip(DASHBOARD_REPORTS, relations, strict=True))
