"""Micro-batches that one query has written to several sinks, and which of them are visible.

The newest marker shows all micro-batches up to its own; see `streaming/fanout.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.session import child_names, delete_path, touch

_FOLDER = "batch="


def batch_folder(sink: str, batch: int) -> str:
    return f"{sink}/{_FOLDER}{batch}"


def _markers(spark: SparkSession, layout: LakeLayout) -> list[int]:
    return sorted(int(n) for n in child_names(spark, f"{layout.fanout}/shown") if n.isdigit())


def last_visible(spark: SparkSession, layout: LakeLayout) -> int | None:
    """Number of the newest micro-batch that is in all sinks."""
    markers = _markers(spark, layout)
    return markers[-1] if markers else None


def show_batch(spark: SparkSession, layout: LakeLayout, batch: int) -> None:
    older = _markers(spark, layout)
    touch(spark, f"{layout.fanout}/shown/{batch}")
    for marker in older:
        if marker < batch:
            delete_path(spark, f"{layout.fanout}/shown/{marker}")


def visible_folders(spark: SparkSession, layout: LakeLayout, sink: str) -> list[str]:
    """Folders of a sink's visible micro-batches, in order."""
    last = last_visible(spark, layout)
    if last is None:
        return []
    numbers = (n.removeprefix(_FOLDER) for n in child_names(spark, sink) if n.startswith(_FOLDER))
    return [batch_folder(sink, n) for n in sorted(int(n) for n in numbers if n.isdigit()) if n <= last]


def read_fanout_silver(spark: SparkSession, layout: LakeLayout) -> DataFrame | None:
    """Silver of the visible micro-batches; None without any."""
    folders = visible_folders(spark, layout, layout.fanout_silver)
    return spark.read.schema(schemas.SILVER).parquet(*folders) if folders else None


def read_fanout_bronze(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """The raw records of the visible micro-batches."""
    return _json(spark, layout, layout.fanout_bronze, schemas.BRONZE_EVENT.toDDL())


def read_fanout_rejects(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """The records that a quarantine has kept out, with the reason."""
    return _json(spark, layout, layout.fanout_rejected, f"{schemas.BRONZE_EVENT.toDDL()}, reason string")


def _json(spark: SparkSession, layout: LakeLayout, sink: str, schema: str) -> DataFrame:
    folders = visible_folders(spark, layout, sink)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**schemas.JSON_OPTIONS).json(folders)
