"""Loads of the batch lane: what belongs to one, and which are visible.

A load has an id and a folder of its own in each sink. It becomes visible in all of them at once, by an
empty file that is made last; readers take the folders of such loads only. A load that died half way is
repeated under its id and overwrites what it had left; one that is visible is not done again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.session import child_names, touch

AUDIT_SCHEMA = "raw_rows bigint, cleaned_rows bigint, written_rows bigint"
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def load_name(load_id: str | None) -> str:
    """A checked id, or a new one."""
    if load_id is None:
        return uuid.uuid4().hex
    if not _ID.fullmatch(load_id):
        raise ValueError(f"load ids are letters, digits and _.- only: {load_id!r}")
    return load_id


def folder_of(sink: str, load: str) -> str:
    return f"{sink}/load={load}"


def published_loads(spark: SparkSession, layout: LakeLayout) -> list[str]:
    """Ids of the visible loads."""
    names = child_names(spark, f"{layout.loads}/published")
    return sorted(name for name in names if _ID.fullmatch(name))


def publish_load(spark: SparkSession, layout: LakeLayout, load: str) -> None:
    touch(spark, f"{layout.loads}/published/{load}")


def read_loads(spark: SparkSession, layout: LakeLayout, loads: list[str] | None = None) -> DataFrame | None:
    """Silver of the visible loads, or of the named ones; None without any."""
    named = published_loads(spark, layout) if loads is None else loads
    if not named:
        return None
    paths = [folder_of(layout.silver_batch, load) for load in named]
    return spark.read.schema(schemas.SILVER).parquet(*paths)


def load_audits(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """The three counts of every visible load."""
    folder, loads = f"{layout.loads}/audits", published_loads(spark, layout)
    schema = f"{AUDIT_SCHEMA}, load string"
    if not loads:
        return spark.createDataFrame([], schema)
    paths = [folder_of(folder, load) for load in loads]
    return spark.read.schema(schema).option("basePath", folder).json(paths)
