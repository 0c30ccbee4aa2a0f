"""Compaction of the stream lane in tiers: sorted runs beside the many small files of the sink.

The stream's file sink owns its folder and its log; nothing in it is changed. A compaction takes the
files of the log that no run covers yet and writes their rows as a run of level 0, in the order of
time, with the list of these files. Where a level would hold `fanout` runs they are written as one run
of the next level instead. So a row is rewritten once for each level, not by every compaction, and
there are few runs.

The runs that count are listed in a manifest, which becomes visible by an empty file that is made last.
A compaction starts from the newest manifest, so rows stay when the sink's retention drops their files
from its log; let that be longer than the time between two compactions. A job that dies half way leaves
nothing visible and is simply run again, one at a time. Readers take the runs of the newest manifest
and, from the log, the files that they do not cover. Runs that none of the `keep` newest manifests
lists are deleted.

The lane may also have been written by the query that has all sinks (`streaming/fanout.py`): the files
of its visible micro-batches count as files of the log, and `forget_covered` deletes those that runs hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.plans.micro_batches import read_fanout_silver, visible_folders
from opinlake.session import child_names, delete_path, touch

FANOUT = 4
_PUBLISHED = "_published"
_FILES = "path string"
_RUNS = "run string, level int"


@dataclass(frozen=True)
class Run:
    run: str
    level: int


def _published(spark: SparkSession, layout: LakeLayout) -> list[str]:
    """Names of the visible manifests, oldest first."""
    names = child_names(spark, f"{layout.silver_compacted}/{_PUBLISHED}")
    return sorted(name for name in names if not name.startswith("."))


def _runs_of(spark: SparkSession, layout: LakeLayout, manifest: str) -> list[Run]:
    """A manifest's runs: some for each level, and levels are few."""
    path = f"{layout.silver_compacted}/manifests/{manifest}"
    return sorted((Run(*r) for r in spark.read.schema(_RUNS).parquet(path).collect()), key=lambda r: r.run)


def current_runs(spark: SparkSession, layout: LakeLayout) -> list[Run]:
    published = _published(spark, layout)
    return _runs_of(spark, layout, published[-1]) if published else []


def _folder(layout: LakeLayout, run: Run) -> str:
    return f"{layout.silver_compacted}/runs/{run.run}"


def _lane(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """What the file sink's log lists and what visible micro-batches of the fan-out hold. The sink's
    folder may be missing if there are some of the latter, or runs that hold all of them."""
    shared = read_fanout_silver(spark, layout)
    try:
        own = spark.read.schema(schemas.SILVER).parquet(layout.silver_stream)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND" or (shared is None and not _published(spark, layout)):
            raise
        own = spark.createDataFrame([], schemas.SILVER)
    return own if shared is None else own.unionByName(shared)


def _rows(spark: SparkSession, layout: LakeLayout, runs: Iterable[Run], files: Iterable[str]) -> DataFrame:
    """Rows of runs and of files of the sink, each read by name."""
    parts = [[f"{_folder(layout, run)}/rows" for run in runs], list(files)]
    frames = [spark.read.schema(schemas.SILVER).parquet(*paths) for paths in parts if paths]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def _covered(spark: SparkSession, layout: LakeLayout, runs: Iterable[Run]) -> set[str]:
    """The files that runs cover. Their names pass the driver, as they do in the log of the sink."""
    paths = [f"{_folder(layout, run)}/files" for run in runs]
    if not paths:
        return set()
    return {row["path"] for row in spark.read.schema(_FILES).parquet(*paths).toLocalIterator()}


def compact_stream_lane(
    spark: SparkSession, layout: LakeLayout, keep: int = 2, fanout: int = FANOUT
) -> int:
    """Write and publish a run of what no run covers, together with the runs that it fills the level
    of; returns the number of the log's files that are covered then. Without new files nothing is
    written."""
    if fanout < 2:
        raise ValueError("a level must hold two runs at least")
    files, runs = _lane(spark, layout).inputFiles(), current_runs(spark, layout)
    covered = _covered(spark, layout, runs)
    fresh = [path for path in files if path not in covered]
    if not fresh:
        return len(files)
    published = _published(spark, layout)
    name = f"{int(published[-1].split('-')[0]) + 1 if published else 1:012d}-{uuid.uuid4().hex}"
    level, merged = 0, []
    while len(filled := [run for run in runs if run.level == level]) + 1 >= fanout:
        merged += filled
        level += 1
    own = Run(name, level)
    rows = _rows(spark, layout, merged, fresh)
    by_time = rows.repartitionByRange("created_at").sortWithinPartitions("created_at")
    by_time.write.parquet(f"{_folder(layout, own)}/rows")
    # Files that have left the log need not be known any more.
    still = _covered(spark, layout, merged).intersection(files)
    listed = spark.createDataFrame([(path,) for path in [*sorted(still), *fresh]], _FILES)
    listed.coalesce(1).write.parquet(f"{_folder(layout, own)}/files")
    left = [run for run in runs if run not in merged] + [own]
    manifest = spark.createDataFrame([(run.run, run.level) for run in left], _RUNS)
    manifest.coalesce(1).write.parquet(f"{layout.silver_compacted}/manifests/{name}")
    touch(spark, f"{layout.silver_compacted}/{_PUBLISHED}/{name}")
    _clear(spark, layout, max(1, keep))
    return len(files)


def held_runs(spark: SparkSession, layout: LakeLayout, keep: int | None = None) -> set[str]:
    """Names of the runs that any manifest, or one of the `keep` newest, lists."""
    names = _published(spark, layout)[-keep if keep else 0 :]
    return {run.run for name in names for run in _runs_of(spark, layout, name)}


def _clear(spark: SparkSession, layout: LakeLayout, keep: int) -> None:
    published, held = _published(spark, layout), held_runs(spark, layout, keep)
    for old in published[:-keep]:
        delete_path(spark, f"{layout.silver_compacted}/{_PUBLISHED}/{old}")
        delete_path(spark, f"{layout.silver_compacted}/manifests/{old}")
    for run in child_names(spark, f"{layout.silver_compacted}/runs"):
        if run not in held:
            delete_path(spark, f"{layout.silver_compacted}/runs/{run}")


def read_stream_lane(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """The stream lane: the newest runs and what has come since."""
    lane, runs = _lane(spark, layout), current_runs(spark, layout)
    if not runs:
        return lane
    covered = _covered(spark, layout, runs)
    return _rows(spark, layout, runs, [path for path in lane.inputFiles() if path not in covered])


def stream_parts(spark: SparkSession, layout: LakeLayout) -> tuple[list[Run], list[str]]:
    """The newest runs, and the files of the log that they do not cover. No stream lane, no parts."""
    try:
        files = _lane(spark, layout).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return [], []
    runs = current_runs(spark, layout)
    covered = _covered(spark, layout, runs)
    return runs, [path for path in files if path not in covered]


def read_parts(spark: SparkSession, layout: LakeLayout, runs: list[Run], files: list[str]) -> DataFrame:
    """Silver of some runs and files, of one at least."""
    return _rows(spark, layout, runs, files)


def forget_covered(spark: SparkSession, layout: LakeLayout) -> int:
    """Delete the fan-out's silver folders whose files every manifest that is kept covers, so that a
    reader that began before the newest compaction keeps its files; returns their number. Not beside
    external tables, which show the lanes' own files."""
    held = [_covered(spark, layout, _runs_of(spark, layout, name)) for name in _published(spark, layout)]
    gone = 0
    for folder in visible_folders(spark, layout, layout.fanout_silver) if held else []:
        files = spark.read.schema(schemas.SILVER).parquet(folder).inputFiles()
        if all(path in covered for path in files for covered in held):
            delete_path(spark, folder)
            gone += 1
    return gone


def covered_share(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """How many files the lane has and how many of them runs cover: a sign when to compact."""
    files = _lane(spark, layout).inputFiles()
    covered = _covered(spark, layout, current_runs(spark, layout)).intersection(files)
    return spark.createDataFrame([(len(files), len(covered))], "files int, covered int")


def run_sizes(spark: SparkSession, layout: LakeLayout) -> DataFrame:
    """run, level and number of rows of the runs that count."""
    made = spark.createDataFrame([], f"{_RUNS}, rows bigint")
    for run in current_runs(spark, layout):
        rows = spark.read.schema(schemas.SILVER).parquet(f"{_folder(layout, run)}/rows")
        counted = rows.agg(F.count("*").alias("rows"))
        made = made.unionAll(counted.select(F.lit(run.run), F.lit(run.level), "rows"))
    return made
