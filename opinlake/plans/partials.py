"""Partial aggregates of the dashboard, kept beside silver and merged when it is asked for.

Silver grows by units that never change: loads of the batch lane and runs of the compacted stream lane.
For each of them a partial cube (counts, sums, smallest and largest per key) and its newest opinions are
written once. A dashboard adds up the partials, a row for each unit and key, and scans only what has
none: new loads and runs, and files of the stream that no run covers. Sums of integers make the result
the same as that of one scan, to the last digit.

A unit's partials become visible by an empty file that is made last; a job that dies is run again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.operators import reports as rp
from opinlake.plans import compaction, loads
from opinlake.plans import dashboard as db
from opinlake.session import child_names, delete_path, materialize, touch


@dataclass(frozen=True)
class Units:
    """The parts that silver is made of, or some of them."""

    loads: list[str] = field(default_factory=list)
    runs: list[compaction.Run] = field(default_factory=list)
    files: list[str] = field(default_factory=list)

    def names(self) -> list[str]:
        """Of loads and runs; single files have no partials."""
        return [*(f"load-{load}" for load in self.loads), *(f"run-{run.run}" for run in self.runs)]

    def read(self, spark: SparkSession, layout: LakeLayout) -> DataFrame | None:
        parts = [loads.read_loads(spark, layout, self.loads)] if self.loads else []
        if self.runs or self.files:
            parts.append(compaction.read_parts(spark, layout, self.runs, self.files))
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def all_units(spark: SparkSession, layout: LakeLayout) -> Units:
    runs, files = compaction.stream_parts(spark, layout)
    return Units(loads.published_loads(spark, layout), runs, files)


def _published(spark: SparkSession, layout: LakeLayout) -> set[str]:
    return {n for n in child_names(spark, f"{layout.partials}/published") if not n.startswith(".")}


def _newest(rows: DataFrame) -> DataFrame:
    return rp.dashboard_opinions(rows.select(*schemas.OPINION_COLUMNS), db.DASHBOARD_RECENT)


def refresh_partials(spark: SparkSession, layout: LakeLayout) -> list[str]:
    """Write the partials of all loads and runs that have none, and delete those of runs that no
    manifest lists any more; returns the names of the units written."""
    units, known = all_units(spark, layout), _published(spark, layout)
    singles = [*(Units(loads=[load]) for load in units.loads), *(Units(runs=[run]) for run in units.runs)]
    written = []
    for unit in singles:
        (name,) = unit.names()
        if name in known:
            continue
        rows = unit.read(spark, layout)
        # A file or a few for each unit: as many rows as it has products, and some.
        db.partial_cube(rows).write.mode("overwrite").parquet(f"{layout.partials}/cubes/{name}")
        _newest(rows).write.mode("overwrite").parquet(f"{layout.partials}/newest/{name}")
        touch(spark, f"{layout.partials}/published/{name}")
        written.append(name)
    kept = {f"run-{run}" for run in compaction.held_runs(spark, layout)}
    for name in known:
        if name.startswith("run-") and name not in kept:
            for folder in ("published", "cubes", "newest"):
                delete_path(spark, f"{layout.partials}/{folder}/{name}")
    return written


def _with_partials(spark: SparkSession, layout: LakeLayout) -> tuple[list[str], Units]:
    """Names of the units that have partials, and the units that have none."""
    units, known = all_units(spark, layout), _published(spark, layout)
    covered = [name for name in units.names() if name in known]
    left = Units(
        [load for load in units.loads if f"load-{load}" not in known],
        [run for run in units.runs if f"run-{run.run}" not in known],
        units.files,
    )
    return covered, left


def incremental_inputs(spark: SparkSession, layout: LakeLayout) -> tuple[DataFrame, DataFrame]:
    """The cube and the rows to take the newest opinions from, lazy."""
    covered, left = _with_partials(spark, layout)
    rows = left.read(spark, layout)
    if rows is None and not covered:
        rows = spark.createDataFrame([], schemas.SILVER)
    cubes = [] if rows is None else [db.partial_cube(rows)]
    newest = [] if rows is None else [_newest(rows)]
    if covered:
        schema = db.partial_cube(spark.createDataFrame([], schemas.SILVER)).schema
        cubes.append(spark.read.schema(schema).parquet(*(f"{layout.partials}/cubes/{n}" for n in covered)))
        opinions = _newest(spark.createDataFrame([], schemas.SILVER)).schema
        newest.append(spark.read.schema(opinions).parquet(*(f"{layout.partials}/newest/{n}" for n in covered)))
    cube, opinions = cubes[0], newest[0]
    for part in cubes[1:]:
        cube = cube.unionByName(part)
    for part in newest[1:]:
        opinions = opinions.unionByName(part)
    return db.merge_cubes(cube), opinions


def incremental_dashboard(
    spark: SparkSession, layout: LakeLayout, catalog: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The dashboard of all visible silver, from partials where there are some."""
    cube, opinions = incremental_inputs(spark, layout)
    newest = rp.dashboard_opinions(materialize(opinions, "opinions"), db.DASHBOARD_RECENT, catalog)
    return db.dashboard(materialize(cube, "cube"), materialize(newest, "newest"), catalog)
