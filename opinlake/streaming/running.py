"""Running aggregates from the sums of each micro-batch.

A complete-mode query hands over its whole result with every trigger, however few keys changed. Here a
micro-batch is reduced to one row of sums for each key it holds and stored as a run; a reader adds up the
runs. What a trigger writes follows the keys of its micro-batch. There is no state store: the runs are
the state, and a query may be given other shuffle settings later.

`FAN` neighbouring runs of a level are added up to one of the next, so a row of sums is rewritten once
for each level and a reader meets less than `FAN` runs of each. A run becomes visible by an empty file
that is made last. A micro-batch repeated after a failure finds its run there, alone or within another,
and is left out, or rewrites what no reader has seen. Runs that a wider one covers stay until a later
trigger, so that readers that have listed them keep their files.

Keys may be NULL and are then a group of their own. Sums are of integers, so results do not depend on
the order in which runs are added up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opinlake.functions.review import sentiment_of
from opinlake.operators.events import decode, open_envelope
from opinlake.session import child_names, delete_path, touch

FAN = 4
_RUNS, _SHOWN = "runs", "_shown"

Span = tuple[int, int]  # first and last micro-batch of a run


@dataclass(frozen=True)
class RunningReport:
    """The keys of a report, the integers to add up for each, and the report's columns made of these."""

    keys: dict[str, Column]
    sums: dict[str, Column]
    columns: tuple[Column, ...]

    def parts(self, reviews: DataFrame) -> DataFrame:
        keyed = reviews.select(
            *(c.alias(name) for name, c in self.keys.items()), *(c.alias(name) for name, c in self.sums.items())
        )
        return self.added(keyed)

    def added(self, parts: DataFrame) -> DataFrame:
        sums = (F.sum(name).cast("long").alias(name) for name in self.sums)
        return parts.groupBy(*self.keys).agg(*sums)

    def result(self, parts: DataFrame) -> DataFrame:
        return self.added(parts).select(*self.keys, *self.columns)


def sentiment_report() -> RunningReport:
    return RunningReport(
        {"sentiment": sentiment_of(F.col("score"))},
        {"review_count": F.lit(1).cast("long")},
        (F.col("review_count"),),
    )


def product_report() -> RunningReport:
    """Counts and averages per product; a product without any score has none."""
    average = F.round(F.col("total") / F.col("scored"), 2)
    return RunningReport(
        {"product_id": F.col("product_id")},
        {
            "review_count": F.lit(1).cast("long"),
            "scored": F.col("score").isNotNull().cast("long"),
            "total": F.coalesce(F.col("score").cast("long"), F.lit(0).cast("long")),
        },
        (F.col("review_count"), F.when(F.col("scored") > 0, average).alias("average_score")),
    )


def start_running(
    records: DataFrame, report: RunningReport, path: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    """Keep the sums of a report over the records of the topic in the folder `path`."""
    reviews = decode(open_envelope(records))

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = shown_runs(spark, path)
        if not any(first <= batch_id <= last for first, last in before):
            _publish(report.parts(batch), path, (batch_id, batch_id))
        fold(spark, report, path)
        standing = visible(shown_runs(spark, path))
        for run in before:
            # Covered by a run that readers could see before this trigger.
            if run not in standing and any(_covers(wide, run) for wide in before if wide != run):
                delete_path(spark, _marker(path, run))
                delete_path(spark, _folder(path, run))

    return (
        reviews.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**trigger)
        .start()
    )


def fold(spark: SparkSession, report: RunningReport, path: str) -> None:
    """Add up `FAN` neighbouring runs of a level as long as some level has them."""
    while True:
        runs = visible(shown_runs(spark, path))
        levels: dict[int, list[Span]] = {}
        for run in runs:
            levels.setdefault(_level(run), []).append(run)
        full = [held[:FAN] for _, held in sorted(levels.items()) if len(held) >= FAN]
        if not full:
            return
        # No part of the sum may be read twice or left out: the runs lie side by side.
        merged = (full[0][0][0], full[0][-1][1])
        parts = spark.read.parquet(*(_folder(path, run) for run in full[0]))
        _publish(report.added(parts), path, merged)


def running_result(spark: SparkSession, report: RunningReport, path: str, schema: StructType) -> DataFrame:
    """The report over all micro-batches stored so far, without rows before the first one."""
    runs = visible(shown_runs(spark, path))
    if not runs:
        return spark.createDataFrame([], schema)
    return report.result(spark.read.parquet(*(_folder(path, run) for run in runs)))


def shown_runs(spark: SparkSession, path: str) -> list[Span]:
    names = (name.split("-") for name in child_names(spark, f"{path}/{_SHOWN}"))
    return sorted((int(n[0]), int(n[1])) for n in names if len(n) == 2 and all(x.isdigit() for x in n))


def visible(runs: list[Span]) -> list[Span]:
    """The runs that no wider one covers, in order."""
    return sorted(r for r in runs if not any(_covers(wide, r) for wide in runs if wide != r))


def _covers(wide: Span, run: Span) -> bool:
    return wide[0] <= run[0] and run[1] <= wide[1]


def _level(run: Span) -> int:
    size, level = run[1] - run[0] + 1, 0
    while size >= FAN:
        size, level = size // FAN, level + 1
    return level


def _folder(path: str, run: Span) -> str:
    return f"{path}/{_RUNS}/{run[0]}-{run[1]}"


def _marker(path: str, run: Span) -> str:
    return f"{path}/{_SHOWN}/{run[0]}-{run[1]}"


def _publish(parts: DataFrame, path: str, run: Span) -> None:
    parts.write.mode("overwrite").parquet(_folder(path, run))
    touch(parts.sparkSession, _marker(path, run))
