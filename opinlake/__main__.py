"""The jobs by name: `python -m opinlake JOB`, or this file given to `spark-submit`."""

from __future__ import annotations

import argparse

from opinlake.layout import StreamSettings
from opinlake.operators import reports
from opinlake.plans import batch_ingest, partials, snapshot
from opinlake.plans.compaction import compact_stream_lane
from opinlake.session import lake_session
from opinlake.sources import events as event_source
from opinlake.sources.catalog import read_catalog
from opinlake.sources.silver import (
    create_external_tables,
    first_rows,
    list_tables,
    read_silver,
    silver_preview,
    table_peek,
)
from opinlake.streaming import fanout, jobs

# What the raw report shows at most of each relation.
SHOWN = 100


def _silver(spark, layout, options: argparse.Namespace):
    return read_silver(spark, layout, options.lanes, options.optional_lanes)


def preview_silver(options: argparse.Namespace) -> None:
    spark, layout = lake_session("opinlake-preview")
    silver = _silver(spark, layout, options)
    print(f"rows: {silver.count()}")
    silver_preview(silver).show(20, truncate=False)


def create_tables(options: argparse.Namespace) -> None:
    """Tables that outlive the job need a catalog that does: one that is held in memory is
    refused, as it would be gone with the job."""
    spark, layout = lake_session("opinlake-tables")
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        raise SystemExit(
            "the catalog of this session ends with the job; submit with"
            " spark.sql.catalogImplementation=hive and a metastore"
        )
    print(create_external_tables(spark, layout, options.database))


def publish(options: argparse.Namespace) -> None:
    spark, layout = lake_session("opinlake-snapshot")
    catalog = read_catalog(spark, options.catalog) if options.catalog else None
    silver = _silver(spark, layout, options)
    print(snapshot.publish_snapshot(spark, layout, silver, catalog, options.keep))


def peek_topic(_: argparse.Namespace) -> None:
    spark, _layout = lake_session("opinlake-peek-topic")
    records = event_source.kafka_batch(spark, StreamSettings.from_env())
    event_source.first_messages(records).show(truncate=False)


def peek_bronze(_: argparse.Namespace) -> None:
    spark, layout = lake_session("opinlake-peek-bronze")
    event_source.bronze_peek(spark, layout.bronze_stream).show(truncate=False)


def peek_table(options: argparse.Namespace) -> None:
    spark, _layout = lake_session("opinlake-peek-table")
    print(list_tables(spark, options.database))
    table = f"{options.database}.{options.table}"
    table_peek(spark, table).show(100, truncate=False)
    first_rows(spark, table).show(truncate=False)


def compact_silver(_: argparse.Namespace) -> None:
    spark, layout = lake_session("opinlake-compact")
    print(f"files: {compact_stream_lane(spark, layout)}")


def refresh_partials(_: argparse.Namespace) -> None:
    spark, layout = lake_session("opinlake-partials")
    print(f"units: {partials.refresh_partials(spark, layout)}")


def raw_report(options: argparse.Namespace) -> None:
    """The aggregates over all rows, test products included."""
    spark, layout = lake_session("opinlake-raw-report")
    silver = _silver(spark, layout, options)
    stats = reports.product_stats(silver, True)
    for relation in (
        reports.total(silver),
        reports.count_by(silver, "sentiment").orderBy("sentiment"),
        reports.count_by(silver, "score").orderBy("score"),
        reports.raw_sources(silver),
        reports.best_rated(stats),
        reports.worst_rated(stats),
        reports.most_negative(stats),
    ):
        relation.show(SHOWN, truncate=False)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="opinlake", description=__doc__)
    parser.add_argument("--database", default="reviews")
    parser.add_argument("--table", default="reviews_enriched")
    parser.add_argument("--catalog", help="path of the product catalog (Parquet)")
    parser.add_argument("--on-bad", choices=["keep", "quarantine"], default="keep", help="malformed events")
    parser.add_argument("--load-id", help="id of a load, to repeat it if it fails")
    parser.add_argument("--keep", type=int, help="snapshots to keep, all if not given")
    names = {"type": lambda text: text.split(","), "metavar": "LANE[,LANE]"}
    parser.add_argument("--lanes", default=["batch", "stream"], help="lanes of silver", **names)
    parser.add_argument("--optional-lanes", default=[], help="lanes that may be missing", **names)
    parser.add_argument("job", choices=sorted(JOBS))
    options = parser.parse_args(arguments)
    JOBS[options.job](options)


JOBS = {
    "ingest-history": lambda options: batch_ingest.main(options.load_id),
    "write-lake": lambda _: jobs.run_lake_writer(),
    "write-lake-once": lambda options: fanout.run_fanout_writer(options.on_bad),
    "show-reviews": lambda _: jobs.run_console_reviews(),
    "show-reports": lambda _: jobs.run_console_reports(),
    "preview-silver": preview_silver,
    "create-tables": create_tables,
    "publish-snapshot": publish,
    "peek-topic": peek_topic,
    "peek-bronze": peek_bronze,
    "peek-table": peek_table,
    "raw-report": raw_report,
    "compact-silver": compact_silver,
    "refresh-partials": refresh_partials,
}


if __name__ == "__main__":
    main()
