"""Streaming queries over the review topic.

Every function takes the source as a DataFrame: Kafka in production, replayed files in
tests. Each query has a checkpoint of its own and is restarted on it after a failure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from opinlake import schemas
from opinlake.functions.review import sentiment_of
from opinlake.layout import LakeLayout, StreamSettings
from opinlake.operators.catalog import enrich_with_catalog
from opinlake.operators.events import decode, events_to_silver, open_envelope, rejected
from opinlake.session import child_names, delete_path, lake_session, touch
from opinlake.sources.events import kafka_stream

AVAILABLE_NOW = {"availableNow": True}

# Names of the queries and of their checkpoints.
BRONZE_QUERY, BRONZE_CHECKPOINT = "bronze_reviews", "bronze_reviews_raw"
SILVER_QUERY, SILVER_CHECKPOINT = "silver_reviews", "silver_reviews_enriched"
REJECTED_QUERY, REJECTED_CHECKPOINT = "rejected_reviews", "rejected_reviews_raw"


# --- relations ----------------------------------------------------------------------


def sentiment_counts(records: DataFrame) -> DataFrame:
    reviews = decode(open_envelope(records))
    return reviews.groupBy(sentiment_of(F.col("score")).alias("sentiment")).agg(
        F.count(F.lit(1)).alias("review_count")
    )


def product_scores(records: DataFrame) -> DataFrame:
    """Counts and averages per product, most reviewed first. The order makes the result one
    for complete mode only."""
    return (
        decode(open_envelope(records))
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("review_count"),
            F.round(F.avg("score"), 2).alias("average_score"),
        )
        .orderBy(F.desc("review_count"))
    )


# --- sinks --------------------------------------------------------------------------


def start_file_sink(
    rows: DataFrame,
    fmt: str,
    path: str,
    checkpoint: str,
    trigger: dict,
    name: str | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Append files, each micro-batch committed as a whole to the folder's log. Files older than
    `retention` leave the log some time."""
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if fmt == "json":
        writer = writer.options(**schemas.JSON_OPTIONS)
    if retention:
        writer = writer.option("retention", retention)
    return (writer.queryName(name) if name else writer).start()


def start_bronze(records: DataFrame, layout: LakeLayout, trigger: dict) -> StreamingQuery:
    """The raw records as JSON."""
    return start_file_sink(
        open_envelope(records),
        "json",
        layout.bronze_stream,
        layout.checkpoint(BRONZE_CHECKPOINT),
        trigger,
        BRONZE_QUERY,
    )


def start_silver(
    records: DataFrame,
    layout: LakeLayout,
    trigger: dict,
    on_bad: str = "keep",
    retention: str | None = None,
) -> StreamingQuery:
    """Enriched reviews into the stream lane of silver. With a `retention`, compact the lane more often
    than that."""
    return start_file_sink(
        events_to_silver(records, on_bad),
        "parquet",
        layout.silver_stream,
        layout.checkpoint(SILVER_CHECKPOINT),
        trigger,
        SILVER_QUERY,
        retention,
    )


def start_rejects(records: DataFrame, layout: LakeLayout, trigger: dict) -> StreamingQuery:
    """The records that a quarantine keeps out of silver, raw, with the reason."""
    return start_file_sink(
        rejected(open_envelope(records)),
        "json",
        layout.bronze_rejected,
        layout.checkpoint(REJECTED_CHECKPOINT),
        trigger,
        REJECTED_QUERY,
    )


def start_console(
    rows: DataFrame,
    name: str,
    mode: str = "append",
    shown: int = 20,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Show the first rows of each micro-batch (append) or of the result so far (complete).

    Spark's own console sink sends a whole micro-batch to the driver to print a few rows of
    it. Here a limit, or a top-k where the rows are in order, leaves `shown` of them.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"{name}, batch {batch_id}")
        batch.limit(shown).show(shown, truncate=False)

    with state_partition_number(rows.sparkSession, state_partitions):
        return rows.writeStream.queryName(name).outputMode(mode).foreachBatch(show).start()


def start_result_table(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict, state_partitions: int | None = None
) -> StreamingQuery:
    """Keep the whole result of an aggregate as a table, written anew by each micro-batch.

    The executors write it, nothing passes the driver. Every micro-batch has a folder of its
    own and becomes visible by an empty file that is made last; the result before it stays
    until the next one is visible, so a reader is never left without its files. A micro-batch
    repeated after a failure rewrites its own folder. State is spread over
    `state_partitions`, a number the checkpoint keeps for good.
    """

    def store(result: DataFrame, batch_id: int) -> None:
        spark = result.sparkSession
        result.write.mode("overwrite").parquet(_result_folder(path, batch_id))
        touch(spark, f"{path}/{_PUBLISHED}/{batch_id}")
        for old in _published(spark, path):
            if old < batch_id - 1:
                delete_path(spark, f"{path}/{_PUBLISHED}/{old}")
                delete_path(spark, _result_folder(path, old))

    with state_partition_number(rows.sparkSession, state_partitions):
        return (
            rows.writeStream.outputMode("complete")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(store)
            .trigger(**trigger)
            .start()
        )


_PUBLISHED = "_published"


def _result_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def _published(spark: SparkSession, path: str) -> list[int]:
    names = child_names(spark, f"{path}/{_PUBLISHED}")
    return sorted(int(name) for name in names if name.isdigit())


def latest_result(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table the newest finished micro-batch left, without rows before the first one. It
    can be read at any time, also while the next result is being written."""
    published = _published(spark, path)
    if not published:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_result_folder(path, published[-1]))


def start_enriched(
    reviews: DataFrame,
    read_catalog: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict,
) -> StreamingQuery:
    """Reviews with product names, appended to the folder `path`.

    The catalog is read and measured again for every micro-batch: products added later are
    found, an overwritten catalog does no harm, and one that has outgrown the broadcast limit
    is joined by a shuffle from then on. A repeated micro-batch rewrites its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        named = enrich_with_catalog(batch, read_catalog())
        named.write.mode("overwrite").parquet(_result_folder(path, batch_id))

    return (
        reviews.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(**trigger)
        .start()
    )


@contextmanager
def state_partition_number(spark: SparkSession, number: int | None) -> Iterator[None]:
    """A query copies the session settings when it starts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if number:
            spark.conf.set(key, number)
        yield
    finally:
        spark.conf.set(key, before)


# --- running ------------------------------------------------------------------------


def finish(*queries: StreamingQuery) -> None:
    """Wait for bounded queries (`AVAILABLE_NOW`); a failure of one is raised."""
    for query in queries:
        query.awaitTermination()


def run_until_any_ends(spark: SparkSession, *queries: StreamingQuery) -> None:
    """Wait for the first query to end, then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def run_lake_writer() -> None:
    """Bronze and silver from the topic, as two independent queries."""
    spark, layout = lake_session("opinlake-lake-writer")
    settings = StreamSettings.from_env()
    records = kafka_stream(spark, settings)
    run_until_any_ends(
        spark,
        start_bronze(records, layout, settings.trigger),
        start_silver(records, layout, settings.trigger),
    )


def run_console_reviews() -> None:
    """Show decoded reviews as they arrive."""
    spark, _ = lake_session("opinlake-console")
    reviews = decode(open_envelope(kafka_stream(spark, StreamSettings.from_env())))
    run_until_any_ends(spark, start_console(reviews, "live_reviews"))


def run_console_reports() -> None:
    """Show the two live aggregates."""
    spark, _ = lake_session("opinlake-console-reports")
    records = kafka_stream(spark, StreamSettings.from_env())
    # Streaming shuffles are not merged at run time: one partition per core is plenty here.
    cores = spark.sparkContext.defaultParallelism
    run_until_any_ends(
        spark,
        *(
            start_console(rows, name, "complete", state_partitions=cores)
            for name, rows in (
                ("reviews_by_sentiment", sentiment_counts(records)),
                ("product_score_summary", product_scores(records)),
            )
        ),
    )
