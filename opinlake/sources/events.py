"""The review topic: as a stream, as a bounded batch, and as replayed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.layout import StreamSettings


def _kafka_options(settings: StreamSettings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.brokers,
        "subscribe": settings.topic,
        "failOnDataLoss": str(settings.fail_on_data_loss).lower(),
    }


def kafka_stream(spark: SparkSession, settings: StreamSettings) -> DataFrame:
    """The topic from `starting_offsets` on; a restart goes on from the checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .options(**_kafka_options(settings))
        .option("startingOffsets", settings.starting_offsets)
    )
    if settings.max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", settings.max_offsets_per_trigger)
    return reader.load()


def kafka_batch(
    spark: SparkSession, settings: StreamSettings, ending_offsets: str = "latest"
) -> DataFrame:
    """All messages the topic holds now, or those up to offsets given as Kafka's JSON: a look
    at the first messages of a large topic need not read it to the end."""
    return (
        spark.read.format("kafka")
        .options(**_kafka_options(settings))
        .option("startingOffsets", "earliest")
        .option("endingOffsets", ending_offsets)
        .load()
    )


def replay_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Kafka-shaped Parquet files as a stream, for tests and backfills."""
    reader = spark.readStream.schema(schemas.KAFKA_RECORD)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def first_messages(records: DataFrame, n: int = 5) -> DataFrame:
    """The oldest `n` messages, key and value as text."""
    return (
        records.select(
            F.col("key").cast("string").alias("kafka_key"),
            F.col("value").cast("string").alias("json_value"),
            "partition",
            "offset",
        )
        .orderBy("offset", "partition")
        .limit(n)
    )


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """The raw records of the stream's bronze folder."""
    return spark.read.schema(schemas.BRONZE_EVENT).options(**schemas.JSON_OPTIONS).json(path)


def bronze_peek(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    """The first `n` raw records by offset."""
    return read_bronze(spark, path).orderBy("offset", "partition", "topic").limit(n)
