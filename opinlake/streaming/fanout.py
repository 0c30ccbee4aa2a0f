"""Bronze, silver and rejects from one read of the topic.

Two queries on one topic read it twice and may stand at different offsets. Here one query has all
sinks: a micro-batch is stored as bronze, silver and the rejects are made from that stored copy, and a
marker that is made last shows all of them at once. The topic is read once for each micro-batch.

Every sink has a folder `batch=N` for each micro-batch. A query finishes its micro-batches in order, so
the marker of N shows all up to N; older markers are deleted and there is nothing to list that grows. A
micro-batch that died half way is invisible in every sink; Spark repeats it from the offsets in the
checkpoint, and it rewrites its own folders. One that had its marker already is left as it is.

The numbers are those of the checkpoint. A lane that has visible micro-batches cannot be continued
without it: `start_fanout` refuses, since a new count would begin within what is visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from opinlake import schemas
from opinlake.functions.review import enrich
from opinlake.layout import LakeLayout, StreamSettings
from opinlake.operators.events import decode, open_envelope, rejected
from opinlake.plans.micro_batches import batch_folder, last_visible, show_batch
from opinlake.session import child_names, lake_session
from opinlake.sources.events import kafka_stream, read_bronze

# Names of the query and of its checkpoint.
FANOUT_QUERY, FANOUT_CHECKPOINT = "lake_reviews", "lake_reviews_fanout"


def store_batch(batch: DataFrame, batch_id: int, layout: LakeLayout, on_bad: str = "keep") -> None:
    """One micro-batch of records into all sinks, shown at the end."""
    spark = batch.sparkSession
    seen = last_visible(spark, layout)
    if seen is not None and batch_id <= seen:
        return
    raw = batch_folder(layout.fanout_bronze, batch_id)
    open_envelope(batch).write.mode("overwrite").options(**schemas.JSON_OPTIONS).json(raw)
    bronze = read_bronze(spark, raw)
    reviews = enrich(decode(bronze, on_bad)).select(*schemas.SILVER.fieldNames())
    reviews.write.mode("overwrite").parquet(batch_folder(layout.fanout_silver, batch_id))
    if on_bad == "quarantine":
        refused = rejected(bronze).write.mode("overwrite").options(**schemas.JSON_OPTIONS)
        refused.json(batch_folder(layout.fanout_rejected, batch_id))
    show_batch(spark, layout, batch_id)


def start_fanout(records: DataFrame, layout: LakeLayout, trigger: dict, on_bad: str = "keep") -> StreamingQuery:
    """All sinks of the lake by one query."""
    if on_bad not in ("keep", "quarantine"):
        raise ValueError("on_bad must be keep or quarantine")
    spark, checkpoint = records.sparkSession, layout.checkpoint(FANOUT_CHECKPOINT)
    if last_visible(spark, layout) is not None and not child_names(spark, f"{checkpoint}/offsets"):
        raise RuntimeError(f"the lane has visible micro-batches, but its checkpoint is gone: {checkpoint}")
    return (
        records.writeStream.queryName(FANOUT_QUERY)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: store_batch(batch, batch_id, layout, on_bad))
        .trigger(**trigger)
        .start()
    )


def run_fanout_writer(on_bad: str = "keep") -> None:
    """Bronze, silver and rejects from the topic, by one query."""
    spark, layout = lake_session("opinlake-lake-fanout")
    settings = StreamSettings.from_env()
    start_fanout(kafka_stream(spark, settings), layout, settings.trigger, on_bad).awaitTermination()
