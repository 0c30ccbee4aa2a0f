"""Repeated reviews: a batch run twice, a message sent twice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.session import FREE_SHUFFLES, materialize, with_settings

REVIEW_KEY = ["review_id", "source"]

# A round holds about so much before it is compressed, unless that takes more rounds than these. Each reads
# the table again, so their number must not grow with it.
ROUND_BYTES, MOST_ROUNDS = 2 << 30, 4

_ROUND = FREE_SHUFFLES | {"spark.sql.parquet.compression.codec": "zstd"}


def drop_repeats(reviews: DataFrame) -> DataFrame:
    """One row per review id and source, rows without an id as they are.

    Of repeats the earliest stays; the remaining columns settle ties, so the surviving row is
    the same on every run. One aggregate that combines on the map side: a review that was
    sent a million times moves once a task.
    """
    names = reviews.columns
    first = [name for name in ("created_at", "kafka_timestamp", "offset") if name in names]
    # The keys are equal in a group: they settle nothing and need not move twice.
    order = [*first, *(name for name in names if name not in (*first, *REVIEW_KEY))]
    known = reviews.where(F.col("review_id").isNotNull())
    # NULL sorts before every value in a struct: a missing time does not win over a known one.
    ranked = F.struct(
        *(F.col(name).isNull().alias(f"no_{name}") for name in first), *(F.col(n) for n in order)
    )
    kept = known.groupBy(*(F.col(key).alias(f"key_{key}") for key in REVIEW_KEY)).agg(
        F.min(ranked).alias("row")
    )
    kept = kept.select(
        *(F.col(f"key_{name}" if name in REVIEW_KEY else f"row.`{name}`").alias(name) for name in names)
    )
    return kept.unionAll(reviews.where(F.col("review_id").isNull()))


def _row_bytes(reviews: DataFrame) -> Column:
    """Bytes of a row in a shuffle, about."""
    texts = [f.name for f in reviews.schema.fields if f.dataType.typeName() in ("string", "binary")]
    sizes = (F.coalesce(F.octet_length(F.col(name)), F.lit(0)).cast("long") for name in texts)
    return reduce(Column.__add__, sizes, F.lit(8 * len(reviews.columns)).cast("long"))


def drop_repeats_in_rounds(
    reviews: DataFrame, round_bytes: int = ROUND_BYTES, most_rounds: int = MOST_ROUNDS
) -> DataFrame:
    """`drop_repeats` for a table that would not fit the disks beside all of its copies at once.

    Every copy of a review has to meet the others with its text. Ids are dealt out to rounds by their
    hash. The rows of one round are brought together and what is left of them is written; then its
    shuffle files go, before the next round. In a task only a round's rows are sorted, so fewer are
    spilled. The last round, of a small table the only one, is left to whatever uses the result.
    """
    known = F.col("review_id").isNotNull()
    total = reviews.where(known).agg(F.sum(_row_bytes(reviews))).first()[0] or 0
    rounds = min(most_rounds, -(-total // round_bytes))
    if rounds <= 1:
        return drop_repeats(reviews)
    number = F.pmod(F.xxhash64(*REVIEW_KEY), F.lit(rounds))
    kept = drop_repeats(reviews.where(~known | (number == 0)))
    with with_settings(reviews.sparkSession, _ROUND):
        for k in range(1, rounds):
            part = drop_repeats(reviews.where(known & (number == k)))
            kept = kept.unionAll(materialize(part, "without_repeats"))
    return kept


def drop_stream_repeats(reviews: DataFrame, event_time: str, delay: str) -> DataFrame:
    """The same on a stream, where the first to arrive stays: what is written cannot be taken
    back. State older than the watermark is let go, so it stays bounded. Repeated ids that are
    later than the watermark are dropped by Spark (`numRowsDroppedByWatermark` of the progress
    counts them); rows without an id pass whenever they come.
    """
    known = reviews.where(F.col("review_id").isNotNull())
    once = known.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(REVIEW_KEY)
    return once.union(reviews.where(F.col("review_id").isNull()))
