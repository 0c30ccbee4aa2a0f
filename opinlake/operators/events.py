"""Review events: Kafka records in, reviews out, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.functions.review import enrich
from opinlake.functions.times import from_iso_text, to_iso_text

_ORIGIN = ("kafka_key", "topic", "partition", "offset", "kafka_timestamp")
_CORRUPT = "_corrupt"

# What an event carries when the submission leaves it out.
DEFAULT_SOURCE = "web"
DEFAULT_USER = "web-client"


def open_envelope(records: DataFrame) -> DataFrame:
    """Key and value as text, the rest of the Kafka record as it is: the bronze shape."""
    return (
        records.withColumns(
            {"kafka_key": F.col("key").cast("string"), "json_value": F.col("value").cast("string")}
        )
        .withColumnRenamed("timestamp", "kafka_timestamp")
        .select(*schemas.BRONZE_EVENT.fieldNames())
    )


def decode(bronze: DataFrame, on_bad: str = "keep") -> DataFrame:
    """Reviews out of JSON values.

    `keep` lets a value that is no valid event through with NULL fields. `quarantine` drops
    it here; `undecodable` yields exactly those rows with their raw text.
    """
    if on_bad not in ("keep", "quarantine"):
        raise ValueError("on_bad must be keep or quarantine")
    if on_bad == "keep":
        fields = bronze.withColumn("event", F.from_json("json_value", schemas.REVIEW_EVENT))
        fields = fields.select(*_ORIGIN, "event.*")
    else:
        fields = _checked(bronze).where(_is_event())
    names = schemas.REVIEW_EVENT.fieldNames()
    return fields.select(
        *_ORIGIN, *names[:-1], from_iso_text(F.col("created_at")).alias("created_at")
    )


def undecodable(bronze: DataFrame) -> DataFrame:
    """The bronze rows whose value is missing or no valid event."""
    return rejected(bronze).drop("reason")


def rejected(bronze: DataFrame) -> DataFrame:
    """The rows that a quarantine keeps out, with the first reason that applies. Together with
    `decode(..., "quarantine")` these are all rows."""
    checked = _checked(bronze).withColumn("reason", _fault()).where(~_is_event())
    return checked.select(*schemas.BRONZE_EVENT.fieldNames(), "reason")


def _checked(bronze: DataFrame) -> DataFrame:
    """Bronze rows with the event fields and the text of a corrupt event next to them.

    The struct is unpacked by a generator: Catalyst moves no filter below one, so a test of
    the fields does not parse the JSON a second time.
    """
    schema = f"{schemas.REVIEW_EVENT.toDDL()}, {_CORRUPT} string"
    event = F.from_json("json_value", schema, {"columnNameOfCorruptRecord": _CORRUPT})
    return bronze.select(*schemas.BRONZE_EVENT.fieldNames(), F.inline(F.array(event)))


def _fault() -> Column:
    """Why a value is no event, or NULL: it needs a text, a JSON object in it of the right
    types, and every required field."""
    reason = F.lit(None).cast("string")
    for name in reversed(schemas.REQUIRED_EVENT_FIELDS):
        reason = F.when(F.col(name).isNull(), f"{name} is missing").otherwise(reason)
    return (
        F.when(F.col("json_value").isNull(), "no value")
        .when(~F.col("json_value").rlike(r"\S"), "blank value")
        .when(F.col(_CORRUPT).isNotNull(), "not the JSON of an event")
        .otherwise(reason)
    )


def _is_event() -> Column:
    return _fault().isNull()


def events_to_silver(records: DataFrame, on_bad: str = "keep") -> DataFrame:
    """Kafka records all the way to the silver schema."""
    reviews = enrich(decode(open_envelope(records), on_bad))
    return reviews.select(*schemas.SILVER.fieldNames())


def with_defaults(
    submissions: DataFrame,
    review_id: Column | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    """Fill in what a submission may leave out and stamp identity and time.

    Pass `review_id` built with `stable_id` from columns that identify a submission when the
    result goes to a sink that may write a row twice: a recomputed task then repeats the id
    instead of drawing a new one.
    """
    return submissions.withColumns(
        {
            "source": F.coalesce("source", F.lit(DEFAULT_SOURCE)),
            "user_id": F.coalesce("user_id", F.lit(DEFAULT_USER)),
            "review_id": review_id if review_id is not None else F.uuid(),
            "created_at": created_at if created_at is not None else F.current_timestamp(),
        }
    )


def stable_id(*columns: Column) -> Column:
    """An id in UUID form that depends on nothing but the values of the columns. As JSON they
    stay apart: `a` next to `bc` gives another id than `ab` next to `c`."""
    values = F.struct(*(column.alias(f"c{n}") for n, column in enumerate(columns)))
    digest = F.md5(F.to_json(values))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, start, size) for start, size in cuts))


def encode(reviews: DataFrame, *keep: str) -> DataFrame:
    """Key and value for the topic, whole frame at once: the key is the product id unless
    empty, the value a JSON object of the seven event fields, nulls included. Columns named
    in `keep` are passed along."""
    names = schemas.REVIEW_EVENT.fieldNames()
    body = F.struct(*names[:-1], to_iso_text(F.col("created_at")).alias("created_at"))
    return reviews.select(
        F.when(F.col("product_id") != "", F.col("product_id")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )


def publish(reviews: DataFrame, brokers: str, topic: str) -> None:
    """Write encoded events to Kafka, from all tasks in parallel."""
    (
        encode(reviews)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )
