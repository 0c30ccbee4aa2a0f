"""Declared schemas. Nothing is inferred: inference costs a pass and lets data change types."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """A schema from `name type` pairs. Unlike the parser behind DDL strings this needs no
    running session, so the package can be imported before one exists."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names and types of the exchanged relations.

# Historical reviews. All text, so that a bad value reaches the cleaning rules instead of
# changing the type of its column.
HISTORY_CSV = _struct(
    "Id string, ProductId string, UserId string, ProfileName string,"
    " HelpfulnessNumerator string, HelpfulnessDenominator string,"
    " Score string, Time string, Summary string, Text string"
)

# The same file with the types a strict read insists on.
SAMPLE_CSV = _struct(
    "Id string, ProductId string, UserId string, ProfileName string,"
    " HelpfulnessNumerator string, HelpfulnessDenominator string,"
    " Score int, Time bigint, Summary string, Text string"
)

REQUIRED_HISTORY_COLUMNS = ("Id", "ProductId", "UserId", "Score", "Text", "Time")

KAFKA_RECORD = _struct(
    "key binary, value binary, topic string, partition int, offset bigint,"
    " timestamp timestamp, timestampType int"
)

REVIEW_EVENT = _struct(
    "product_id string, user_id string, score int, text string, source string,"
    " review_id string, created_at string"
)

# The fields an event cannot do without.
REQUIRED_EVENT_FIELDS = ("product_id", "user_id", "score", "text", "review_id", "created_at")

SILVER = _struct(
    "kafka_key string, topic string, partition int, offset bigint, kafka_timestamp timestamp,"
    " product_id string, user_id string, score int, text string, source string,"
    " review_id string, created_at timestamp,"
    " sentiment string, text_length int, word_count int,"
    " has_negative_keywords boolean, has_positive_keywords boolean"
)

CATALOG = _struct(
    "product_id string, name string, category string, description string,"
    " image_url string, price double, tags array<string>"
)

BRONZE_EVENT = _struct(
    "kafka_key string, json_value string, topic string, partition int, offset bigint,"
    " kafka_timestamp timestamp"
)

# JSON files keep the microseconds; by default Spark writes milliseconds.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

OPINION_COLUMNS = (
    "product_id",
    "user_id",
    "score",
    "sentiment",
    "text",
    "source",
    "review_id",
    "created_at",
    "text_length",
    "word_count",
    "has_negative_keywords",
    "has_positive_keywords",
)
