"""Cleaning of historical rows and their move to the silver shape."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.functions import text as tx
from opinlake.functions.review import enrich
from opinlake.functions.times import from_epoch_seconds

# The source label of historical rows and the score range.
HISTORY_SOURCE = "amazon_csv"
LOWEST_SCORE, HIGHEST_SCORE = 1, 5

NONBLANK_COLUMNS = ("ProductId", "UserId", "Text")


def whole_number(text: Column, kind: str) -> Column:
    """The number in the text, or NULL when it is none, has a fraction or does not fit. `5.0`
    is the whole number 5: exports write columns that once had a gap as doubles. A plain cast
    would end the job at the first bad value. Only what is no plain integer is tried as a decimal."""
    number = text.try_cast("decimal(38,18)")
    whole = F.when(number == F.floor(number), number.try_cast(kind))
    return F.coalesce(text.try_cast(kind), whole)


def created_at() -> Column:
    """The instant of a historical row."""
    return from_epoch_seconds(whole_number(F.col("Time"), "bigint"))


def keep_required(raw: DataFrame) -> DataFrame:
    """Rows with all required columns. Written as single tests, which Spark hands down to
    the scan; `dropna` becomes one opaque expression that stays above it."""
    present = (F.col(name).isNotNull() for name in schemas.REQUIRED_HISTORY_COLUMNS)
    return raw.where(reduce(operator.and_, present))


def keep_nonblank(raw: DataFrame) -> DataFrame:
    present = (tx.has_nonblank_text(F.col(name)) for name in NONBLANK_COLUMNS)
    return raw.where(reduce(operator.and_, present))


def keep_in_range(raw: DataFrame) -> DataFrame:
    score = whole_number(F.col("Score"), "int")
    return raw.where(
        score.between(LOWEST_SCORE, HIGHEST_SCORE)
        & whole_number(F.col("Id"), "bigint").isNotNull()
        & created_at().isNotNull()
    )


def rejected_history(raw: DataFrame) -> DataFrame:
    """The rows that cleaning drops, each with the first reason that applies. Together with
    `clean_history` these are all rows."""
    seconds = whole_number(F.col("Time"), "bigint")
    score = whole_number(F.col("Score"), "int")
    reason = F.lit(None).cast("string")
    for test, words in reversed(
        [
            *((F.col(c).isNull(), f"{c} is missing") for c in schemas.REQUIRED_HISTORY_COLUMNS),
            *((~tx.has_nonblank_text(F.col(c)), f"{c} is blank") for c in NONBLANK_COLUMNS),
            (score.isNull(), "Score is no whole number"),
            (~score.between(LOWEST_SCORE, HIGHEST_SCORE), "Score is out of range"),
            (whole_number(F.col("Id"), "bigint").isNull(), "Id is no whole number"),
            (seconds.isNull(), "Time is no whole number"),
            (from_epoch_seconds(seconds).isNull(), "Time is outside the years 1 to 9999"),
        ]
    ):
        reason = F.when(test, words).otherwise(reason)
    return raw.withColumn("reason", reason).where(F.col("reason").isNotNull())


def clean_history(raw: DataFrame) -> DataFrame:
    """Rows that can become reviews. Three narrow filters, merged into one by Catalyst."""
    return keep_in_range(keep_nonblank(keep_required(raw)))


def history_to_silver(cleaned: DataFrame) -> DataFrame:
    """Cleaned historical rows in the silver schema, without a Kafka origin."""
    values = {
        "product_id": F.col("ProductId"),
        "user_id": F.col("UserId"),
        "score": whole_number(F.col("Score"), "int"),
        "text": F.col("Text"),
        "source": F.lit(HISTORY_SOURCE),
        "review_id": whole_number(F.col("Id"), "bigint").cast("string"),
        "created_at": created_at(),
    }
    enriched = enrich(cleaned.select(*(value.alias(name) for name, value in values.items())))
    present = set(enriched.columns)
    return enriched.select(
        *(
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.SILVER.fields
        )
    )
