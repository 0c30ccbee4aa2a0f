"""Rules of the review relation: sentiment, enrichment, row predicates, labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.functions import text as tx

SENTIMENTS = ("positive", "neutral", "negative")


def sentiment_of(score: Column) -> Column:
    """4 and up is positive, 3 neutral, anything else negative, a missing score too."""
    return (
        F.when(score >= 4, F.lit("positive"))
        .when(score == 3, F.lit("neutral"))
        .otherwise(F.lit("negative"))
    )


def enrich(
    reviews: DataFrame, count_words: Callable[[Column], Column] = tx.word_count
) -> DataFrame:
    """Add the five derived columns. Runs once, at write time; reports read the results."""
    text = F.col("text")
    return reviews.withColumns(
        {
            "sentiment": sentiment_of(F.col("score")),
            "text_length": tx.text_length(text),
            "word_count": count_words(text),
            "has_negative_keywords": tx.mentions_any(text, tx.NEGATIVE_WORDS),
            "has_positive_keywords": tx.mentions_any(text, tx.POSITIVE_WORDS),
        }
    )


def is_counted(product_id: Column) -> Column:
    """Everything but the products of end-to-end tests; a missing product counts."""
    return product_id.isNull() | ~F.upper(product_id).startswith("E2E")


def has_opinion() -> Column:
    """The text is not blank, told from the stored word count: it is zero exactly for
    missing and blank texts. Reports need not read the text column for this test."""
    return F.col("word_count") > 0


def lookup_key(product_id: Column) -> Column:
    """Catalog ids are matched in upper case without surrounding white space."""
    return F.upper(tx.strip(product_id))


def product_label(name: Column, product_id: Column) -> Column:
    """The name, else the id, else a fixed text."""
    return F.coalesce(
        F.nullif(name, F.lit("")), F.nullif(product_id, F.lit("")), F.lit("Unknown product")
    )
