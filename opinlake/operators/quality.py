"""Checks that split rows into valid and quarantined ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.functions import text as tx
from opinlake.functions.review import lookup_key
from opinlake.operators.catalog import sized_for_broadcast
from opinlake.operators.cleaning import HIGHEST_SCORE, LOWEST_SCORE
from opinlake.operators.events import DEFAULT_SOURCE

REASON = "rejection"

# The longest accepted texts, in characters.
MAX_LENGTHS = {"product_id": 100, "user_id": 100, "text": 2000, "source": 50}

# How a rejection names the field.
FIELD_LABELS = {
    "product_id": "Product id",
    "user_id": "User id",
    "text": "Review text",
    "source": "Review source",
}


def _first_reason(*rules: tuple[Column, str]) -> Column:
    """The text of the first broken rule, NULL when none is broken."""
    return F.coalesce(*(F.when(broken, F.lit(reason)) for broken, reason in rules))


def _text_rules(name: str) -> tuple[tuple[Column, str], ...]:
    value, label = F.coalesce(F.col(name), F.lit("")), FIELD_LABELS[name]
    return (
        (value == "", f"{label} is required"),
        (F.length(value) > MAX_LENGTHS[name], f"{label} is too long"),
    )


def check_reviews(submissions: DataFrame) -> DataFrame:
    """Strip the text fields and add the first broken rule, if any, as `rejection`."""
    stripped = {name: tx.strip(F.col(name)) for name in ("product_id", "user_id", "text")}
    stripped["source"] = tx.strip(F.coalesce("source", F.lit(DEFAULT_SOURCE)))
    score_ok = F.coalesce(F.col("score").between(LOWEST_SCORE, HIGHEST_SCORE), F.lit(False))
    score_rule = (~score_ok, f"Review score must be between {LOWEST_SCORE} and {HIGHEST_SCORE}")
    return submissions.withColumns(stripped).withColumn(
        REASON,
        _first_reason(
            *_text_rules("product_id"),
            *_text_rules("user_id"),
            score_rule,
            *_text_rules("text"),
            *_text_rules("source"),
        ),
    )


def check_products(products: DataFrame) -> DataFrame:
    """Strip the texts, drop blank tags and add the first broken rule as `rejection`."""
    names = ("product_id", "name", "category", "description", "image_url")
    stripped: dict[str, Column] = {name: tx.strip(F.col(name)) for name in names}
    stripped["tags"] = F.filter(F.transform("tags", tx.strip), lambda tag: tag != "")

    def missing(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    return products.withColumns(stripped).withColumn(
        REASON,
        _first_reason(
            (missing("product_id"), "Product id is required"),
            (missing("name"), "Product name is required"),
            (missing("category"), "Product category is required"),
            (F.col("price") < 0, "Product price cannot be negative"),
            (missing("image_url"), "Product image URL is required"),
        ),
    )


def repeated_products(products: DataFrame) -> DataFrame:
    """Ids that stand in a catalog more than once. A catalog used for lookups must have none:
    each entry of an id would repeat the reviews of its product."""
    listed = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("entries"))
    return listed.where(F.col("entries") > 1)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON)


def quarantined(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull())


def write_split(checked: DataFrame, path: str) -> None:
    """Both lanes in one pass over the input, as `lane=accepted` and `lane=quarantined`."""
    lane = F.when(F.col(REASON).isNull(), "accepted").otherwise("quarantined")
    checked.withColumn("lane", lane).write.mode("append").partitionBy("lane").parquet(path)


def rejection_counts(checked: DataFrame) -> DataFrame:
    return (
        quarantined(checked)
        .groupBy(F.col(REASON).alias("reason"))
        .agg(F.count(F.lit(1)).alias("rejected"))
        .orderBy("reason")
    )


def known_products(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    """Reviews whose product the catalog lists."""
    return _against_catalog(reviews, catalog, "left_semi")


def unknown_products(reviews: DataFrame, catalog: DataFrame) -> DataFrame:
    """Reviews whose product is missing or not listed."""
    return _against_catalog(reviews, catalog, "left_anti")


def _against_catalog(reviews: DataFrame, catalog: DataFrame, how: str) -> DataFrame:
    ids = sized_for_broadcast(catalog.select(F.col("product_id").alias("listed_id")))
    return reviews.join(ids, lookup_key(F.col("product_id")) == F.col("listed_id"), how)
