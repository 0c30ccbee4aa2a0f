"""Looking up, searching and joining the product catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinlake.functions.review import lookup_key, product_label

# A dimension is broadcast up to this many bytes of values.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
ALL_CATEGORIES = "All"


def sized_for_broadcast(
    dimension: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Ask for a broadcast of `dimension` only when its measured size allows it.

    One aggregate over the (few, already selected) columns measures it; the estimate from
    compressed files can be far too low. Past the limit the frame comes back unhinted and
    the join becomes a shuffle join, whose hot keys adaptive execution splits.
    """
    per_row = [F.octet_length(F.col(name).cast("string")) for name in dimension.columns]
    row_bytes = sum((F.coalesce(size, F.lit(0)) for size in per_row), F.lit(16 * len(per_row)))
    total = dimension.agg(F.sum(row_bytes.cast("bigint"))).first()[0] or 0
    return F.broadcast(dimension) if total <= limit_bytes else dimension


def with_product_name(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add `product_name` to a report; NULL where the catalog has no such product.

    Left to the optimizer, which broadcasts the catalog below its own threshold: measuring
    would cost more than joining the at most 100 rows of a report.
    """
    return _left_lookup(rows, _names(catalog))


def enrich_with_catalog(
    reviews: DataFrame, catalog: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Add `product_name` to every review. The large side is not moved while the names fit
    the broadcast limit. The catalog must list a product once (`quality.repeated_products`)."""
    return _left_lookup(reviews, sized_for_broadcast(_names(catalog), limit_bytes))


def _names(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        F.col("product_id").alias("listed_id"), F.col("name").alias("product_name")
    )


def _left_lookup(rows: DataFrame, names: DataFrame) -> DataFrame:
    return rows.join(
        names, lookup_key(F.col("product_id")) == F.col("listed_id"), "left"
    ).drop("listed_id")


def with_label(rows: DataFrame) -> DataFrame:
    """The text a product is shown under."""
    label = product_label(F.col("product_name"), F.col("product_id"))
    return rows.withColumn("product_label", label)


def find_product(catalog: DataFrame, product_id: str) -> DataFrame:
    """The product of this id, whatever its case and surrounding white space. The id is
    brought into form on the driver so that the plain comparison reaches the scan."""
    return catalog.where(F.col("product_id") == product_id.strip().upper())


def search(catalog: DataFrame, term: str = "", category: str = ALL_CATEGORIES) -> DataFrame:
    """Products of a category whose name, category, description or tags contain `term`."""
    found = catalog
    if category != ALL_CATEGORIES:
        found = found.where(F.col("category") == category)
    wanted = term.strip().lower()
    if wanted:
        haystack = F.lower(F.concat_ws(" ", "name", "category", "description", "tags"))
        found = found.where(F.contains(haystack, F.lit(wanted)))
    return found


def categories(catalog: DataFrame) -> DataFrame:
    return catalog.select("category").distinct().orderBy("category")


def tag_text(catalog: DataFrame, separator: str = "|") -> DataFrame:
    """Tags as one text, for outputs that take no arrays."""
    return catalog.withColumn("tags", F.array_join("tags", separator))
