"""The reports over silver, each a DataFrame.

Every report reads only the columns it needs. Aggregates combine on the map side, so a
product with a third of all reviews sends one partial row per task. Reports with a limit end
in a top-k, never in a full sort, and order by all remaining columns to settle ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.functions import text as tx
from opinlake.functions.review import SENTIMENTS, has_opinion, is_counted
from opinlake.operators.catalog import with_product_name

# Accepted ranges and defaults of the report parameters.
LIMIT_RANGE = (1, 100)
MIN_REVIEWS_RANGE = (1, 1_000_000)
DEFAULT_LIMIT = 10
DEFAULT_RECENT = 20
DEFAULT_OPINIONS = 50
DEFAULT_RANKED_MIN = 5
DEFAULT_NEGATIVE_MIN = 3
UNKNOWN_SOURCE = "unknown"

# Fixed value: the smallest bar that is still visible, in percent.
SMALLEST_BAR = 6


def _check_range(name: str, value: int, bounds: tuple[int, int]) -> int:
    low, high = bounds
    if value < low or value > high:
        raise ValueError(f"{name} is {value}, allowed are {low} to {high}")
    return value


def check_limit(value: int) -> int:
    return _check_range("limit", value, LIMIT_RANGE)


def check_min_reviews(value: int) -> int:
    return _check_range("min_reviews", value, MIN_REVIEWS_RANGE)


def check_sentiment(value: str | None) -> str | None:
    if value is not None and value not in SENTIMENTS:
        raise ValueError(f"no such sentiment: {value}")
    return value


def counted(silver: DataFrame) -> DataFrame:
    return silver.where(is_counted(F.col("product_id")))


def _rows() -> Column:
    return F.count(F.lit(1))


# --- whole relation -----------------------------------------------------------------


def summary(silver: DataFrame) -> DataFrame:
    return counted(silver).agg(
        _rows().alias("total_reviews"),
        F.avg("score").alias("average_score"),
        F.min("created_at").alias("first_review_at"),
        F.max("created_at").alias("last_review_at"),
    )


def with_summary_defaults(summary_row: DataFrame) -> DataFrame:
    """Zero for missing numbers; a summary without any row becomes a row of zeros."""
    return summary_row.agg(
        F.coalesce(F.max("total_reviews"), F.lit(0)).cast("bigint").alias("total_reviews"),
        F.coalesce(F.max("average_score"), F.lit(0.0)).alias("average_score"),
        F.max("first_review_at").alias("first_review_at"),
        F.max("last_review_at").alias("last_review_at"),
    )


def total(silver: DataFrame) -> DataFrame:
    """All rows, test products included."""
    return silver.agg(_rows().alias("total_reviews"))


# --- counts per label ---------------------------------------------------------------


def count_by(rows: DataFrame, label: str) -> DataFrame:
    """Rows per value of `label`, NULL being a value of its own."""
    return rows.groupBy(label).agg(_rows().alias("review_count"))


def sentiment_counts(silver: DataFrame) -> DataFrame:
    return count_by(counted(silver), "sentiment").orderBy("sentiment")


def score_distribution(silver: DataFrame) -> DataFrame:
    return count_by(counted(silver), "score").orderBy("score")


def sources(silver: DataFrame) -> DataFrame:
    named = counted(silver).select(
        F.coalesce("source", F.lit(UNKNOWN_SOURCE)).alias("source")
    )
    return count_by(named, "source").orderBy(F.desc("review_count"), "source")


def raw_sources(silver: DataFrame) -> DataFrame:
    return count_by(silver, "source").orderBy(F.desc("review_count"), "source")


def score_distribution_dense(silver: DataFrame) -> DataFrame:
    """All five scores, zero where none was given. Five conditional counts in one pass: no
    join and no row moved but one partial result per task."""
    scores = range(1, 6)
    counts = counted(silver).agg(
        *(F.count_if(F.col("score") == score).alias(f"n{score}") for score in scores)
    )
    pairs = F.array(
        *(
            F.struct(F.lit(score).alias("score"), F.col(f"n{score}").alias("review_count"))
            for score in scores
        )
    )
    return counts.select(F.inline(pairs).alias("score", "review_count"))


def scaled(counts: DataFrame, value: str = "review_count") -> DataFrame:
    """Add the bar length in percent of the largest count. The largest comes from a scalar
    subquery over the same aggregate, whose shuffle both sides share."""
    largest = counts.agg(F.max(value)).scalar()
    share = F.col(value) / largest * 100
    percent = F.greatest(F.lit(SMALLEST_BAR), F.floor(share + 0.5).cast("int"))
    return counts.withColumn(
        "percent", F.when(F.coalesce(largest, F.lit(0)) == 0, F.lit(0)).otherwise(percent)
    )


# --- products -----------------------------------------------------------------------


def product_stats(rows: DataFrame, with_negative: bool = False) -> DataFrame:
    measures = [_rows().alias("review_count"), F.avg("score").alias("average_score")]
    if with_negative:
        negatives = F.count_if(F.col("sentiment") == "negative")
        measures.insert(0, negatives.alias("negative_review_count"))
    return rows.groupBy("product_id").agg(*measures)


def _best(rows: DataFrame, limit: int, order: list[Column], catalog: DataFrame | None) -> DataFrame:
    """Top-k with the names looked up for the k rows only, then put in order again."""
    order = [*order, F.asc_nulls_first("product_id")]
    best = rows.orderBy(*order).limit(check_limit(limit))
    return best if catalog is None else with_product_name(best, catalog).orderBy(*order)


def most_reviewed(
    stats: DataFrame, limit: int = DEFAULT_LIMIT, catalog: DataFrame | None = None
) -> DataFrame:
    order = [F.desc("review_count"), F.desc_nulls_last("average_score")]
    return _best(stats, limit, order, catalog)


def best_rated(
    stats: DataFrame,
    limit: int = DEFAULT_LIMIT,
    min_reviews: int = DEFAULT_RANKED_MIN,
    catalog: DataFrame | None = None,
) -> DataFrame:
    enough = stats.where(F.col("review_count") >= check_min_reviews(min_reviews))
    order = [F.desc_nulls_last("average_score"), F.desc("review_count")]
    return _best(enough, limit, order, catalog)


def worst_rated(
    stats: DataFrame,
    limit: int = DEFAULT_LIMIT,
    min_reviews: int = DEFAULT_RANKED_MIN,
    catalog: DataFrame | None = None,
) -> DataFrame:
    enough = stats.where(F.col("review_count") >= check_min_reviews(min_reviews))
    order = [F.asc_nulls_first("average_score"), F.desc("review_count")]
    return _best(enough, limit, order, catalog)


def most_negative(
    stats: DataFrame,
    limit: int = DEFAULT_LIMIT,
    min_reviews: int = DEFAULT_NEGATIVE_MIN,
    catalog: DataFrame | None = None,
) -> DataFrame:
    disliked = stats.where(
        (F.col("review_count") >= check_min_reviews(min_reviews))
        & (F.col("negative_review_count") > 0)
    )
    order = [F.desc("negative_review_count"), F.asc_nulls_first("average_score")]
    return _best(disliked, limit, order, catalog)


def product_scores(
    silver: DataFrame, limit: int = DEFAULT_LIMIT, catalog: DataFrame | None = None
) -> DataFrame:
    return most_reviewed(product_stats(counted(silver)), limit, catalog)


def top_products(
    silver: DataFrame,
    limit: int = DEFAULT_LIMIT,
    min_reviews: int = DEFAULT_RANKED_MIN,
    catalog: DataFrame | None = None,
) -> DataFrame:
    return best_rated(product_stats(counted(silver)), limit, min_reviews, catalog)


def worst_products(
    silver: DataFrame,
    limit: int = DEFAULT_LIMIT,
    min_reviews: int = DEFAULT_RANKED_MIN,
    catalog: DataFrame | None = None,
) -> DataFrame:
    return worst_rated(product_stats(counted(silver)), limit, min_reviews, catalog)


def negative_products(
    silver: DataFrame,
    limit: int = DEFAULT_LIMIT,
    min_reviews: int = DEFAULT_NEGATIVE_MIN,
    catalog: DataFrame | None = None,
) -> DataFrame:
    stats = product_stats(counted(silver), with_negative=True)
    return most_negative(stats, limit, min_reviews, catalog)


# --- keywords -----------------------------------------------------------------------


def keyword_count(silver: DataFrame, kind: str) -> DataFrame:
    """Reviews with a keyword of this kind and a text. Told from stored columns alone."""
    if kind not in ("negative", "positive"):
        raise ValueError("kind must be negative or positive")
    hits = counted(silver).where(F.col(f"has_{kind}_keywords") & has_opinion())
    return hits.agg(F.lit(kind).alias("keyword_type"), _rows().alias("matching_reviews"))


# --- opinions -----------------------------------------------------------------------

# Some decades above the smallest instant there is, in microseconds: as a floor it keeps every
# row of silver. Earlier instants cannot be stored, as Parquet's calendar check overflows there.
_FIRST_MICROS = -(2**63) + 2**50


def opinions(
    silver: DataFrame,
    limit: int = DEFAULT_OPINIONS,
    sentiment: str | None = None,
    catalog: DataFrame | None = None,
) -> DataFrame:
    """The newest reviews with a text, of one sentiment or all."""
    check_sentiment(sentiment)
    wanted = has_opinion()
    if sentiment is not None:
        wanted = wanted & (F.col("sentiment") == sentiment)
    return _newest(silver, limit, wanted, wanted, catalog)


def recent_reviews(
    silver: DataFrame, limit: int = DEFAULT_RECENT, catalog: DataFrame | None = None
) -> DataFrame:
    return opinions(silver, limit, None, catalog)


def dashboard_opinions(
    silver: DataFrame, limit: int = DEFAULT_RECENT, catalog: DataFrame | None = None
) -> DataFrame:
    """The newest reviews with visible text, white space of every kind not being such. The
    test comes before the limit, so blank rows take no place."""
    visible = has_opinion() & tx.has_visible_text(F.col("text"))
    surely_visible = has_opinion() & (
        F.col("has_negative_keywords") | F.col("has_positive_keywords")
    )
    return _newest(silver, limit, visible, surely_visible, catalog)


def _newest(
    silver: DataFrame,
    limit: int,
    wanted: Column,
    sure: Column,
    catalog: DataFrame | None,
) -> DataFrame:
    """The newest `limit` rows of `wanted`, without reading all texts.

    Text makes up most of silver. A first top-k over narrow columns finds an instant that at
    least `limit` wanted rows reach; `sure` must imply `wanted` and need no text. As a scalar
    subquery that instant is pushed into the Parquet scan, which then skips the row groups
    of older reviews. With fewer sure rows than `limit` the floor is the smallest instant
    there is and nothing is skipped. The result is the exact top-k either way.
    """
    check_limit(limit)
    dated = counted(silver).where(F.col("created_at").isNotNull())
    newest = dated.where(sure).select("created_at").orderBy(F.desc("created_at")).limit(limit)
    since = newest.agg(
        F.when(F.count(F.lit(1)) >= limit, F.min("created_at"))
        .otherwise(F.timestamp_micros(F.lit(_FIRST_MICROS)))
        .alias("since")
    ).scalar()
    ties = ("review_id", "product_id", "user_id", "score", "source", "text")
    order = [F.desc("created_at"), *(F.asc_nulls_first(name) for name in ties)]
    rows = (
        dated.where(wanted & (F.col("created_at") >= since))
        .select(*schemas.OPINION_COLUMNS)
        .orderBy(*order)
        .limit(limit)
    )
    return rows if catalog is None else with_product_name(rows, catalog).orderBy(*order)
