"""The dashboard: all reports of one moment, from as few passes over silver as possible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinlake.functions.review import has_opinion
from opinlake.operators import reports as rp

# The relations of a dashboard.
DASHBOARD_REPORTS = (
    "summary",
    "sentiment",
    "score_distribution",
    "top_products",
    "worst_products",
    "negative_products",
    "recent_reviews",
    "sources",
    "opinions",
    "negative_keywords",
    "positive_keywords",
)

DASHBOARD_TOP = 10
DASHBOARD_RECENT = 20
DASHBOARD_MIN_REVIEWS = 1

_LEVELS = {
    "sentiment": "sentiment",
    "score": "score",
    "source": "source",
    "product": "product_id",
}


def _by_level(silver: DataFrame, trusted: bool, *scores: Column) -> DataFrame:
    """Counts on five grouping levels, and the given measures of the score (`points`).

    Each row counts on every level. They are combined on the map side, so what is
    shuffled is one row per task for each product and next to nothing for the other levels.
    (Combining per product, score and source first, to expand fewer rows, was slower: it
    shuffles a row per combination.)
    """
    # Grouping columns read as NULL on the other levels, so the measures use copies of them.
    rows = silver if trusted else rp.counted(silver)
    named = F.col("source") if trusted else F.coalesce("source", F.lit(rp.UNKNOWN_SOURCE))
    texts = F.lit(True) if trusted else has_opinion()
    rows = rows.withColumns(
        {"source": named, "points": F.col("score"), "tone": F.col("sentiment")}
    )
    level = F.lit("all")
    for name, column in _LEVELS.items():
        level = F.when(F.grouping(column) == 0, F.lit(name)).otherwise(level)
    columns = list(_LEVELS.values())
    return rows.groupingSets([[], *([column] for column in columns)], *columns).agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("review_count"),
        *scores,
        F.count_if(F.col("tone") == "negative").alias("negative_review_count"),
        F.min("created_at").alias("first_review_at"),
        F.max("created_at").alias("last_review_at"),
        *(
            F.count_if(F.col(f"has_{kind}_keywords") & texts).alias(f"{kind}_keyword_reviews")
            for kind in ("negative", "positive")
        ),
    )


def report_cube(silver: DataFrame, trusted: bool = False) -> DataFrame:
    """Every aggregate of the dashboard from one scan of narrow columns. Of a `trusted` sample
    nothing is filtered out, and sources keep their names."""
    return _by_level(silver, trusted, F.avg("points").alias("average_score"))


def partial_cube(silver: DataFrame) -> DataFrame:
    """The cube of a part of silver, with sums that can be added up. See `merge_cubes`."""
    points = (F.sum("points").alias("score_sum"), F.count("points").alias("score_count"))
    return _by_level(silver, False, *points)


def merge_cubes(partials: DataFrame) -> DataFrame:
    """The cube of all parts from the rows of their partial cubes. The row over all rows is there
    once, also where every part had one."""
    counts = (
        "review_count", "score_sum", "score_count", "negative_review_count",
        "negative_keyword_reviews", "positive_keyword_reviews",
    )
    merged = partials.groupBy("level", *_LEVELS.values()).agg(
        *(F.sum(name).alias(name) for name in counts),
        F.min("first_review_at").alias("first_review_at"),
        F.max("last_review_at").alias("last_review_at"),
    )
    return merged.select(
        *_LEVELS.values(), "level", "review_count",
        F.try_divide(F.col("score_sum").cast("double"), "score_count").alias("average_score"),
        "negative_review_count", "first_review_at", "last_review_at",
        "negative_keyword_reviews", "positive_keyword_reviews",
    )


def _level(cube: DataFrame, name: str) -> DataFrame:
    return cube.where(F.col("level") == name)


def _keyword_row(cube: DataFrame, kind: str) -> DataFrame:
    hits = F.coalesce(F.max(f"{kind}_keyword_reviews"), F.lit(0)).cast("bigint")
    return _level(cube, "all").agg(
        F.lit(kind).alias("keyword_type"), hits.alias("matching_reviews")
    )


def newest_opinions(silver: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """The rows of both lists of opinions."""
    return rp.dashboard_opinions(silver, DASHBOARD_RECENT, catalog)


def dashboard(
    cube: DataFrame, newest: DataFrame, catalog: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The eleven relations by name.

    `cube` (`report_cube`) and `newest` (`newest_opinions`) should be written tables, see
    `session.materialize`: nine relations read the one and two the other, and lazy frames
    would scan silver for each.
    """
    products = _level(cube, "product")
    stats = products.select("product_id", "review_count", "average_score")
    negative = products.select(
        "product_id", "negative_review_count", "review_count", "average_score"
    )
    totals = _level(cube, "all").select(
        F.col("review_count").alias("total_reviews"),
        "average_score",
        "first_review_at",
        "last_review_at",
    )
    top, least = DASHBOARD_TOP, DASHBOARD_MIN_REVIEWS
    return {
        "summary": rp.with_summary_defaults(totals),
        "sentiment": _level(cube, "sentiment")
        .select("sentiment", "review_count")
        .orderBy("sentiment"),
        "score_distribution": _level(cube, "score")
        .select("score", "review_count")
        .orderBy("score"),
        "top_products": rp.best_rated(stats, top, least, catalog),
        "worst_products": rp.worst_rated(stats, top, least, catalog),
        "negative_products": rp.most_negative(negative, top, least, catalog),
        "recent_reviews": newest,
        "sources": _level(cube, "source")
        .select("source", "review_count")
        .orderBy(F.desc("review_count"), "source"),
        "opinions": newest,
        "negative_keywords": _keyword_row(cube, "negative"),
        "positive_keywords": _keyword_row(cube, "positive"),
    }


def dashboard_by_report(
    silver: DataFrame, catalog: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The same relations, each straight from silver: eleven scans, no table between."""
    top, least = DASHBOARD_TOP, DASHBOARD_MIN_REVIEWS
    newest = rp.dashboard_opinions(silver, DASHBOARD_RECENT, catalog)
    return {
        "summary": rp.with_summary_defaults(rp.summary(silver)),
        "sentiment": rp.sentiment_counts(silver),
        "score_distribution": rp.score_distribution(silver),
        "top_products": rp.top_products(silver, top, least, catalog),
        "worst_products": rp.worst_products(silver, top, least, catalog),
        "negative_products": rp.negative_products(silver, top, least, catalog),
        "recent_reviews": newest,
        "sources": rp.sources(silver),
        "opinions": newest,
        "negative_keywords": rp.keyword_count(silver, "negative"),
        "positive_keywords": rp.keyword_count(silver, "positive"),
    }


def analytics_bundle(silver: DataFrame, catalog: DataFrame | None = None) -> dict[str, DataFrame]:
    """The small bundle: summary, sentiments, most reviewed products."""
    return {
        "summary": rp.with_summary_defaults(rp.summary(silver)),
        "sentiment": rp.sentiment_counts(silver),
        "products": rp.product_scores(silver, rp.DEFAULT_LIMIT, catalog),
    }


def sample_newest(sample: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """The newest rows of a sample, for both lists of opinions."""
    ties = ("review_id", "product_id", "user_id", "score", "text")
    order = [F.desc("created_at"), *(F.asc_nulls_first(name) for name in ties)]
    newest = sample.orderBy(*order).limit(DASHBOARD_RECENT)
    return newest if catalog is None else rp.with_product_name(newest, catalog).orderBy(*order)


def sample_dashboard(
    cube: DataFrame, newest: DataFrame, catalog: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The dashboard of a trusted sample: nothing filtered out, sources by name. It differs from
    the live one in its inputs, `report_cube(..., trusted=True)` and `sample_newest`."""
    relations = dashboard(cube, newest, catalog)
    return relations | {"sources": relations["sources"].orderBy("source")}
