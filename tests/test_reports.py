import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opinlake.operators import reports as rp
from tests.sample import FIRST_SECOND, ROWS


@pytest.fixture(scope="module")
def silver(make_silver):
    return make_silver(
        [
            {
                "product_id": product,
                "user_id": f"U{n}",
                "score": score,
                "text": text,
                "source": "amazon_csv",
                "review_id": str(n),
                "created_at": datetime(2026, 1, 1) + timedelta(days=n - 1),
            }
            for n, (product, score, text, _) in enumerate(ROWS, start=1)
        ]
    ).cache()


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_summary(silver):
    assert FIRST_SECOND == 1767225600
    assert rows(rp.summary(silver)) == [
        (16, 3.5625, datetime(2026, 1, 1), datetime(2026, 1, 16))
    ]


def test_counts(silver):
    assert rows(rp.sentiment_counts(silver)) == [("negative", 4), ("neutral", 3), ("positive", 9)]
    scores = [(1, 1), (2, 3), (3, 3), (4, 4), (5, 5)]
    assert rows(rp.score_distribution(silver)) == scores
    assert rows(rp.score_distribution_dense(silver)) == scores
    assert rows(rp.sources(silver)) == [("amazon_csv", 16)]


def test_product_scores(silver):
    assert rows(rp.product_scores(silver, 12)) == [
        ("P001", 2, 5.0), ("P003", 2, 4.5), ("P006", 2, 3.5), ("P008", 2, 2.0),
        ("P010", 1, 5.0), ("P002", 1, 4.0), ("P007", 1, 4.0), ("P009", 1, 4.0),
        ("P005", 1, 3.0), ("P011", 1, 3.0), ("P004", 1, 2.0), ("P012", 1, 2.0),
    ]


def test_top_and_worst(silver):
    top = [(p, a) for p, _, a in rows(rp.top_products(silver, min_reviews=1))]
    assert top == [
        ("P001", 5.0), ("P010", 5.0), ("P003", 4.5), ("P002", 4.0), ("P007", 4.0),
        ("P009", 4.0), ("P006", 3.5), ("P005", 3.0), ("P011", 3.0), ("P008", 2.0),
    ]
    worst = [(p, a) for p, _, a in rows(rp.worst_products(silver, min_reviews=1))]
    assert worst == [
        ("P008", 2.0), ("P004", 2.0), ("P012", 2.0), ("P005", 3.0), ("P011", 3.0),
        ("P006", 3.5), ("P002", 4.0), ("P007", 4.0), ("P009", 4.0), ("P003", 4.5),
    ]
    assert rows(rp.top_products(silver)) == []
    assert rows(rp.worst_products(silver)) == []


def test_negative_products(silver):
    report = rp.negative_products(silver, min_reviews=1)
    columns = ("product_id", "negative_review_count", "review_count", "average_score")
    assert rows(report.select(*columns)) == [
        ("P004", 1, 1, 2.0), ("P008", 1, 2, 2.0), ("P012", 1, 1, 2.0), ("P006", 1, 2, 3.5),
    ]


def test_keywords(silver):
    assert rows(rp.keyword_count(silver, "negative")) == [("negative", 5)]
    assert rows(rp.keyword_count(silver, "positive")) == [("positive", 11)]
    with pytest.raises(ValueError):
        rp.keyword_count(silver, "neutral")


def test_newest_first(silver):
    assert [r.review_id for r in rp.recent_reviews(silver, 3).collect()] == ["16", "15", "14"]
    assert [r.review_id for r in rp.opinions(silver, 2, "negative").collect()] == ["14", "12"]
    assert rp.opinions(silver, 100).count() == 16


@pytest.mark.parametrize(
    ("report", "parameters"),
    [
        (rp.recent_reviews, {"limit": 0}),
        (rp.recent_reviews, {"limit": 101}),
        (rp.opinions, {"limit": 0}),
        (rp.opinions, {"sentiment": "angry"}),
        (rp.product_scores, {"limit": 101}),
        (rp.top_products, {"min_reviews": 0}),
        (rp.worst_products, {"min_reviews": 1_000_001}),
        (rp.negative_products, {"limit": -1}),
        (rp.negative_products, {"min_reviews": 0}),
    ],
)
def test_parameters_out_of_range(silver, report, parameters):
    with pytest.raises(ValueError):
        report(silver, **parameters)


def test_empty_silver(make_silver):
    empty = make_silver([{"product_id": "x"}]).where("false")
    assert rows(rp.summary(empty)) == [(0, None, None, None)]
    assert rows(rp.with_summary_defaults(rp.summary(empty))) == [(0, 0.0, None, None)]
    assert rows(rp.with_summary_defaults(rp.summary(empty).where("false"))) == [
        (0, 0.0, None, None)
    ]
    assert rows(rp.keyword_count(empty, "negative")) == [("negative", 0)]
    assert rows(rp.sentiment_counts(empty)) == []
    assert rows(rp.recent_reviews(empty)) == []
    assert rows(rp.scaled(rp.sentiment_counts(empty))) == []
    assert rows(rp.score_distribution_dense(empty)) == [(n, 0) for n in range(1, 6)]


def test_test_products_and_missing_products(make_silver):
    silver = make_silver(
        [
            {"product_id": "e2e-1", "score": 1, "text": "bad"},
            {"product_id": None, "score": None, "text": None},
            {"product_id": "P1", "score": 5, "text": "good", "source": "web"},
        ]
    )
    assert rows(rp.summary(silver))[0][:2] == (2, 5.0)
    assert rows(rp.total(silver)) == [(3,)]
    assert rows(rp.sources(silver)) == [("unknown", 1), ("web", 1)]
    assert rows(rp.raw_sources(silver)) == [(None, 2), ("web", 1)]
    assert rows(rp.keyword_count(silver, "negative")) == [("negative", 0)]


def test_bars(spark):
    values = [("a", 200), ("b", 25), ("c", 1), ("d", 0)]
    counts = spark.createDataFrame(values, "l string, review_count bigint")
    bars = {r.l: r.percent for r in rp.scaled(counts).collect()}
    assert bars == {"a": 100, "b": 13, "c": 6, "d": 6}
    zero = spark.createDataFrame([("a", 0)], "l string, review_count bigint")
    assert [r.percent for r in rp.scaled(zero).collect()] == [0]


def test_blank_rows_take_no_place_on_the_dashboard(make_silver):
    start = datetime(2026, 1, 1)
    silver = make_silver(
        [
            {
                "product_id": "P1",
                "score": 3,
                "text": "\n\t" if n % 2 else f"text {n}",
                "review_id": str(n),
                "created_at": start + timedelta(hours=n),
            }
            for n in range(60)
        ]
    )
    shown = rp.dashboard_opinions(silver, 20).collect()
    assert [r.review_id for r in shown] == [str(n) for n in range(58, 18, -2)]
    loose = rp.recent_reviews(silver, 20).collect()
    assert [r.review_id for r in loose] == [str(n) for n in range(59, 39, -1)]


@pytest.mark.parametrize("seed", range(4))
def test_top_k_agrees_with_brute_force(make_silver, seed):
    """Ties in time, missing times, few or many rows with keywords, blanks."""
    random.seed(seed)
    texts = ["", " ", "\n", " ", None, "plain", "so good", "bad", "\t x"]
    data = [
        {
            "product_id": random.choice(["P1", "p1", None, "e2e"]),
            "user_id": f"U{random.randrange(3)}",
            "score": random.choice([1, 3, 5, None]),
            "text": random.choice(texts if seed % 2 else texts[:6]),
            "source": random.choice(["web", None]),
            "review_id": str(random.randrange(50)),
            "created_at": random.choice(
                [None, datetime(2026, 1, 1) + timedelta(minutes=random.randrange(25))]
            ),
        }
        for _ in range(300)
    ]
    silver = make_silver(data).cache()
    for limit in (1, 20, 100):
        for shown, keep in (
            (rp.recent_reviews(silver, limit), lambda t: bool((t or "").strip(" "))),
            (rp.dashboard_opinions(silver, limit), lambda t: bool((t or "").strip())),
        ):
            wanted = [
                d for d in data
                if d["created_at"] and keep(d["text"])
                and not (d["product_id"] or "").upper().startswith("E2E")
            ]

            def rank(d):
                ties = ("review_id", "product_id", "user_id", "score", "source", "text")
                nulls_first = [(d[c] is not None, d[c] if d[c] is not None else 0) for c in ties]
                return (-d["created_at"].timestamp(), *nulls_first)

            wanted.sort(key=rank)
            names = ("created_at", "review_id", "product_id", "user_id", "score", "text")
            got = [tuple(r[c] for c in names) for r in shown.collect()]
            assert got == [tuple(d[c] for c in names) for d in wanted[:limit]]


def rows_scanned(plan):
    """Rows that left the scans of a plan that has run."""
    if plan.children().size() == 0:
        return plan.metrics().get("numOutputRows").get().value()
    return sum(rows_scanned(plan.children().apply(i)) for i in range(plan.children().size()))


def test_the_newest_rows_are_found_without_reading_old_texts(spark, make_silver, tmp_path):
    """The instant of the first pass reaches the Parquet scan, which skips the older files."""
    start = datetime(2026, 1, 1)
    path = str(tmp_path / "silver")
    for day in range(3):
        make_silver(
            [
                {
                    "product_id": "P1",
                    "score": 4,
                    "text": "x",
                    "review_id": f"{day}-{n}",
                    "created_at": start + timedelta(days=day, minutes=n),
                }
                for n in range(40)
            ]
        ).coalesce(1).write.mode("append").parquet(path)
    key = "spark.sql.adaptive.enabled"
    adaptive = spark.conf.get(key)
    try:
        spark.conf.set(key, False)
        report = rp.recent_reviews(spark.read.parquet(path), 20)
        assert {r.review_id.split("-")[0] for r in report.collect()} == {"2"}
        assert rows_scanned(report._jdf.queryExecution().executedPlan()) == 40
    finally:
        spark.conf.set(key, adaptive)


def test_reports_read_only_their_columns(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    silver.write.parquet(path)
    stored = spark.read.parquet(path)
    for report, columns in (
        (rp.keyword_count(stored, "negative"), "product_id:string,word_count:int,has_negative"),
        (rp.top_products(stored), "product_id:string,score:int>"),
        (rp.sentiment_counts(stored), "product_id:string,sentiment:string>"),
    ):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert columns in plan.replace(" ", "")
        assert "text:string" not in plan


def test_a_hot_product_is_combined_before_the_shuffle(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    silver.write.parquet(path)
    stats = rp.product_stats(spark.read.parquet(path))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("hashpartitioning(product_id")
    assert plan.index("partial_count", shuffle) > shuffle
    assert plan.count("Exchange") == 1


def test_averages_of_unscored_products_come_last(make_silver):
    silver = make_silver(
        [{"product_id": "P1", "score": None, "text": "x"}, {"product_id": "P2", "score": 1}]
    )
    top, worst = rp.top_products(silver, 10, 1), rp.worst_products(silver, 10, 1)
    assert [r.product_id for r in top.collect()] == ["P2", "P1"]
    assert [r.product_id for r in worst.collect()] == ["P1", "P2"]
    assert rp.product_stats(silver).where(F.col("average_score").isNull()).count() == 1


def test_newest_reviews_reach_back_before_the_year_one(make_silver):
    """Fewer rows than the limit: none may fall, however early its time."""
    silver = make_silver(
        [{"product_id": "P1", "score": 5, "text": f"t{n}", "review_id": str(n)} for n in range(3)]
    )
    texts = ["-0004-03-01 00:00:00", "0000-06-01 00:00:00", "2026-01-01 00:00:00"]
    early = F.element_at(F.array(*map(F.lit, texts)), F.col("review_id").cast("int") + 1)
    silver = silver.withColumn("created_at", early.cast("timestamp"))
    for report in (rp.recent_reviews(silver), rp.opinions(silver, 2), rp.dashboard_opinions(silver)):
        found = [r.review_id for r in report.select("review_id").collect()]
        assert found == ["2", "1", "0"][: len(found)] and len(found) >= 2
    assert rp.recent_reviews(silver).count() == 3
    assert rp.opinions(silver, sentiment="positive").count() == 3
