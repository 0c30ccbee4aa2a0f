from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.plans import dashboard as db
from opinlake.plans import snapshot
from opinlake.session import materialize
from opinlake.sources.history_csv import read_sample_csv
from opinlake.sources.silver import MissingLane, fetch_one, read_silver
from tests.sample import csv_text


@pytest.fixture(scope="module")
def silver(spark, make_silver):
    texts = ["good", "bad", "", None, "\n", "plain"]
    frame = make_silver(
        [
            {
                "product_id": [None, "P1", "P2", "p1", "e2e-9", "P3"][n % 6],
                "user_id": f"U{n % 7}",
                "score": [1, 2, 3, 4, 5, None][n % 5 if n % 11 else 5],
                "text": texts[n % 4 + n % 3],
                "source": [None, "web", "unknown"][n % 3],
                "review_id": str(n),
                "created_at": None if n % 13 == 0 else datetime(2026, 1, 1) + timedelta(hours=n),
            }
            for n in range(400)
        ]
    )
    return materialize(frame, "silver")


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(
        [("P1", "One", "c", "d", "u", 1.0, []), ("P2", "Two", "c", "d", "u", 1.0, [])],
        schemas.CATALOG,
    )


def as_sets(bundle):
    return {name: sorted(map(repr, frame.collect())) for name, frame in bundle.items()}


def test_the_cube_gives_what_the_single_reports_give(silver, catalog):
    cube = materialize(db.report_cube(silver), "cube")
    from_cube = db.dashboard(cube, db.newest_opinions(silver, catalog), catalog)
    single = db.dashboard_by_report(silver, catalog)
    assert tuple(from_cube) == db.DASHBOARD_REPORTS == tuple(single)
    for name in db.DASHBOARD_REPORTS:
        assert from_cube[name].columns == single[name].columns
    assert as_sets(from_cube) == as_sets(single)


def test_a_missing_product_is_a_group_and_no_total(silver):
    cube = db.report_cube(silver)
    missing = cube.where((F.col("level") == "product") & F.col("product_id").isNull()).collect()
    assert len(missing) == 1
    total = cube.where("level = 'all'").first().review_count
    assert 0 < missing[0].review_count < total


def test_missing_and_named_unknown_sources_are_one(silver):
    cube = db.report_cube(silver)
    sources = [r.source for r in cube.where("level = 'source'").collect()]
    assert sorted(sources) == ["unknown", "web"]


def test_an_empty_lake_gives_a_whole_dashboard(silver):
    empty = silver.where("false")
    cube = materialize(db.report_cube(empty), "cube")
    bundle = db.dashboard(cube, db.newest_opinions(empty))
    assert fetch_one(bundle["summary"]) == {
        "total_reviews": 0,
        "average_score": 0.0,
        "first_review_at": None,
        "last_review_at": None,
    }
    assert fetch_one(bundle["negative_keywords"])["matching_reviews"] == 0
    for name in ("sentiment", "top_products", "recent_reviews", "sources"):
        assert bundle[name].count() == 0


def test_sample_dashboard_filters_nothing(spark, tmp_path, catalog):
    path = tmp_path / "sample.csv"
    path.write_text(csv_text() + "17,e2e-1,U1,N,1,2,1,1767225600,S,bad\n")
    sample = read_sample_csv(spark, str(path))
    cube = db.report_cube(sample, trusted=True)
    bundle = db.sample_dashboard(cube, db.sample_newest(sample, catalog), catalog)
    assert tuple(bundle) == db.DASHBOARD_REPORTS
    assert fetch_one(bundle["summary"])["total_reviews"] == 17
    assert [tuple(r) for r in bundle["sources"].collect()] == [("sample_csv", 17)]
    assert fetch_one(bundle["negative_keywords"])["matching_reviews"] == 6
    negative = [r.product_id for r in bundle["negative_products"].collect()]
    assert negative == ["e2e-1", "P004", "P008", "P012", "P006"]
    assert bundle["recent_reviews"].count() == 17


def test_small_bundle(silver, catalog):
    bundle = db.analytics_bundle(silver, catalog)
    assert set(bundle) == {"summary", "sentiment", "products"}
    assert "product_name" in bundle["products"].columns


def test_snapshots_are_published_whole(spark, silver, catalog, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    assert snapshot.latest_snapshot(spark, layout) is None
    published = snapshot.publish_snapshot(spark, layout, silver, catalog)
    assert (published["status"], published["stale"]) == ("fresh", False)
    first = published["snapshot_id"]
    better = silver.where("score = 5")
    second = snapshot.publish_snapshot(spark, layout, better, catalog)["snapshot_id"]
    envelope = fetch_one(snapshot.latest_snapshot(spark, layout))
    assert envelope["snapshot_id"] == second != first
    assert (envelope["status"], envelope["stale"]) == ("cached", True)
    assert envelope["generated_at"] is not None
    stored = snapshot.read_snapshot(spark, layout, first)
    assert as_sets(stored) == as_sets(db.dashboard_by_report(silver, catalog))
    folder = tmp_path / "lake/gold/dashboard"
    assert not (folder / f"snapshot_id={first}" / "cube").exists()
    third = snapshot.publish_snapshot(spark, layout, silver, catalog, keep=2)["snapshot_id"]
    left = {p.name for p in folder.iterdir() if p.name.startswith("snapshot_id=")}
    assert left == {f"snapshot_id={second}", f"snapshot_id={third}"}
    with pytest.raises(ValueError):
        snapshot.remove_old_snapshots(spark, layout, 0)


def test_no_snapshot_of_a_lake_that_is_not_there(spark, silver, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    good = snapshot.publish_snapshot(spark, layout, silver)["snapshot_id"]
    with pytest.raises(MissingLane):
        snapshot.publish_snapshot(spark, layout, read_silver(spark, layout))
    assert fetch_one(snapshot.latest_snapshot(spark, layout))["snapshot_id"] == good


def test_texts_are_scanned_by_one_top_k(silver, catalog):
    """The written list of opinions serves both relations."""
    cube = materialize(db.report_cube(silver), "cube")
    newest = materialize(db.newest_opinions(silver, catalog), "newest")
    bundle = db.dashboard(cube, newest, catalog)
    for name in ("recent_reviews", "opinions"):
        plan = bundle[name]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1 and "Join" not in plan


def test_a_failed_snapshot_leaves_the_one_before(spark, silver, tmp_path, monkeypatch):
    layout = LakeLayout(str(tmp_path / "lake"))
    good = snapshot.publish_snapshot(spark, layout, silver)["snapshot_id"]
    whole = snapshot.dashboard

    def without_sources(*arguments):
        bundle = whole(*arguments)
        del bundle["sources"]
        bundle["sentiment"] = bundle["sentiment"].drop("review_count")
        return bundle

    monkeypatch.setattr(snapshot, "dashboard", without_sources)
    with pytest.raises(snapshot.IncompleteSnapshot, match="sentiment, sources"):
        snapshot.publish_snapshot(spark, layout, silver)
    assert fetch_one(snapshot.latest_snapshot(spark, layout))["snapshot_id"] == good
