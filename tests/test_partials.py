from datetime import datetime, timedelta

import pytest

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.plans import compaction, loads, partials
from opinlake.plans import dashboard as db
from opinlake.session import materialize
from opinlake.sources.silver import read_silver
from tests.test_dashboard import as_sets
from tests.test_streaming import record, write
from opinlake.sources.events import replay_stream
from opinlake.streaming import jobs


def add_load(spark, layout, make_silver, name, numbers):
    rows = make_silver(
        [
            {
                "product_id": [None, "P1", "P2", "p1", "e2e-9", "P3"][n % 6],
                "user_id": f"U{n % 7}",
                "score": [1, 2, 3, 4, 5, None][n % 5 if n % 11 else 5],
                "text": ["good", "bad", "", None, "\n", "plain"][n % 4 + n % 3],
                "source": [None, "web", "unknown"][n % 3],
                "review_id": str(n),
                "created_at": None if n % 13 == 0 else datetime(2026, 1, 1) + timedelta(hours=n % 50),
            }
            for n in numbers
        ]
    )
    rows.select(*schemas.SILVER.fieldNames()).write.parquet(loads.folder_of(layout.silver_batch, name))
    loads.publish_load(spark, layout, name)


def add_events(spark, layout, folder, numbers):
    write(spark, folder, *(record(n) for n in numbers))
    stream = replay_stream(spark, folder, files_per_trigger=1)
    jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW))


def scanned(frame):
    """Folders of the files that a frame reads, below the lake."""
    return {path.split("/lake/")[1].rsplit("/", 1)[0] for path in frame.inputFiles() if "/lake/" in path}


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([("P1", "One", "c", "d", "u", 1.0, [])], schemas.CATALOG)


def same_as_one_scan(spark, layout, catalog, **options):
    silver = read_silver(spark, layout, **options)
    cube = materialize(db.report_cube(silver), "cube")
    whole = db.dashboard(cube, db.newest_opinions(silver, catalog), catalog)
    merged = partials.incremental_dashboard(spark, layout, catalog)
    assert tuple(merged) == db.DASHBOARD_REPORTS
    for name in db.DASHBOARD_REPORTS:
        assert merged[name].columns == whole[name].columns
    assert as_sets(merged) == as_sets(whole)


def test_three_loads_and_a_stream(spark, make_silver, catalog, tmp_path):
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "replay")
    for part in range(3):
        add_load(spark, layout, make_silver, f"part-{part}", range(part * 90, part * 90 + 90))
    # No partials yet, no stream lane: one scan of everything.
    same_as_one_scan(spark, layout, catalog, optional=["stream"])
    assert partials.refresh_partials(spark, layout) == ["load-part-0", "load-part-1", "load-part-2"]
    cube, newest = partials.incremental_inputs(spark, layout)
    assert not any(path.startswith("silver") for path in scanned(cube) | scanned(newest))
    same_as_one_scan(spark, layout, catalog, optional=["stream"])
    # One more load, a run, and files that no run covers.
    add_events(spark, layout, folder, range(30))
    compaction.compact_stream_lane(spark, layout)
    (run,) = partials.refresh_partials(spark, layout)
    assert run.startswith("run-") and partials.refresh_partials(spark, layout) == []
    add_load(spark, layout, make_silver, "part-3", range(200, 400))
    add_events(spark, layout, folder, range(30, 60))
    cube, newest = partials.incremental_inputs(spark, layout)
    for frame in (cube, newest):
        silver = {path for path in scanned(frame) if path.startswith("silver")}
        assert silver == {"silver/reviews_enriched/ingest=batch/load=part-3", "silver/reviews_enriched/ingest=stream"}
    same_as_one_scan(spark, layout, catalog)


def test_partials_of_merged_runs_go_and_the_result_stays(spark, make_silver, catalog, tmp_path):
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "replay")
    add_load(spark, layout, make_silver, "only", range(40))
    for step in range(4):
        add_events(spark, layout, folder, range(step * 10, step * 10 + 10))
        compaction.compact_stream_lane(spark, layout, keep=1, fanout=2)
        partials.refresh_partials(spark, layout)
    names = {p.name for p in (tmp_path / "lake/gold/partials/published").iterdir() if p.name[0] != "."}
    assert names == {"load-only", *(f"run-{r.run}" for r in compaction.current_runs(spark, layout))}
    assert len(names) == 2
    same_as_one_scan(spark, layout, catalog)


def test_a_refresh_that_dies_is_not_seen(spark, make_silver, catalog, tmp_path, monkeypatch):
    layout = LakeLayout(str(tmp_path / "lake"))
    add_load(spark, layout, make_silver, "one", range(60))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(partials, "touch", crash)
        partials.refresh_partials(spark, layout)
    same_as_one_scan(spark, layout, catalog, optional=["stream"])
    assert partials.refresh_partials(spark, layout) == ["load-one"]
    same_as_one_scan(spark, layout, catalog, optional=["stream"])


def test_an_empty_lake(spark, catalog, tmp_path):
    merged = partials.incremental_dashboard(spark, LakeLayout(str(tmp_path / "lake")), catalog)
    assert merged["summary"].first().total_reviews == 0
    assert merged["top_products"].count() == 0 and merged["opinions"].count() == 0
