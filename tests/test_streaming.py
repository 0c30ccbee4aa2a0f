import json
from datetime import datetime, timedelta

import pytest

from opinlake import schemas
from opinlake.layout import LakeLayout
from opinlake.operators import catalog as ct
from opinlake.operators import dedup, events
from opinlake.plans import compaction
from opinlake.plans.batch_ingest import ingest_history
from opinlake.sources.events import bronze_peek, first_messages, replay_stream
from opinlake.sources.history_csv import read_history_csv
from opinlake.sources.silver import create_external_tables, read_silver
from opinlake.streaming import jobs
from tests.sample import csv_text


def record(number, review_id=None):
    start = datetime(2026, 1, 1)
    if number % 10 == 9:
        value = "garbage"
    else:
        value = json.dumps(
            {
                "product_id": f"P{number % 3}",
                "user_id": "U",
                "score": 1 + number % 5,
                "text": f"good {number}",
                "source": "web",
                "review_id": review_id or f"r{number}",
                "created_at": f"2026-01-01T00:00:{number % 60:02d}+00:00",
            }
        )
    when = start + timedelta(seconds=number)
    return (f"P{number % 3}".encode(), value.encode(), "reviews", number % 2, number, when, 0)


def write(spark, folder, *records):
    frame = spark.createDataFrame(list(records), schemas.KAFKA_RECORD)
    frame.coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def replay(spark, tmp_path):
    folder = str(tmp_path / "replay")
    for part in range(4):
        write(spark, folder, *(record(n) for n in range(part * 10, part * 10 + 10)))
    return folder


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_several_micro_batches_equal_one_batch(spark, replay, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    stream = replay_stream(spark, replay, files_per_trigger=1)
    bronze = jobs.start_bronze(stream, layout, jobs.AVAILABLE_NOW)
    silver = jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW)
    jobs.finish(bronze, silver)
    assert len({p["batchId"] for p in silver.recentProgress}) >= 4
    records = spark.read.schema(schemas.KAFKA_RECORD).parquet(replay)
    assert same(read_silver(spark, layout, ["stream"]), events.events_to_silver(records))
    assert spark.read.json(layout.bronze_stream).count() == 40
    assert bronze_peek(spark, layout.bronze_stream).count() == 10


def test_restart_reads_only_what_is_new(spark, replay, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))

    def run():
        stream = replay_stream(spark, replay, files_per_trigger=1)
        jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW))
        return read_silver(spark, layout, ["stream"]).count()

    assert run() == 40
    assert run() == 40
    write(spark, replay, record(41), record(42))
    assert run() == 42


def test_quarantine_mode_keeps_malformed_values_out(spark, replay, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    stream = replay_stream(spark, replay)
    jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW, "quarantine"))
    assert read_silver(spark, layout, ["stream"]).count() == 36
    bronze = events.open_envelope(spark.read.schema(schemas.KAFKA_RECORD).parquet(replay))
    assert events.undecodable(bronze).count() == 4


def test_both_lanes_are_seen_whatever_was_written_last(spark, replay, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    csv = tmp_path / "sample.csv"
    csv.write_text(csv_text())
    ingest_history(read_history_csv(spark, str(csv)), layout)
    jobs.finish(jobs.start_silver(replay_stream(spark, replay), layout, jobs.AVAILABLE_NOW))
    ingest_history(read_history_csv(spark, str(csv)), layout)
    assert read_silver(spark, layout).count() == 16 + 40 + 16
    view = create_external_tables(spark, layout, "shop_lanes")
    assert spark.table(view).count() == 16 + 40 + 16


def test_uncommitted_files_stay_invisible(spark, replay, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    jobs.finish(jobs.start_silver(replay_stream(spark, replay), layout, jobs.AVAILABLE_NOW))
    rows = read_silver(spark, layout, ["stream"])
    rows.write.mode("append").parquet(layout.silver_stream)
    assert read_silver(spark, layout, optional=["batch"]).count() == 40


def test_running_aggregates(spark, replay, tmp_path):
    stream = replay_stream(spark, replay, files_per_trigger=1)
    for name, relation in (
        ("sentiment", jobs.sentiment_counts(stream)),
        ("products", jobs.product_scores(stream)),
    ):
        out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}_checkpoint")
        jobs.finish(
            jobs.start_result_table(relation, out, checkpoint, jobs.AVAILABLE_NOW, 2)
        )
        result = {tuple(r) for r in jobs.latest_result(spark, out, relation.schema).collect()}
        if name == "sentiment":
            good = [n for n in range(40) if n % 10 != 9]
            assert result == {
                ("positive", sum(n % 5 >= 3 for n in good)),
                ("neutral", sum(n % 5 == 2 for n in good)),
                ("negative", sum(n % 5 < 2 for n in good) + 4),
            }
        else:
            assert sum(row[1] for row in result) == 40
            assert (None, 4, None) in result
            for product in range(3):
                scores = [1 + n % 5 for n in range(40) if n % 10 != 9 and n % 3 == product]
                average = round(sum(scores) / len(scores) + 1e-9, 2)
                assert (f"P{product}", len(scores), average) in result


def test_only_two_results_are_kept(spark, replay, tmp_path):
    stream = replay_stream(spark, replay, files_per_trigger=1)
    out = tmp_path / "out"
    jobs.finish(
        jobs.start_result_table(
            jobs.sentiment_counts(stream), str(out), str(tmp_path / "c"), jobs.AVAILABLE_NOW, 2
        )
    )
    folders = sorted(p.name for p in out.iterdir() if p.name.startswith("batch_id="))
    assert len(folders) == 2
    assert len([p for p in (out / "_published").iterdir() if p.name.isdigit()]) == 2


def test_results_are_read_before_during_and_between_micro_batches(spark, replay, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    stream = replay_stream(spark, replay, files_per_trigger=1)
    counts = jobs.sentiment_counts(stream)
    assert jobs.latest_result(spark, out, counts.schema).count() == 0
    query = jobs.start_result_table(counts, out, checkpoint, jobs.AVAILABLE_NOW, 2)
    totals = []
    while query.isActive:
        reader = jobs.latest_result(spark, out, counts.schema)
        totals.append(reader.agg({"review_count": "sum"}).first()[0] or 0)
    jobs.finish(query)
    assert totals == sorted(totals) and set(totals) <= {0, 10, 20, 30, 40}
    held = jobs.latest_result(spark, out, counts.schema)
    write(spark, replay, *(record(n) for n in range(40, 50)))
    again = jobs.sentiment_counts(replay_stream(spark, replay, files_per_trigger=1))
    jobs.finish(jobs.start_result_table(again, out, checkpoint, jobs.AVAILABLE_NOW, 2))
    assert held.agg({"review_count": "sum"}).first()[0] == 40
    newest = jobs.latest_result(spark, out, counts.schema)
    assert newest.agg({"review_count": "sum"}).first()[0] == 50


def test_rejects_are_kept_with_their_reason(spark, replay, tmp_path):
    layout = LakeLayout(str(tmp_path / "lake"))
    stream = replay_stream(spark, replay)
    jobs.finish(
        jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW, "quarantine"),
        jobs.start_rejects(stream, layout, jobs.AVAILABLE_NOW),
    )
    kept = read_silver(spark, layout, ["stream"]).count()
    rejects = spark.read.json(layout.bronze_rejected)
    assert kept == 36 and rejects.count() == 4
    assert {r.reason for r in rejects.collect()} == {"not the JSON of an event"}


def test_products_added_between_micro_batches_are_named(spark, replay, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("catalog", "out", "c"))

    def products(*ids):
        rows = [(i, f"Name {i}", "c", "d", "u", 1.0, []) for i in ids]
        spark.createDataFrame(rows, schemas.CATALOG).write.mode("overwrite").parquet(path)

    def run():
        reviews = events.decode(events.open_envelope(replay_stream(spark, replay)))
        reviews = reviews.select("offset", "product_id")
        catalog = lambda: spark.read.schema(schemas.CATALOG).parquet(path)
        jobs.finish(jobs.start_enriched(reviews, catalog, out, checkpoint, jobs.AVAILABLE_NOW))

    products("P1")
    run()
    products("P1", "P2")
    write(spark, replay, *(record(n) for n in range(40, 49)))
    run()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 49
    named = {(r.product_id, r.offset >= 40) for r in rows if r.product_name}
    assert named == {("P1", False), ("P1", True), ("P2", True)}


def test_session_settings_are_restored(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), jobs.state_partition_number(spark, 17):
        assert spark.conf.get(key) == "17"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_repeats_across_micro_batches_arrive_once(spark, replay, tmp_path):
    write(spark, replay, *(record(n) for n in range(30, 40)))
    stream = replay_stream(spark, replay, files_per_trigger=1)
    reviews = events.decode(events.open_envelope(stream), "quarantine")
    once = dedup.drop_stream_repeats(reviews, "kafka_timestamp", "10 minutes")
    out = str(tmp_path / "out")
    jobs.finish(
        jobs.start_file_sink(once, "parquet", out, str(tmp_path / "c"), jobs.AVAILABLE_NOW)
    )
    ids = [r.review_id for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == sorted(f"r{n}" for n in range(40) if n % 10 != 9)


def test_names_are_joined_to_the_stream(spark, replay, tmp_path):
    names = spark.createDataFrame([("P1", "One", "c", "d", "u", 1.0, [])], schemas.CATALOG)
    stream = replay_stream(spark, replay, files_per_trigger=2)
    reviews = events.decode(events.open_envelope(stream))
    named = ct.enrich_with_catalog(reviews, names)
    out = str(tmp_path / "out")
    jobs.finish(
        jobs.start_file_sink(named, "parquet", out, str(tmp_path / "c"), jobs.AVAILABLE_NOW)
    )
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 40
    assert all((r.product_name == "One") == (r.product_id == "P1") for r in rows)


def test_console_sinks(spark, replay):
    stream = replay_stream(spark, replay)
    reviews = events.decode(events.open_envelope(stream))
    shown = [
        jobs.start_console(reviews, "reviews_test"),
        jobs.start_console(jobs.product_scores(stream), "scores_test", "complete"),
    ]
    for query in shown:
        query.processAllAvailable()
        query.stop()
        assert query.exception() is None


def test_first_messages(spark, replay):
    rows = first_messages(spark.read.schema(schemas.KAFKA_RECORD).parquet(replay)).collect()
    assert [r.offset for r in rows] == [0, 1, 2, 3, 4]
    assert json.loads(rows[0].json_value)["review_id"] == "r0"


def test_compaction_changes_files_and_no_rows(spark, replay, tmp_path, monkeypatch):
    layout = LakeLayout(str(tmp_path / "lake"))

    def run():
        stream = replay_stream(spark, replay, files_per_trigger=1)
        jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW))
        return spark.read.parquet(layout.silver_stream)

    lane = run()
    small = len(lane.inputFiles())
    assert compaction.compact_stream_lane(spark, layout) == small
    compacted = read_silver(spark, layout, ["stream"])
    assert same(compacted, lane) and len(compacted.inputFiles()) < small
    write(spark, replay, *(record(n) for n in range(40, 50)))
    lane = run()
    assert same(read_silver(spark, layout, ["stream"]), lane)
    assert compaction.covered_share(spark, layout).first().covered == small

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(compaction, "touch", crash)
        compaction.compact_stream_lane(spark, layout)
    assert same(read_silver(spark, layout, ["stream"]), lane)
    for _ in range(3):
        assert compaction.compact_stream_lane(spark, layout) == len(lane.inputFiles())
    assert same(read_silver(spark, layout, ["stream"]), lane)
    assert len(list((tmp_path / "lake/silver/reviews_compacted/_published").glob("0*"))) == 2


def _grow(spark, folder, layout, numbers, **options):
    write(spark, folder, *(record(n) for n in numbers))
    stream = replay_stream(spark, folder, files_per_trigger=1)
    jobs.finish(jobs.start_silver(stream, layout, jobs.AVAILABLE_NOW, **options))


def test_compactions_rewrite_a_row_once_for_each_level(spark, tmp_path, monkeypatch):
    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "replay")
    written = []
    plain = compaction._rows
    monkeypatch.setattr(compaction, "_rows", lambda *a: written.append(plain(*a).count()) or plain(*a))
    levels = []
    for step in range(9):
        _grow(spark, folder, layout, range(step * 10, step * 10 + 10))
        compaction.compact_stream_lane(spark, layout, fanout=3)
        levels.append(sorted(r.level for r in compaction.current_runs(spark, layout)))
    assert levels == [[0], [0, 0], [1], [0, 1], [0, 0, 1], [1, 1], [0, 1, 1], [0, 0, 1, 1], [2]]
    # Nine loads of 10 rows: 10 each, or 30 or 90 where a level is full; rewriting all would be 450.
    assert written == [10, 10, 30, 10, 10, 30, 10, 10, 90]
    sizes = compaction.run_sizes(spark, layout).collect()
    assert [(r.level, r.rows) for r in sizes] == [(2, 90)]
    monkeypatch.undo()
    lane = spark.read.parquet(layout.silver_stream)
    assert same(read_silver(spark, layout, ["stream"]), lane) and lane.count() == 90
    folders = set(p.name for p in (tmp_path / "lake/silver/reviews_compacted/runs").iterdir())
    kept = {r.run for r in compaction.current_runs(spark, layout)}
    assert kept <= folders and len(folders) <= 5


def test_rows_stay_when_the_sink_drops_their_files(spark, tmp_path):
    import time

    layout, folder = LakeLayout(str(tmp_path / "lake")), str(tmp_path / "replay")
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    try:
        dropped = False
        for step in range(5):
            _grow(spark, folder, layout, range(step * 10, step * 10 + 10), retention="1s")
            compaction.compact_stream_lane(spark, layout, fanout=3)
            time.sleep(1.2)
            listed = len(spark.read.parquet(layout.silver_stream).inputFiles())
            dropped = dropped or listed < step + 1
            assert read_silver(spark, layout, ["stream"]).count() == step * 10 + 10
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")
    assert dropped
    assert read_silver(spark, layout, ["stream"]).select("offset").distinct().count() == 50
