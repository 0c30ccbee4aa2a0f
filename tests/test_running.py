"""Running aggregates kept as runs of sums."""

import os

from opinlake import schemas
from opinlake.sources.events import replay_stream
from opinlake.streaming import jobs, running
from tests.test_streaming import record, write

SCHEMAS = {
    "sentiment": "sentiment string, review_count long",
    "products": "product_id string, review_count long, average_score double",
}


def run(spark, replay, report, out, checkpoint):
    stream = replay_stream(spark, replay, files_per_trigger=1)
    jobs.finish(running.start_running(stream, report, out, checkpoint, jobs.AVAILABLE_NOW))


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def test_equal_to_the_complete_result_and_bounded_in_runs(spark, tmp_path):
    replay = str(tmp_path / "replay")
    for part in range(9):
        write(spark, replay, *(record(n) for n in range(part * 10, part * 10 + 10)))
    for name, report in (("sentiment", running.sentiment_report()), ("products", running.product_report())):
        stream = replay_stream(spark, replay, files_per_trigger=3)
        whole = {"sentiment": jobs.sentiment_counts, "products": jobs.product_scores}[name](stream)
        table, out = str(tmp_path / f"{name}_table"), str(tmp_path / name)
        jobs.finish(jobs.start_result_table(whole, table, table + "_c", jobs.AVAILABLE_NOW, 2))
        run(spark, replay, report, out, out + "_c")
        found = running.running_result(spark, report, out, SCHEMAS[name])
        assert rows(found) == rows(jobs.latest_result(spark, table, whole.schema))
        assert found.schema.names == whole.schema.names
        assert running.visible(running.shown_runs(spark, out)) == [(0, 3), (4, 7), (8, 8)]


def test_a_trigger_writes_what_its_keys_need(spark, tmp_path):
    """Many products are known; a later micro-batch with three of them stores three rows."""
    replay, out = str(tmp_path / "replay"), str(tmp_path / "out")
    frame = spark.range(20_000).selectExpr(
        "CAST(concat('P', id) AS binary) AS key",
        "CAST(concat('{\"product_id\":\"Q', id, '\",\"score\":4,\"text\":\"x\"}') AS binary) AS value",
        "'reviews' AS topic", "0 AS partition", "id AS offset", "timestamp'2026-01-01' AS timestamp", "0 AS timestampType",
    )
    spark.createDataFrame(frame.rdd, schemas.KAFKA_RECORD).coalesce(1).write.parquet(replay)
    run(spark, replay, running.product_report(), out, out + "_c")
    first = size_of(f"{out}/runs/0-0")
    write(spark, replay, *(record(n) for n in range(9)))
    run(spark, replay, running.product_report(), out, out + "_c")
    assert spark.read.parquet(f"{out}/runs/1-1").count() == 3
    assert size_of(f"{out}/runs/1-1") * 10 < first
    assert running.running_result(spark, running.product_report(), out, SCHEMAS["products"]).count() == 20_003


def test_a_repeated_micro_batch_counts_once(spark, tmp_path):
    """The stream is set back behind its last micro-batches: before and after they were folded, and
    with a run whose marker was never made."""
    replay, out = str(tmp_path / "replay"), str(tmp_path / "out")
    for part in range(5):
        write(spark, replay, *(record(n) for n in range(part * 10, part * 10 + 10)))
        run(spark, replay, running.product_report(), out, out + "_c")
        expected = rows(running.running_result(spark, running.product_report(), out, SCHEMAS["products"]))
        os.remove(f"{out}_c/commits/{part}")
        if os.path.exists(f"{out}_c/commits/.{part}.crc"):
            os.remove(f"{out}_c/commits/.{part}.crc")
        if part == 1:  # killed between the files and the marker
            os.remove(f"{out}/_shown/1-1")
            assert running.running_result(spark, running.product_report(), out, SCHEMAS["products"]).agg({"review_count": "sum"}).first()[0] == 10
        run(spark, replay, running.product_report(), out, out + "_c")
        assert rows(running.running_result(spark, running.product_report(), out, SCHEMAS["products"])) == expected
        assert sum(r[1] for r in expected) == 10 * part + 10


def test_empty_and_covered_runs(spark, tmp_path):
    out = str(tmp_path / "out")
    assert running.running_result(spark, running.sentiment_report(), out, SCHEMAS["sentiment"]).count() == 0
    assert running.visible([(0, 0), (0, 3), (3, 3), (4, 4)]) == [(0, 3), (4, 4)]
    assert running.visible([]) == []
